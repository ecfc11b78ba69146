"""The pipeline's stages, each against what its operator decides."""

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from llm import base
from llm.decontaminate import leaks
from llm.quality import quality_rules


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(corpus_pipeline.written(stage(spark, seen[-1], sf_dir), "test-stage"))
        assert seen[-1].columns == columns
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert ids[1] == {r["doc_id"] for r in quality_rules(docs).where("kept").collect()}
    assert ids[2] < ids[1] and len(ids[2]) == seen[2].count()
    found = {r["doc_id"] for r in leaks(seen[2], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert found and ids[3] == ids[2] - found and ids[4] == ids[3]
    texts = {r["doc_id"]: r for r in seen[4].collect()}
    assert not any("@mail1." in r["text"] for r in texts.values()) and all(r["n_chars"] == len(r["text"]) for r in texts.values())
    pieces = corpus_pipeline.packing(spark, seen[4], sf_dir).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, group in pieces.groupby("doc_id"):
        assert group.length.sum() == len(tokenizer.encode(texts[i]["text"], add_special_tokens=False).ids) + 1


def test_repeated_and_unnamed_rows(spark, sf_dir):
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11), (None, "a b c d e f", "en", "s", 11), (3, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 3]


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "test-empty")
    assert docs.count() == 0


def test_clashing_columns_and_rows_by_their_own_text(spark, sf_dir):
    """A leaked row goes also without doc_id, and takes no clean row of its id along; columns named like a stage's own stay."""
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = " ".join(f"word{k}" for k in range(60)) + " a@b.example"
    names = ["kept_id", "leaked_id", "leaked", "mark", "id", "row", "n_replaced", "n_rows", "component"]
    rows = [(None, f"x y {item} z", 3), (1, f"so {item}", 3), (1, clean, 3), (None, None, 0), (2, "", 0), (3, clean, 5), (None, clean, 7)]
    docs = spark.createDataFrame([(i, t, n, *range(len(names))) for i, t, n in rows], "doc_id long, text string, n_chars int, " + ", ".join(f"`{c}` int" for c in names))
    left = corpus_pipeline.decontaminate(spark, docs, sf_dir)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == [(0, ""), (0, clean), (1, clean), (2, ""), (3, clean)]
    one = corpus_pipeline.near_duplicates(spark, left, sf_dir)
    assert one.schema == docs.schema and sorted((r["doc_id"] or 0, r["text"] or "") for r in one.collect()) == [(0, ""), (0, clean), (1, clean), (2, "")]
    out = corpus_pipeline.personal_data(spark, one, sf_dir)
    assert out.columns == docs.columns
    for r in out.collect():
        assert [r[c] for c in names] == list(range(len(names)))
        assert not r["text"] or ("a@b.example" not in r["text"] and r["n_chars"] == len(r["text"]))


def test_marked_ids_hit_and_null_does_not(spark, monkeypatch):
    ids = [0, -1, 5, 64, 2**62, -(2**63), 2**63 - 1]
    rows = spark.createDataFrame([(i, "t") for i in [*ids, *range(1000, 3000), None]], "id long, text string")
    got = {r["id"]: r["hit"] for r in base.marked(rows, "id", spark.createDataFrame([(i,) for i in [*ids, 5, None]], "doc_id long")).collect()}
    assert len(got) == rows.count() and all(got[i] for i in ids) and not got[None] and sum(got.values()) < 20
    assert not any(r["hit"] for r in base.marked(rows, "id", spark.createDataFrame([], "doc_id long")).collect())


def test_kept_rows_are_not_shuffled_for_their_duplicates(spark, sf_dir, monkeypatch):
    docs = base.table(spark, sf_dir, "documents").limit(120).select("doc_id", "text")
    docs = docs.union(docs.limit(9)).union(docs.limit(20).select(F.col("doc_id") + 10**6, "text")).union(docs.limit(3).select(F.lit(None), "text"))
    found = {}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
        unhit = out._jdf.queryExecution().executedPlan().toString().split("Union", 1)[1]
        indent = min(line.index(":- ") for line in unhit.splitlines() if ":- " in line)
        first = unhit.split("\n" + " " * indent + ":- ", 2)[1]
        assert "BroadcastHashJoin" in first and "SortMergeJoin" not in first
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for bits in (1, base.MARK_BITS):  # with one bit nearly every row is a false hit
        monkeypatch.setattr(base, "MARK_BITS", bits)
        found[bits] = sorted(map(repr, corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()))
    assert len({tuple(x) for x in found.values()}) == 1 and len(found[1]) <= 123
