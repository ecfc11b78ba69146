"""The training-data pipeline: quality rules, near duplicates, benchmark leaks, personal data, packing.

Each stage reads what the one before has written. All but the last return the columns of ``documents``. Null texts fail
the quality rules; empty tables pass through all stages as empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.base import marked, table, written
from llm.decontaminate import leaks
from llm.ngram_join import ngram_jaccard_join
from llm.packing import harmonic_pack, piece_digests
from llm.quality import keep_good
from llm.surrogates import replace_entities

SURROGATE_KEY = "corpus pipeline"  # a run on real data sets its own secret here


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules judge good; each row is judged by its own text, whatever its doc_id and other columns."""
    return keep_good(docs)


def _rows(docs: DataFrame, **keys: Column) -> DataFrame:
    """Whole rows as one column beside ``keys``, so that no column of theirs clashes with a stage's own."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(k.alias(name) for name, k in keys.items()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest doc_id; one row where it is repeated.

    Rows without doc_id stay: nothing can stand for them. Other columns are carried unread. Rows travel only where their
    id may be dropped or repeated.
    """
    found = ngram_jaccard_join(docs)
    ids = found.groupBy("doc_id").agg(F.min("component_id").alias("component"), F.count(F.lit(1)).alias("n_rows"))
    ids = written(ids.where("doc_id is not null"), "component-ids")
    kept = ids.where("doc_id = component").select(F.col("doc_id").alias("kept_id"), "n_rows")
    held = marked(_rows(docs, id=F.col("doc_id")), "id", ids.where("doc_id != component or n_rows > 1").select("doc_id"))
    again = held.where("hit")
    once = again.join(kept.where("n_rows = 1"), F.col("id") == F.col("kept_id"), "left_semi")
    repeated = again.join(kept.where("n_rows > 1"), F.col("id") == F.col("kept_id"), "left_semi").dropDuplicates(["id"])
    return held.where("not hit").union(once).union(repeated).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    A row goes by its own text, known by a 64-bit hash: also without doc_id, and without taking other rows of its id along.
    Null and empty texts stay. Other columns are carried unread.
    """
    mark = F.xxhash64(F.col("text"))
    leaked = leaks(docs.select(mark.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leaked")).distinct()
    held = _rows(docs, mark=mark)
    return held.join(written(leaked, "leaked-texts"), F.col("mark") == F.col("leaked"), "left_anti").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by surrogates; n_chars follows the text.

    Equal texts get equal results, in repeated rows too; null texts and all other columns stay as they are.
    """
    rest = [c for c in docs.columns if c != "text"]
    out = replace_entities(docs.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"), "text"), SURROGATE_KEY)
    columns = {c: F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_replaced") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return out.select(*(column.alias(c) for c, column in columns.items()))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the kept documents in sequences of 4096 tokens; see :func:`llm.packing.harmonic_pack` for repeated and null rows."""
    return piece_digests(harmonic_pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("pii_surrogates", personal_data),
    ("harmonic_packing", packing),
]

#: Expectation-maximisation, tiling and the tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
