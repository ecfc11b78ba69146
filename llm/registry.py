"""The operators' registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.base import table
from llm.centroids import cluster_vectors
from llm.chat import repair_chats
from llm.decontaminate import leaks
from llm.htmltext import main_text
from llm.languages import identify_languages, learn_languages
from llm.lm import lm_scores
from llm.ngram_join import ngram_jaccard_join
from llm.packing import harmonic_pack, piece_digests
from llm.periods import periodic_runs, run_digests, with_repeated_ends
from llm.quality import quality_rules
from llm.runindex import remove_repeats
from llm.surrogates import replace_entities
from llm.toxicity import score_toxicity, train

SURROGATE_KEY = "registered query"  # a run on real data passes its own secret
WORD = r"[^\x20\x09-\x0D]+"


def op1_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op2_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("train", _remainder(7) != 2)
    return lm_scores(documents).withColumn("held_out", _remainder(7) == 2)


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(harmonic_pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op4_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY).select("doc_id", "text", "n_replaced")


def op6_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_chats(table(spark, sf_dir, "conversations"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept")


def op8_toxic_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    learnt = table(spark, sf_dir, "labels").where(_remainder(3) != 1)
    scored = score_toxicity(documents, train(documents, learnt))
    return scored.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_sentences", "worst", "worst_score", "worst_text")


def op9_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op11_basic_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_repeated_ends(table(spark, sf_dir, "documents"))))


def op12_equal_average_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256")
    return cluster_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest)


def op13_language_mixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out")  # rows without doc_id are neither learnt from nor held out
    found = identify_languages(documents, learn_languages(documents.where(_remainder(5) != 0)))
    return found.select("doc_id", held_out, "lang_pred", "score", "n_trigrams", "languages")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_tiling": op1_benchmark_tiling,
    "op2_trie_scores": op2_trie_scores,
    "op3_harmonic_packing": op3_harmonic_packing,
    "op4_run_length_index": op4_run_length_index,
    "op5_pii_surrogates": op5_pii_surrogates,
    "op6_role_repair": op6_role_repair,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxic_sentences": op8_toxic_sentences,
    "op9_consensus_paths": op9_consensus_paths,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_basic_factors": op11_basic_factors,
    "op12_equal_average_search": op12_equal_average_search,
    "op13_language_mixtures": op13_language_mixtures,
}

_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(d) + 1), lambda i: ascii(d[i])::BIGINT)),
 lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295)"""


def _cluster_sql(k: int = 40, rounds: int = 5) -> str:
    """Each round by brute force over all centroids, on the components as rows."""
    nearest = """
SELECT vec_id, row, arg_min(number, {{'d': d, 'n': number}}) AS cluster, min(d) AS distance FROM (
 SELECT v.vec_id, v.row, c.number, sum((v.x - c.x) * (v.x - c.x)) AS d FROM parts v JOIN c{r} c ON v.pos = c.pos GROUP BY ALL)
GROUP BY vec_id, row"""
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS ({nearest.format(r=r)})")
        steps.append(f"""c{r + 1} AS (
 SELECT c.number, c.pos, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
  SELECT a.cluster AS number, v.pos, (sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
  FROM a{r} a JOIN parts v ON a.row = v.row GROUP BY ALL) m ON c.number = m.number AND c.pos = m.pos)""")
    return f"""
WITH kept AS (
 SELECT vec_id, row_number() OVER () AS row, embedding FROM embeddings
 WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS (
 SELECT vec_id, row, unnest(range(0, 64)) AS pos, CAST(floor(256 * unnest(embedding)::DOUBLE) AS BIGINT) AS x FROM kept),
starts AS (SELECT row, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS number FROM kept QUALIFY number < {k}),
c0 AS (SELECT number, pos, x FROM starts JOIN parts USING (row)),
{", ".join(steps)},
ends AS ({nearest.format(r=rounds)}),
digests AS (SELECT number, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY number)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
 CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM ends JOIN digests ON cluster = number"""


ORACLES = {
    "op4_run_length_index": """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
 SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
 FROM (SELECT doc_id, h, unnest(range(0, greatest(0, strlen(h) // 2 - 49))) AS i FROM bytes)),
least AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM windows JOIN least USING (w) WHERE first < doc_id),
spans AS (
 SELECT doc_id, min(i) AS a, max(i) + 50 AS b
 FROM (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM hits)
 GROUP BY doc_id, span),
listed AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, sum(b - a) AS removed, count(*) AS n FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
 sha256(unhex(CASE WHEN n IS NULL THEN h ELSE array_to_string(list_transform(range(0, n + 1), lambda k:
  substr(h, CASE WHEN k = 0 THEN 1 ELSE 2 * b[k] + 1 END, CASE WHEN k = n THEN strlen(h) ELSE 2 * a[k + 1] - CASE WHEN k = 0 THEN 0 ELSE 2 * b[k] END END)), '') END)) AS kept_sha256
FROM bytes LEFT JOIN listed USING (doc_id)""",
    "op10_ngram_jaccard_join": rf"""
WITH RECURSIVE split AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
grams AS (
 SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END) AS g FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * o >= 85 * (x.n + y.n - o)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT edges.b, reach.root FROM reach JOIN edges ON reach.doc_id = edges.a)
SELECT r.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(r.root) AS component_id
FROM reach r LEFT JOIN sizes s ON r.doc_id = s.doc_id GROUP BY r.doc_id""",
    "op11_basic_factors": rf"""
WITH split AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS d, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
hashed AS (SELECT doc_id, ws, len(ws) AS n, {_CRC} AS h FROM split),
planned AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM hashed),
stepped AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM planned),
w AS (
 SELECT doc_id, i, CASE WHEN i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS w
 FROM (SELECT *, unnest(range(0, n)) AS i FROM stepped)),
same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i JOIN stepped s ON s.doc_id = x.doc_id WHERE 4 * (y.i - x.i) <= s.n),
islands AS (
 SELECT doc_id, q, min(i) AS start, count(*) + q AS length
 FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, start, length, min(q) AS q FROM islands WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS runs FROM runs GROUP BY doc_id),
best AS (
 SELECT * FROM runs r WHERE NOT EXISTS (
  SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (o.length * r.q > r.length * o.q OR o.length * r.q = r.length * o.q AND (o.start, o.q) < (r.start, r.q)))),
kept AS (
 SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM w WHERE NOT EXISTS (
  SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.q AND w.i < r.start + r.length) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start, CAST(b.length AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
 CAST(1000 * b.length // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN best b ON d.doc_id = b.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id""",
    "op12_equal_average_search": _cluster_sql(),
}
