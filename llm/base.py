"""Helpers shared by the operators: tables, written intermediate results, packed rows, components."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import drop_path, materialize, scratch_dir

SPACES = " \t\n\x0b\f\r"
CLEAN_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MARK_BITS = 24  # 2^18 numbers in the bitmap of ``marked`` at most, whatever the input
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package's modules to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp()  # code, not data: the driver serves this file to the executors while it runs
    with zipfile.ZipFile(archive := f"{folder}/llm-modules.zip", "w") as out:
        for name in ("llm", "tidemark"):
            for path in sorted((root / name).rglob("*.py")):
                out.write(path, path.relative_to(root))
    context.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _written_to(df: DataFrame, path: str) -> DataFrame:
    """Shuffle files of the write go with its end: whoever reads the table never reads them."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_CONF, "false")
    conf.set(CLEAN_CONF, "true")
    try:
        return materialize(df, path)
    finally:
        conf.set(CLEAN_CONF, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: later steps start there, whichever executors are lost."""
    return _written_to(df, scratch_dir(df.sparkSession, label))


class Scratch:
    """The written tables of one job, which deletes those that none of its later steps reads."""

    def __init__(self) -> None:
        self._held: list[tuple[DataFrame, str]] = []

    def written(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(df.sparkSession, label)
        out = _written_to(df, path)
        self._held.append((out, path))
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        for out, path in [x for x in self._held if any(x[0] is f for f in frames)]:
            drop_path(out.sparkSession, path)
        self._held = [x for x in self._held if not any(x[0] is f for f in frames)]


def marked(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``rows`` with hit: true wherever ``key`` (long) is among ``ids`` (one column), and for few others, which an exact join of the hits
    removes. The rows are not shuffled for it: tasks get a bitmap of at most MARK_BITS bits. A null key is no hit."""
    def slot(column: Column) -> Column:
        return F.pmod(F.xxhash64(column.cast("long")), F.lit(1 << MARK_BITS))

    words = ids.toDF("id").where("id is not null").select(slot(F.col("id")).alias("slot"))
    words = words.groupBy(F.expr("slot div 64").alias("_at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("_bits"))
    placed = rows.withColumn("_slot", F.when(F.col(key).isNotNull(), slot(F.col(key))))
    hit = F.expr("shiftrightunsigned(_bits, cast(_slot % 64 as int)) & 1L") == 1
    return placed.join(F.broadcast(words), F.expr("_slot div 64") == F.col("_at"), "left").select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("hit"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece have about ``limit`` bytes; a longer text stands alone."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def releasing(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` over batches, after which its worker gives freed memory back: it stays alive beside the stages that follow."""
    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
        if trim is not None:
            trim(0)

    return run


def by_bucket(bucket: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of rows by bucket, and where each bucket starts in it."""
    order = np.argsort(bucket.astype(np.uint16 if n_buckets <= 65536 else np.uint32), kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=n_buckets))])


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """n numbers that repartition(n, column) deals to n different partitions."""
    at = F.pmod(F.hash(F.col("id")), F.lit(n))
    rows = spark.range(40 * n + 400).groupBy(at.alias("at")).agg(F.min("id").alias("id")).collect()
    found = {r["at"]: r["id"] for r in rows}
    return [found.get(k, -1 - k) for k in range(n)]


def summed_counts(df: DataFrame, numbers, size: int, n_slices: int = 64) -> np.ndarray:
    """How often each number below ``size`` comes in the arrays that ``numbers(batches)`` yields over all partitions.

    Tasks send their counts in slices, which are summed apart; the driver gets one array of ``size``.
    """
    width = -(-size // n_slices)

    def count(batches):
        total = np.zeros(width * n_slices, np.int64)
        for found in numbers(batches):
            total += np.bincount(found, minlength=width * n_slices)
        full = [k for k in range(n_slices) if total[k * width:(k + 1) * width].any()]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([total[k * width:(k + 1) * width].tobytes() for k in full], pa.binary())], ["slice", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(b, np.int64)
                sums[k] = sums[k] + part if k in sums else part
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["slice", "counts"])

    partial = df.mapInArrow(releasing(count), "slice long, counts binary").repartition(n_slices, "slice")
    out = np.zeros((n_slices, width), np.int64)
    for row in partial.mapInArrow(releasing(add), "slice long, counts binary").collect():
        out[row["slice"]] = np.frombuffer(bytes(row["counts"]), np.int64)
    return out.reshape(-1)[:size]


def components(edges: DataFrame, label: str = "components", scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node that is reachable.

    Each round points every node to its smallest neighbour and contracts the edges along these pointers; edges inside
    a contracted node go. Rounds are written tables; all but the result, which ``scratch`` owns, are deleted once they
    are used. A hub is a key of grouped minima only, combined on the map side.
    """
    scratch = scratch or Scratch()
    edges = scratch.written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), label)
    roots = scratch.written(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")), label)
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = scratch.written(both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("low")).select("at", F.least("at", "low").alias("to")), label)
        moved = scratch.written(roots.join(up, roots["root"] == up["at"], "left").select("node", F.coalesce("to", "root").alias("root")), label)
        left, right = up.toDF("a", "p"), up.toDF("b", "q")
        fewer = scratch.written(edges.join(left, "a").join(right, "b").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).where("a < b").distinct(), label)
        scratch.drop(edges, roots, up)
        edges, roots = fewer, moved
    scratch.drop(edges)
    return roots
