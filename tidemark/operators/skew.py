"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, scratch_dir

DEFAULT_SALTS = 32
HOT_SHARE = 1000


def salted_lookup(left: DataFrame, right: DataFrame, on: Sequence[str], salts: int = DEFAULT_SALTS) -> DataFrame:
    """Left join against a side with unique keys, each key spread over ``salts`` tasks.

    The left rows are dealt out in turn, whatever their values, and the right side is
    repeated once per salt; so a key that holds a third of the rows gives each task at
    most a third divided by ``salts``.
    """
    dealt = left.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    spread = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(spread, [*on, "_salt"], "left").drop("_salt")


def _joined_by_counts(left: DataFrame, counted: DataFrame, on: Sequence[str], count_column: str, how: str) -> DataFrame:
    """Left rows with the columns of ``counted``, whose keys are unique and have their left row counts.

    The counts are written once and then say both which keys are hot and what is found. Keys with more than one in
    ``HOT_SHARE`` of all rows, of which there are at most ``HOT_SHARE``, are broadcast to deal their left rows out over
    ``DEFAULT_SALTS`` tasks; all rows then go through one join. So the left is read once here, and no key meets in one task.
    """
    counted = materialize(counted, scratch_dir(left.sparkSession, "counts"))
    names = {c: f"_k{i}" for i, c in enumerate(on)}
    keys = list(names.values())
    known = counted.withColumnsRenamed(names)
    total = counted.agg(F.sum(count_column)).scalar()
    hot = known.where(F.col(count_column) * HOT_SHARE > total).select(*keys)

    def same(other: Sequence[str]) -> Column:
        condition = F.lit(True)
        for c, k in zip(on, other, strict=True):
            condition = condition & F.col(f"`{c}`").eqNullSafe(F.col(k))
        return condition

    marks = hot.withColumnsRenamed({k: f"{k}h" for k in keys}).withColumn("_hot", F.lit(True))
    dealt = left.join(F.broadcast(marks), same([f"{k}h" for k in keys]), "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(DEFAULT_SALTS)).cast("int")).otherwise(0)).drop("_hot", *[f"{k}h" for k in keys])
    is_hot = F.col(count_column) * HOT_SHARE > total
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(DEFAULT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = known.withColumn("_at", F.explode(salts)).drop(count_column)
    return dealt.join(spread, same(keys) & (F.col("_salt") == F.col("_at")), how).drop("_salt", "_at", *keys)


def semi_join_counted(left: DataFrame, counted: DataFrame, on: Sequence[str], count_column: str) -> DataFrame:
    """Left rows whose key is in ``counted``, a frame of unique keys with their left row counts; null matches null."""
    return _joined_by_counts(left, counted.select(*[F.col(f"`{c}`") for c in on], count_column), on, count_column, "inner")


def lookup_counted(left: DataFrame, right: DataFrame, on: Sequence[str], count_column: str) -> DataFrame:
    """Left join against ``right``: one row for every key of the left, with its left row count; null matches null."""
    return _joined_by_counts(left, right, on, count_column, "left")
