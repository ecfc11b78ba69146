"""Nearest-date join within a tolerance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import lookup_counted


def nearest_date_join(
    left: DataFrame, right: DataFrame, key: str, date: str, values: Sequence[str], tolerance_days: int = 60,
) -> DataFrame:
    """Left rows with the values of the right row nearest in time, at most ``tolerance_days`` off.

    Equal distances take the earlier date. ``right`` has one row per (key, date), both
    dates are of type date.

    Days are cut into spans as long as the tolerance and each right row is copied to its
    own and the two adjoining spans, so a left date finds every row in reach within its
    own span. The search runs on the distinct left (key, date) pairs: a span then holds
    no more than its days, however many rows share a day, and every window stays small.
    The result is handed back to the rows by their counts: hot pairs broadcast, others shuffled.
    """
    span = F.floor(F.unix_date(F.col(date)) / (tolerance_days + 1))
    # Pairs with a null part find nothing; they are not filtered out, since the filter would
    # be pushed down to the rows and evaluate the key expression once more for each.
    asked = left.groupBy(key, date).agg(F.count("*").alias("_n")).select(
        key, F.col(date), "_n", span.alias("_span"), F.lit(None).cast("date").alias("_at"),
        F.lit(True).alias("_asked"), F.lit(None).cast(_struct_type(right, values)).alias("_v"),
    )
    known = right.select(key, date, *values).dropna(subset=[key, date]).select(
        key, F.col(date), F.lit(0).cast("bigint").alias("_n"),
        F.explode(F.sequence(span - 1, span + 1)).alias("_span"), F.col(date).alias("_at"),
        F.lit(False).alias("_asked"), F.struct(*values).alias("_v"),
    )
    # Both frames grow from the start of their order, which Spark evaluates in one pass.
    before = Window.partitionBy(key, "_span").orderBy(date).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(key, "_span").orderBy(F.desc(date)).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    reading = F.when(~F.col("_asked"), F.struct("_at", "_v"))
    both = asked.unionByName(known).select(
        key, date, "_asked", "_n",
        F.last(reading, ignorenulls=True).over(before).alias("_b"),
        F.last(reading, ignorenulls=True).over(after).alias("_f"),
    ).where("_asked")
    back, ahead = F.datediff(F.col(date), F.col("_b._at")), F.datediff(F.col("_f._at"), F.col(date))
    take_back = back.isNotNull() & (ahead.isNull() | (back <= ahead))
    near = F.when(take_back, back).otherwise(ahead)
    found = both.select(
        key, date, "_n", F.when(near <= tolerance_days, near).alias("days_apart"),
        F.when(near <= tolerance_days, F.when(take_back, F.col("_b")).otherwise(F.col("_f"))).alias("_hit"),
    ).select(
        key, date, "_n", F.col("_hit._at").alias("matched_date"), "days_apart",
        *[F.col(f"_hit._v.{v}").alias(v) for v in values],
    )
    return lookup_counted(left, found, [key, date], "_n")


def _struct_type(df: DataFrame, columns: Sequence[str]):
    return df.select(F.struct(*columns).alias("s")).schema["s"].dataType
