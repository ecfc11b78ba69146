"""Table profiles: counts, moments, exact quartiles, histograms and value lists.

Every profile turns the columns into (column, value) rows that are aggregated before
they are shuffled, so it is one pass however many columns there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.geo import NORTH_AMERICA, Extent
from tidemark.functions.values import left_closed_bin
from tidemark.operators.columns import quoted
from tidemark.operators.selection import quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def unpivoted(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Rows (column_name, value) of the given columns, nulls included."""
    cells = [F.struct(F.lit(c).alias("column_name"), quoted(c).cast(kind).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def column_info(df: DataFrame) -> DataFrame:
    """Type and non-null count of every column, from one aggregate."""
    counts = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    cells = [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.col(f"n{i}").alias("non_null"))
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*cells)))


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column."""
    values = unpivoted(df, list(columns or numeric_columns(df)), "double")
    moments = values.groupBy("column_name").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = quantiles(values, [0.25, 0.5, 0.75]).groupBy("column_name").agg(*[
        F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name)
        for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
    ])
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", "q1", "median", "q3", "max")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency of each non-null value of each column."""
    return unpivoted(df, columns, "string").where("value IS NOT NULL").groupBy("column_name", "value").agg(
        F.count("*").alias("n"))


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most common value and its frequency; the smallest value wins a tie."""
    counts = unpivoted(df, list(columns or text_columns(df)), "string").groupBy("column_name", "value").agg(
        F.count("*").alias("n"))
    known = F.col("value").isNotNull()
    return counts.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n"), F.count("value").alias("n_unique"),
        F.min_by("value", F.when(known, F.struct((-F.col("n")).alias("o"), "value"))).alias("top"),
        F.max(F.when(known, F.col("n"))).alias("freq"),
    )


def distinct_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The distinct values of each text column, null included, as (column_name, value) rows."""
    return unpivoted(df, list(columns or text_columns(df)), "string").distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Number of distinct non-null values per text column; sketched when ``approximate``."""
    values = unpivoted(df, list(columns or text_columns(df)), "string")
    if approximate:
        return values.groupBy("column_name").agg(F.approx_count_distinct("value").alias("n_unique"))
    return values.distinct().groupBy("column_name").agg(F.count("value").alias("n_unique"))


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins per numeric column; bins without values are left out."""
    values = unpivoted(df, list(columns or numeric_columns(df)), "double").where("value IS NOT NULL")
    # One row per column: bounded by the schema.
    ranges = values.groupBy("column_name").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    placed = values.join(F.broadcast(ranges), "column_name").withColumn(
        "bin", left_closed_bin(F.col("value"), F.col("low"), F.col("high"), bins))
    return placed.groupBy("column_name", "bin", "low", "high").agg(F.count("*").alias("n"))


def filter_counts(df: DataFrame, extent: Extent = NORTH_AMERICA) -> DataFrame:
    """Rows before and after the region filter, from one scan."""
    inside = extent.contains("latitude", "longitude")
    return df.agg(F.count("*").alias("rows_before"), F.count_if(inside).alias("rows_after"))


def longest_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Length of the longest value of each text column."""
    values = unpivoted(df, list(columns or text_columns(df)), "string")
    return values.groupBy("column_name").agg(F.max(F.length("value")).alias("max_length"))
