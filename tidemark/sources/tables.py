"""Relational tables and parameterised queries."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_relational(
    spark: SparkSession,
    table: str,
    url: str | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 64,
    **options: str,
) -> DataFrame:
    """A whole relational table: over JDBC when a URL is given, else a catalogue table or landed Parquet.

    With a partition column the JDBC read is split into ``partitions`` range queries,
    so no single task fetches the whole table.
    """
    if url is None:
        return spark.read.parquet(table) if "/" in table else spark.table(table)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in options.items():
        reader = reader.option(key, value)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions)
        )
    return reader.load()


def run_query(spark: SparkSession, sql: str, params: dict[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """A parameterised SQL query (``:name`` markers); ``{name}`` refers to a frame passed by keyword."""
    return spark.sql(sql, args=params or {}, **frames)
