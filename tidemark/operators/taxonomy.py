"""Species communities: the first names and the most common ranks of each cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.columns import quoted
from tidemark.schemas import RANKS

# Names kept per cell and the text between them.
NAMES_PER_CELL = 20
NAME_SEPARATOR = "|"
_NAME = "scientific_name"


def community_by_cell(occurrences: DataFrame, order_by: str, max_names: int = NAMES_PER_CELL) -> DataFrame:
    """Per cell: the first distinct names in encounter order, and the mode of each rank.

    The smallest of equally common values wins, nulls do not count. One pass over the
    occurrences: they are first reduced to distinct taxa per cell, then each taxon is
    unfolded into its name and ranks, so what the ranking window sorts is the names and
    rank values of a cell, not its records.
    """
    taxa = (
        occurrences.where("grid_id IS NOT NULL")
        .groupBy("grid_id", _NAME, *[quoted(r) for r in RANKS])
        .agg(
            F.count("*").alias("n"), F.min(order_by).alias("first_seen"),
            F.max("grid_lat").alias("grid_lat"), F.max("grid_lon").alias("grid_lon"),
        )
    )
    attributes = F.explode(F.array(*[
        F.struct(F.lit(a).alias("attribute"), quoted(a).alias("value")) for a in (_NAME, *RANKS)
    ]))
    values = (
        taxa.select("grid_id", "grid_lat", "grid_lon", "n", "first_seen", attributes.alias("_a"))
        .select("grid_id", "grid_lat", "grid_lon", "n", "first_seen", "_a.attribute", "_a.value")
        .groupBy("grid_id", "attribute", "value")
        .agg(
            F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"),
            F.max("grid_lat").alias("grid_lat"), F.max("grid_lon").alias("grid_lon"),
        )
    )
    is_name = F.col("attribute") == _NAME
    ranking = Window.partitionBy("grid_id", "attribute").orderBy(
        F.col("value").isNull(), F.when(is_name, F.lit(0)).otherwise(-F.col("n")),
        F.when(is_name, F.col("first_seen")), "value",
    )
    kept = values.withColumn("rn", F.row_number().over(ranking)).where(F.col("rn") <= max_names)
    names = F.array_sort(F.collect_list(F.when(is_name & F.col("value").isNotNull(), F.struct("rn", "value"))))
    return kept.groupBy("grid_id").agg(
        F.max("grid_lat").alias("grid_lat"), F.max("grid_lon").alias("grid_lon"),
        F.array_join(F.transform(names, lambda x: x["value"]), NAME_SEPARATOR).alias(_NAME),
        *[F.max(F.when((F.col("attribute") == r) & (F.col("rn") == 1), F.col("value"))).alias(r) for r in RANKS],
    )
