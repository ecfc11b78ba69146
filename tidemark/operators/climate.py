"""Climate readings: monthly means per cell, history upkeep and request ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import NORTH_AMERICA, Extent, ocean_by_longitude
from tidemark.functions.values import month_key, nan_to_null
from tidemark.schemas import WAVE_COLUMNS

# Fixed value: newest date assumed when there is no history yet.
NO_HISTORY_DATE = "2023-12-31"
# Fixed value: setting written on every scaffolded reading.
SCAFFOLD_SETTING = "Beach"


def monthly_climate(climate: DataFrame, order_by: str = "date") -> DataFrame:
    """Mean waves per cell and month of the year, all years pooled, with the first known ocean.

    The first pass also groups by ocean, so that it needs only sums, counts and minima
    of plain numbers and runs as a hash aggregate with map-side combining; the second
    works on at most a few rows per cell and month.
    """
    keyed = climate.where("grid_id IS NOT NULL").withColumn("month", month_key("date")).where("month IS NOT NULL")
    partial = keyed.groupBy("grid_id", "month", "ocean").agg(
        F.max("grid_lat").alias("grid_lat"), F.max("grid_lon").alias("grid_lon"),
        F.min(order_by).alias("_first"),
        *[F.sum(c).alias(f"_sum_{c}") for c in WAVE_COLUMNS],
        *[F.count(c).alias(f"_n_{c}") for c in WAVE_COLUMNS],
    )
    return partial.groupBy("grid_id", "month").agg(
        F.max("grid_lat").alias("grid_lat"), F.max("grid_lon").alias("grid_lon"),
        *[F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}")).alias(c) for c in WAVE_COLUMNS],
        F.min_by("ocean", F.when(F.col("ocean").isNotNull(), F.struct("_first", "ocean"))).alias("ocean"),
    )


def last_date(history: DataFrame) -> DataFrame:
    """Newest date in the history, or the agreed start when it is empty."""
    newest = F.max(F.col("date").cast("date"))
    return history.agg(
        F.coalesce(newest, F.lit(NO_HISTORY_DATE).cast("date")).alias("last_date"),
        (F.count("date") > 0).alias("history_exists"),
    )


def next_range(history: DataFrame, days_per_batch: int = 365, earliest: str = "1972-01-01", anchor: str = "max") -> DataFrame:
    """The days to request next: a window ending the day before the anchor date.

    ``anchor="max"`` walks back from the newest date on every run; ``"min"`` walks back
    from the oldest one, which does not request the same days again. Both dates are
    null once the earliest date has been passed.
    """
    pick = {"max": F.max, "min": F.min}[anchor]
    start_of_walk = F.coalesce(pick(F.col("date").cast("date")), F.lit(NO_HISTORY_DATE).cast("date"))
    floor = F.lit(earliest).cast("date")
    end = F.date_sub(F.col("anchor_date"), 1)
    start = F.greatest(F.date_sub(end, days_per_batch - 1), floor)
    return history.agg(start_of_walk.alias("anchor_date")).select(
        F.when(end >= floor, start).alias("start_date"), F.when(end >= floor, end).alias("end_date")
    )


def scaffold(cells: DataFrame, readings: DataFrame, start: str, end: str) -> DataFrame:
    """One row per cell and day of the range, with the landed reading where there is one.

    ``readings`` hold one row per (grid_id, date).
    """
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    wanted = cells.select("grid_id", "grid_lat", "grid_lon", F.explode(days).alias("date"))
    landed = readings.select("grid_id", F.col("date").cast("date").alias("date"), *WAVE_COLUMNS)
    return wanted.join(landed, ["grid_id", "date"], "left").select(
        "date", "grid_id", F.col("grid_lat").alias("latitude"), F.col("grid_lon").alias("longitude"),
        ocean_by_longitude("grid_lon").alias("ocean"), F.lit(SCAFFOLD_SETTING).alias("marine_setting"),
        *[nan_to_null(c).alias(c) for c in WAVE_COLUMNS],
    )


def new_readings(readings: DataFrame, catalog: DataFrame, start: str, end: str) -> DataFrame:
    """Readings of the range that belong to catalogued cells, wherever these lie.

    Nothing bounds the catalogue here, so it is joined without a hint; Spark broadcasts it where it is small.
    """
    known = catalog.select("grid_id").distinct()
    in_range = readings.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return in_range.join(known, "grid_id", "left_semi")


def with_extraction_time(df: DataFrame) -> DataFrame:
    return df.withColumn("extraction_timestamp", F.current_timestamp())


def history_summary(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count("*").alias("total_rows"), F.max("date").alias("newest"), F.min("date").alias("oldest"),
        F.count_distinct("grid_id").alias("cells"),
    )


def extract_summary(new: DataFrame) -> DataFrame:
    return new.agg(F.count("*").alias("new_rows"), F.count_distinct("grid_id").alias("cells_covered"))
