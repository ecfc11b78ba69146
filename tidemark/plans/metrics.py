"""Yearly metrics and the messages that carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.marts import mean_measurement, n_observations, n_species, summed_facts
from tidemark.plans.warehouse import DATE_FK, LOCATION_FK, Warehouse

# The message types.
CONCENTRATION, RISK = "avg_concentration_by_region", "ecological_risk_index"

CONCENTRATION_COLUMNS = ["ocean_region", "environment_type", "avg_concentration", "total_observations", "unit"]
RISK_COLUMNS = ["ocean_region", "environment_type", "total_microplastics", "avg_pollution", "species_count",
                "risk_raw", "risk_index"]


def years(wh: Warehouse) -> DataFrame:
    return wh.dim_date.select("year").distinct().orderBy("year")


def _located(wh: Warehouse, keys: list[str]) -> DataFrame:
    """Sums of dated and located facts by year, location attributes and the given keys."""
    facts = wh.fact.where(F.col(DATE_FK).isNotNull() & F.col(LOCATION_FK).isNotNull())
    sums = summed_facts(wh, facts, [LOCATION_FK, "obs_year", *keys])
    places = wh.dim_location.select(
        F.col("location_id").alias(LOCATION_FK), F.col("ocean").alias("ocean_region"),
        F.col("marine_setting").alias("environment_type"),
    )
    return sums.join(places, LOCATION_FK).withColumnRenamed("obs_year", "year")


def avg_concentration(wh: Warehouse) -> DataFrame:
    """Mean and count by year, ocean, setting and unit; all years in one job."""
    groups = _located(wh, ["unit"]).groupBy("year", "ocean_region", "environment_type", "unit")
    return groups.agg(
        mean_measurement().alias("avg_concentration"), n_observations().alias("total_observations"),
    ).select("year", *CONCENTRATION_COLUMNS)


def risk_raw(wh: Warehouse) -> DataFrame:
    """Mean pollution times distinct species by year, ocean and setting."""
    groups = _located(wh, []).groupBy("year", "ocean_region", "environment_type").agg(
        n_observations().alias("total_microplastics"), mean_measurement().alias("avg_pollution"),
        n_species().alias("species_count"),
    )
    return groups.withColumn("risk_raw", F.col("avg_pollution") * F.col("species_count"))


def with_risk_index(raw: DataFrame) -> DataFrame:
    """Min-max of the raw risk within each year on 0 to 100; 0 when all are equal.

    The window runs over the few ocean and setting groups of a year, not over facts.
    """
    year = Window.partitionBy("year")
    low, high = F.min("risk_raw").over(year), F.max("risk_raw").over(year)
    scaled = F.try_divide((F.col("risk_raw") - low) * 100, high - low)
    index = F.when(high == low, F.lit(0.0)).otherwise(scaled)
    return raw.withColumn("risk_index", index).select("year", *RISK_COLUMNS)


def ecological_risk(wh: Warehouse) -> DataFrame:
    return with_risk_index(risk_raw(wh))


def _rank_column(metric: str) -> str:
    return "avg_concentration" if metric == CONCENTRATION else "risk_raw"


def envelopes(metric: str, rows: DataFrame, all_years: DataFrame | None = None, sent_at: Column | None = None) -> DataFrame:
    """One message per year: key, JSON value, and the parts it is made of.

    The rows of a year are its ocean, setting and unit groups. With ``all_years`` a
    year without rows gets an empty message.
    """
    names = [c for c in rows.columns if c != "year"]
    ordered = F.struct((-F.col(_rank_column(metric))).alias("_rank"), *names)
    grouped = rows.groupBy("year").agg(F.array_sort(F.collect_list(ordered)).alias("_rows"))
    if all_years is not None:
        grouped = all_years.select("year").join(grouped, "year", "left")
    plain = F.transform("_rows", lambda r: F.struct(*[r[n].alias(n) for n in names]))
    kind = rows.select(F.array(F.struct(*names)).alias("a")).schema["a"].dataType
    data = F.coalesce(plain, F.array().cast(kind))
    stamp = sent_at if sent_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    message = grouped.select(
        F.lit(metric).alias("metric_type"), "year", stamp.alias("timestamp"), data.alias("data"),
        F.size(data).alias("record_count"),
    )
    # Not by the streaming package, which reads these messages and so depends on this module.
    value = F.to_json(F.struct("metric_type", "year", "timestamp", "data", "record_count"), {"ignoreNullFields": "false"})
    return message.withColumns({"key": F.col("metric_type"), "value": value})


def publish(wh: Warehouse, sent_at: Column | None = None) -> DataFrame:
    """The messages of both metrics for every year."""
    first = envelopes(CONCENTRATION, avg_concentration(wh), years(wh), sent_at)
    second = envelopes(RISK, ecological_risk(wh), years(wh), sent_at)
    columns = ["metric_type", "year", "record_count", "key", "value"]
    return first.select(*columns).unionByName(second.select(*columns))
