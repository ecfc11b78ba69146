"""Views over the live state: latest rows per key and what is shown of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.metrics import CONCENTRATION, RISK

# The keys under which the latest row of each metric is kept, and its other columns.
CONCENTRATION_KEY = ["year", "ocean_region", "environment_type", "unit"]
CONCENTRATION_VALUES = ["avg_concentration", "total_observations"]
RISK_KEY = ["year", "ocean_region", "environment_type"]
RISK_VALUES = ["avg_pollution", "species_count", "total_microplastics", "risk_raw", "risk_index"]
KEYS = {CONCENTRATION: (CONCENTRATION_KEY, CONCENTRATION_VALUES), RISK: (RISK_KEY, RISK_VALUES)}
RECENT_KEPT, RECENT_SHOWN = 500, 20


def has_null_key(metric: str) -> Column:
    return F.expr(" OR ".join(f"{k} IS NULL" for k in KEYS[metric][0]))


def latest_groups(groups: DataFrame, metric: str, order_by: Sequence[str]) -> DataFrame:
    """For each key the rows of its latest message, as an array, with that message's order."""
    last = F.max_by(F.struct(*order_by, "rows"), F.struct(*order_by))
    return groups.groupBy(*KEYS[metric][0]).agg(last.alias("_v")).select(*KEYS[metric][0], "_v.*")


def rows_of(groups: DataFrame, metric: str) -> DataFrame:
    """The rows of groups, one by one."""
    return groups.select(*KEYS[metric][0], F.inline("rows"))


def latest_by_key(groups: DataFrame, metric: str, order_by: Sequence[str], null_keys: str = "equal") -> DataFrame:
    """The rows of the last message of each key, by arrival. ``groups`` has the rows of a message and key as an array.

    With ``null_keys="append"`` a row with a null key part replaces nothing and is never
    replaced, so all such rows stay. On a stream this needs a table beside the aggregate: see ``streaming.state.LiveTables``.
    """
    if null_keys == "append":
        partial = F.coalesce(has_null_key(metric), F.lit(False))
        kept = latest_by_key(groups.where(~partial), metric, order_by)
        return kept.unionByName(rows_of(groups.where(partial), metric))
    return rows_of(latest_groups(groups, metric, order_by), metric)


def latest_by_type(messages: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The last message of each type."""
    others = [c for c in messages.columns if c != "metric_type"]
    last = F.max_by(F.struct(*others), F.struct(*order_by))
    return messages.groupBy("metric_type").agg(last.alias("_v")).select("metric_type", "_v.*")


def message_counts(messages: DataFrame) -> DataFrame:
    """Messages per type and in total (null type)."""
    return messages.rollup("metric_type").agg(F.count("*").alias("messages"))


def recent_messages(messages: DataFrame, order_by: Sequence[str], keep: int = RECENT_KEPT) -> DataFrame:
    """The newest messages, newest first."""
    return messages.orderBy(*[F.desc(c) for c in order_by]).limit(keep)


def live_kpis(concentration: DataFrame, risk: DataFrame) -> DataFrame:
    """Latest year of either table with its observation sum, mean concentration and mean risk."""
    both = concentration.select("year", "avg_concentration", "total_observations").unionByName(
        risk.select("year", "risk_index"), allowMissingColumns=True)
    by_year = both.groupBy("year").agg(
        F.coalesce(F.sum("total_observations"), F.lit(0)).alias("total_observations"),
        F.avg("avg_concentration").alias("avg_concentration"), F.avg("risk_index").alias("avg_risk"),
    )
    newest = by_year.where("year IS NOT NULL").agg(F.max_by(F.struct("*"), "year").alias("k"))
    return newest.where("k IS NOT NULL").select(
        F.col("k.year").alias("current_year"), "k.total_observations", "k.avg_concentration", "k.avg_risk")


def concentration_pivot(concentration: DataFrame, oceans: Sequence[str]) -> DataFrame:
    """Year by ocean mean concentration, zero where there is none; a null ocean has the empty name."""
    labelled = concentration.withColumn("region_label", F.coalesce("ocean_region", F.lit("")))
    return labelled.groupBy("year").pivot("region_label", list(oceans)).agg(F.avg("avg_concentration")).fillna(0.0)


def observations_by_year(concentration: DataFrame) -> DataFrame:
    """Observation sum per year and the mean of these sums."""
    sums = concentration.groupBy("year").agg(F.sum("total_observations").alias("total_observations"))
    mean = sums.agg(F.avg("total_observations").alias("m")).scalar()
    return sums.withColumn("mean_of_years", mean).orderBy("year")


def risk_series(risk: DataFrame) -> DataFrame:
    """Risk per ocean in order of years, with the carried columns."""
    return risk.dropna(subset=["ocean_region"]).select(
        "ocean_region", "year", "risk_index", "environment_type", "species_count", "total_microplastics",
        "avg_pollution", "risk_raw",
    ).orderBy("ocean_region", "year", "environment_type")
