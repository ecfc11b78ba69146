"""Second-step summaries of the marts: what each dashboard view shows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import CARDINALS, cardinal_direction
from tidemark.functions.values import (
    quarter_label, right_closed_bin, scaled_to_max, year_month_label,
)
from tidemark.operators.clean import filter_in_list
from tidemark.operators.selection import quantiles
from tidemark.plans.warehouse import SPECIES_RANKS

# Rows shown by the ranked views, the exposure that is flagged, and the score weights.
TOP_TAXA, TOP_METHODS, TOP_METHOD_BARS = 20, 30, 15
FLAG_EXPOSURE = 50
RISK_WEIGHT_MEASUREMENT, RISK_WEIGHT_DIVERSITY = 0.6, 0.4
WAVE_BINS = 5

# Display names of the taxon report.
REPORT_NAMES = {
    "kingdom": "Reino", "phylum": "Filo", "class": "Clase", "order_name": "Orden",
    "num_especies": "Num Especies", "avg_microplasticos": "Microplásticos", "avg_wave_height": "Oleaje (m)",
}


def column_maximum(df: DataFrame, column: str):
    """The maximum as a scalar subquery: one small aggregate, computed once."""
    return df.agg(F.max(column).alias("m")).scalar()


def with_zeros(df: DataFrame) -> DataFrame:
    """Every missing number as zero."""
    return df.fillna(0)


def zones_in_oceans(zones: DataFrame, oceans: Sequence[str] | None) -> DataFrame:
    """The chosen oceans of the ranked zones; the choice acts after the ranking."""
    return filter_in_list(zones, "ocean", oceans)


def with_month_label(trends: DataFrame) -> DataFrame:
    return trends.withColumn("fecha", year_month_label("year", "month"))


def complete_domain(df: DataFrame, column: str, values: Sequence, kind: str) -> DataFrame:
    """All values of a fixed domain in order, with zeros where the frame has none."""
    listed = F.array(*[F.lit(v).cast(kind) for v in values])
    domain = df.sparkSession.range(1).select(F.posexplode(listed).alias("_pos", column))
    return domain.join(df, column, "left").fillna(0).orderBy("_pos").drop("_pos")


def quarter_profile(trends: DataFrame) -> DataFrame:
    """Unweighted mean of the monthly means by quarter, all four quarters present."""
    means = trends.groupBy("quarter").agg(
        F.avg("avg_microplasticos").alias("avg_microplasticos"), F.avg("avg_wave_height").alias("avg_wave_height"),
    )
    return complete_domain(means, "quarter", [1, 2, 3, 4], "int").withColumn("quarter_label", quarter_label("quarter"))


def _taxon_rollup(groups: DataFrame, by: Sequence[str]):
    return groups.dropna(subset=list(by)).groupBy(*by).agg(
        F.sum("num_especies").alias("num_especies"), F.avg("avg_microplasticos").alias("avg_microplasticos"),
    )


def phylum_rollup(groups: DataFrame, limit: int = TOP_TAXA) -> DataFrame:
    return _taxon_rollup(groups, ["phylum"]).orderBy(F.desc("num_especies"), "phylum").limit(limit)


def family_rollup(groups: DataFrame, limit: int = TOP_TAXA) -> DataFrame:
    return _taxon_rollup(groups, ["family"]).orderBy(F.desc("num_especies"), "family").limit(limit)


def exposure_rollup(groups: DataFrame, limit: int = TOP_TAXA) -> DataFrame:
    rollup = _taxon_rollup(groups, ["phylum", "family"])
    return rollup.orderBy(F.desc("avg_microplasticos"), "phylum", "family").limit(limit)


def taxon_report(groups: DataFrame, limit: int = TOP_TAXA) -> DataFrame:
    """The first taxonomic groups under display names, with heavy exposure flagged."""
    top = groups.orderBy(F.desc("num_especies"), *SPECIES_RANKS[:-1]).limit(limit)
    shown = top.select(*[F.col(c).alias(n) for c, n in REPORT_NAMES.items()])
    exposure = F.col(f"`{REPORT_NAMES['avg_microplasticos']}`")
    return shown.withColumn("flag", exposure > FLAG_EXPOSURE)


def zone_risk(hotspots: DataFrame) -> DataFrame:
    """Risk score of each location, and its marker size.

    High measurement and low diversity score high; a zero maximum gives a null score.
    """
    m_max = column_maximum(hotspots, "microplasticos")
    b_max = column_maximum(hotspots, "biodiversidad")
    measured = F.try_divide(F.col("microplasticos"), m_max) * RISK_WEIGHT_MEASUREMENT
    diversity = F.try_divide(F.coalesce("biodiversidad", F.lit(0)).cast("double"), b_max)
    return hotspots.withColumns({
        "riesgo_score": measured + (1 - diversity) * RISK_WEIGHT_DIVERSITY,
        "marker_size": F.try_divide(F.col("microplasticos"), m_max) * 30 + 8,
    })


def method_bars(sampling: DataFrame, limit: int = TOP_METHOD_BARS) -> DataFrame:
    """The most used method and class combinations."""
    order = ["sampling_method", "concentration_class_range", "concentration_class_text"]
    return sampling.orderBy(F.desc("num_observaciones"), *order).limit(limit).select(*order, "num_observaciones")


def method_rollup(sampling: DataFrame, limit: int = TOP_METHODS) -> DataFrame:
    """By method; marker sizes are relative to the largest method of all."""
    methods = sampling.dropna(subset=["sampling_method"]).groupBy("sampling_method").agg(
        F.avg("avg_wave_height").alias("avg_wave_height"), F.avg("avg_microplasticos").alias("avg_microplasticos"),
        F.sum("num_observaciones").alias("num_observaciones"),
    )
    largest = column_maximum(methods, "num_observaciones")
    return methods.orderBy(F.desc("num_observaciones"), "sampling_method").limit(limit).withColumn(
        "marker_size", scaled_to_max("num_observaciones", largest, 30, 6))


def wave_scatter(correlation: DataFrame) -> DataFrame:
    """Complete rows only, with marker sizes by observation count."""
    columns = ["wave_height_max", "swell_wave_height_max", "avg_microplasticos", "num_observaciones", "num_especies"]
    complete = correlation.select(*columns).dropna()
    return complete.withColumn(
        "marker_size", scaled_to_max("num_observaciones", column_maximum(complete, "num_observaciones"), 20, 6))


CORRELATED = ["wave_height_max", "wave_period_max", "swell_wave_height_max", "avg_microplasticos", "num_especies"]
# Fixed value: a correlation needs more complete rows than this.
MIN_CORRELATION_ROWS = 3


def correlation_matrix(correlation: DataFrame, more_than: int = MIN_CORRELATION_ROWS) -> DataFrame:
    """Pearson matrix as rows (variable_i, variable_j, r), from one aggregate over complete rows.

    No rows unless there are ``more_than`` complete ones (0: always a matrix of any rows); r is null when a variable is constant.
    """
    complete = correlation.select(*[F.col(c).cast("double").alias(c) for c in CORRELATED]).dropna()
    pairs = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i:]]
    row = complete.agg(
        F.count("*").alias("n"),
        *[F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias(f"r_{a}_{b}") for a, b in pairs],
    )
    cells = [
        F.struct(F.lit(a).alias("variable_i"), F.lit(b).alias("variable_j"),
                 F.col(f"r_{a}_{b}" if (a, b) in pairs else f"r_{b}_{a}").alias("r"))
        for a in CORRELATED for b in CORRELATED
    ]
    return row.where(F.col("n") > more_than).select(F.inline(F.array(*cells)))


def with_wave_bin(correlation: DataFrame, bins: int = WAVE_BINS) -> DataFrame:
    """Equal-width right-closed bins of wave height; null heights have no bin."""
    low = correlation.agg(F.min("wave_height_max").alias("m")).scalar()
    high = column_maximum(correlation, "wave_height_max")
    return correlation.withColumn("wave_bin", right_closed_bin(F.col("wave_height_max"), low, high, bins))


def bin_rollup(correlation: DataFrame, bins: int = WAVE_BINS) -> DataFrame:
    return with_wave_bin(correlation, bins).dropna(subset=["wave_bin"]).groupBy("wave_bin").agg(
        F.avg("avg_microplasticos").alias("avg_microplasticos"), F.sum("num_especies").alias("num_especies"),
        F.sum("num_observaciones").alias("num_observaciones"),
    )


def bin_box_stats(correlation: DataFrame, bins: int = WAVE_BINS) -> DataFrame:
    """Box-plot figures of the exposure per wave bin, with exact quartiles."""
    binned = with_wave_bin(correlation, bins).dropna(subset=["wave_bin"])
    ends = binned.groupBy("wave_bin").agg(
        F.count("*").alias("n"), F.min("avg_microplasticos").alias("low"), F.max("avg_microplasticos").alias("high"))
    values = binned.select(F.col("wave_bin").cast("string").alias("column_name"), F.col("avg_microplasticos").alias("value"))
    quartiles = quantiles(values, [0.25, 0.5, 0.75]).groupBy(F.col("column_name").alias("_bin")).agg(*[
        F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name) for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    # One row for each bin.
    return ends.join(F.broadcast(quartiles), F.col("wave_bin").cast("string") == F.col("_bin"), "left").select(
        "wave_bin", "n", "low", "q1", "median", "q3", "high")


def direction_means(correlation: DataFrame) -> DataFrame:
    """Mean exposure per compass point that occurs."""
    known = correlation.dropna(subset=["wave_direction_dominant"])
    return known.groupBy(cardinal_direction("wave_direction_dominant").alias("cardinal")).agg(
        F.avg("avg_microplasticos").alias("avg_microplasticos"))


def direction_rollup(correlation: DataFrame) -> DataFrame:
    """All eight compass points in order, zero where none occurs."""
    return complete_domain(direction_means(correlation), "cardinal", CARDINALS, "string")

