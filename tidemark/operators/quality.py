"""Data-quality rules, suites and reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import BINOMIAL_PATTERN
from tidemark.operators.columns import project_present, quoted
from tidemark.schemas import CLIMATE_COLUMNS, OBSERVATION_COLUMNS, OCCURRENCE_COLUMNS

REPORT_DDL = (
    "dataset string, stage string, expectation string, column_name string, success boolean, "
    "success_percent double, unexpected_count bigint, element_count bigint"
)
REPORT_COLUMNS = [part.split()[0] for part in REPORT_DDL.split(", ")]

# Names of the rules in a report.
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
REGEX = "expect_column_values_to_match_regex"
UNIQUE = "expect_compound_columns_to_be_unique"


@dataclass(frozen=True)
class Rule:
    """One expectation: ``holds`` maps a column to the condition its non-null values must meet."""

    expectation: str
    columns: tuple[str, ...]
    mostly: float = 1.0
    holds: Callable[[Column], Column] | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def exists(*columns: str) -> list[Rule]:
    return [Rule(EXISTS, (c,)) for c in columns]


def not_null(mostly: float, *columns: str) -> list[Rule]:
    return [Rule(NOT_NULL, (c,), mostly) for c in columns]


def between(column: str, low: float, high: float, mostly: float) -> Rule:
    return Rule(BETWEEN, (column,), mostly, lambda c: c.try_cast("double").between(low, high))


def in_set(column: str, allowed: Sequence[str], mostly: float) -> Rule:
    return Rule(IN_SET, (column,), mostly, lambda c: c.isin(list(allowed)))


def matches(column: str, pattern: str, mostly: float) -> Rule:
    return Rule(REGEX, (column,), mostly, lambda c: c.rlike(pattern))


def unique(columns: Sequence[str], mostly: float) -> Rule:
    return Rule(UNIQUE, tuple(columns), mostly)


# Rule parameters of the three suites.
UNITS = ["items/m3", "items/l", "items/km2", "items/m²", "items/m^3", "particles/m3", "particles/l", "n/m3"]
KINGDOMS = ["Animalia", "Plantae", "Protista", "Fungi", "Chromista", "Bacteria", "Archaea"]
LATITUDES, LONGITUDES = (5, 83), (-180, -50)
MEASUREMENTS, WAVE_HEIGHTS, WAVE_PERIODS, SWELL_HEIGHTS, DIRECTIONS = (0, 1e7), (0, 30), (0, 25), (0, 20), (0, 360)
FIRST_YEAR = 1950


def observation_suite(stage: str = "pre") -> list[Rule]:
    rules = [
        *exists("date", "latitude", "longitude", "microplastics_measurement", "unit", "grid_id", "objectid"),
        *not_null(0.95, "latitude", "longitude", "microplastics_measurement", "grid_id"),
        between("latitude", *LATITUDES, 0.98),
        between("longitude", *LONGITUDES, 0.98),
        between("microplastics_measurement", *MEASUREMENTS, 0.99),
    ]
    if stage != "post":
        rules.append(in_set("unit", UNITS, 0.8))
    return [*rules, unique(["objectid", "grid_id"], 0.90)]


def climate_suite() -> list[Rule]:
    return [
        *exists("date", "latitude", "longitude", "grid_id"),
        *not_null(0.95, "date", "latitude", "longitude", "grid_id"),
        between("latitude", *LATITUDES, 0.99),
        between("longitude", *LONGITUDES, 0.99),
        between("wave_height_max", *WAVE_HEIGHTS, 0.995),
        between("wave_period_max", *WAVE_PERIODS, 0.995),
        between("swell_wave_height_max", *SWELL_HEIGHTS, 0.995),
        between("wind_wave_direction_dominant", *DIRECTIONS, 0.999),
        unique(["date", "grid_id"], 0.95),
    ]


def occurrence_suite(current_year: int) -> list[Rule]:
    return [
        *exists("scientific_name", "latitude", "longitude", "grid_id"),
        *not_null(0.80, "scientific_name", "latitude", "longitude"),
        between("latitude", *LATITUDES, 0.95),
        between("longitude", *LONGITUDES, 0.95),
        between("year", FIRST_YEAR, current_year, 0.95),
        matches("scientific_name", BINOMIAL_PATTERN, 0.70),
        in_set("kingdom", KINGDOMS, 0.80),
    ]


def check(df: DataFrame, rules: Sequence[Rule], dataset: str, stage: str, strict: bool = False) -> DataFrame:
    """One row per rule: share of good values among the non-null ones against ``mostly``.

    All row rules of a dataset share one aggregate; each uniqueness rule is an
    aggregate of group sizes. A rule on an absent column is left out, or fails under
    ``strict``. A column without values passes.
    """
    present = set(df.columns)
    runnable = [r for r in rules if set(r.columns) <= present]
    absent = [r for r in rules if not set(r.columns) <= present]
    row_rules = [r for r in runnable if r.expectation != UNIQUE]

    parts = []
    if row_rules or (strict and absent):
        parts.append(_row_rule_results(df, row_rules, absent if strict else []))
    parts += [_unique_result(df, r) for r in runnable if r.expectation == UNIQUE]
    if not parts:
        return df.sparkSession.createDataFrame([], REPORT_DDL)
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    good = F.try_divide((F.col("considered") - F.col("unexpected")) * 100.0, F.col("considered"))
    percent = F.when(F.col("considered").isNull(), F.when(F.col("found"), 100.0).otherwise(0.0)).otherwise(
        F.coalesce(good, F.lit(100.0)))
    success = F.when(F.col("considered").isNull(), F.col("found")).otherwise(
        F.coalesce(F.try_divide(F.col("considered") - F.col("unexpected"), F.col("considered")), F.lit(1.0))
        >= F.col("mostly"))
    return results.select(
        F.lit(dataset).alias("dataset"), F.lit(stage).alias("stage"), "expectation", "column_name",
        success.alias("success"), F.round(percent, 2).alias("success_percent"),
        F.col("unexpected").alias("unexpected_count"), F.col("elements").alias("element_count"),
    )


def _result(rule: Rule, considered: Column, unexpected: Column, elements: Column, found: bool = True) -> Column:
    return F.struct(
        F.lit(rule.expectation).alias("expectation"), F.lit(rule.label).alias("column_name"),
        F.lit(rule.mostly).alias("mostly"), F.lit(found).alias("found"), considered.alias("considered"),
        unexpected.alias("unexpected"), elements.alias("elements"),
    )


def _row_rule_results(df: DataFrame, rules: Sequence[Rule], absent: Sequence[Rule]) -> DataFrame:
    aggregates = [F.count("*").alias("total")]
    results = [_result(r, _none(), _none(), _none(), found=False) for r in absent]
    for i, rule in enumerate(rules):
        if rule.expectation == EXISTS:
            results.append(_result(rule, _none(), _none(), _none()))
            continue
        value = quoted(rule.columns[0])
        aggregates.append(F.count(value).alias(f"v{i}"))
        if rule.expectation == NOT_NULL:
            results.append(_result(rule, F.col("total"), F.col("total") - F.col(f"v{i}"), F.col("total")))
        else:
            aggregates.append(F.count_if(value.isNotNull() & ~rule.holds(value)).alias(f"u{i}"))
            results.append(_result(rule, F.col(f"v{i}"), F.col(f"u{i}"), F.col("total")))
    return df.agg(*aggregates).select(F.inline(F.array(*results)))


def _none() -> Column:
    return F.lit(None).cast("bigint")


def _unique_result(df: DataFrame, rule: Rule) -> DataFrame:
    """All members of duplicated groups are unexpected; rows whose key parts are all null do not count."""
    sizes = df.groupBy(*[quoted(c) for c in rule.columns]).agg(F.count("*").alias("n"))
    keyed = F.coalesce(*[quoted(c).cast("string") for c in rule.columns]).isNotNull()
    zero = F.lit(0)
    return sizes.agg(
        F.coalesce(F.sum(F.when(keyed, F.col("n"))), zero).alias("considered"),
        F.coalesce(F.sum(F.when(keyed & (F.col("n") > 1), F.col("n"))), zero).alias("unexpected"),
        F.coalesce(F.sum("n"), zero).alias("elements"),
    ).select(F.inline(F.array(_result(rule, F.col("considered"), F.col("unexpected"), F.col("elements")))))


# The columns of a report's rows.
SUMMARY_COLUMNS = ["dataset", "stage", "expectation", "success", "success_percent", "unexpected_count", "element_count"]


def summary(report: DataFrame) -> DataFrame:
    """The rows of a report, one per rule."""
    return report.select(*SUMMARY_COLUMNS)


def overall(report: DataFrame) -> DataFrame:
    """Rules passed and total per dataset and stage."""
    return report.groupBy("dataset", "stage").agg(
        F.count_if("success").alias("passed"), F.count("*").alias("total"),
    ).withColumn("passed_percent", F.round(F.col("passed") * 100.0 / F.col("total"), 2))


def run_suites(
    observations: DataFrame, climate: DataFrame, occurrences: DataFrame, current_year: int, stage: str = "pre",
) -> DataFrame:
    """The three suites over their own columns, combined.

    A dataset that cannot be checked at all contributes no rows and does not stop the
    others. Whole tables are checked; cap or sample the inputs first to check fewer rows.
    """
    suites = [
        ("microplastics", observations, OBSERVATION_COLUMNS, observation_suite(stage)),
        ("climate", climate, CLIMATE_COLUMNS, climate_suite()),
        ("species", occurrences, OCCURRENCE_COLUMNS, occurrence_suite(current_year)),
    ]
    spark = observations.sparkSession

    def evaluated(dataset: str, df: DataFrame, columns: Sequence[str], rules: Sequence[Rule]) -> DataFrame | None:
        try:
            # Evaluated here and now, a few rows: a dataset that fails while it runs fails alone.
            block = check(project_present(df, columns), rules, dataset, stage)
            return spark.createDataFrame(block.collect(), block.schema)
        except Exception as error:  # an unreadable dataset must not hide the other reports
            print(f"quality checks of {dataset} failed: {error}")
            return None

    report = spark.createDataFrame([], REPORT_DDL)
    with ThreadPoolExecutor(len(suites)) as pool:  # no dataset waits for another
        blocks = list(pool.map(evaluated, *zip(*suites, strict=True)))
    for block in blocks:
        report = report if block is None else report.unionByName(block)
    return report


# Columns whose absence from the raw observations is worth a warning.
CRITICAL_COLUMNS = ["objectid", "date", "latitude", "longitude", "microplastics_measurement", "unit"]
