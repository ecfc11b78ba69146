"""Quality rules and table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Given, query
from tidemark.operators import profile, quality

YEAR = 2026


def rule_sql(expectation: str, column: str, source: str, bad: str, mostly: float, non_null: bool = True) -> str:
    """One rule as SQL: unexpected rows among the non-null ones (or among all rows)."""
    base = f"count({column})" if non_null else "count(*)"
    return f"""
SELECT '{expectation}' AS expectation, '{column.replace('"', '')}' AS column_name,
 coalesce((b - u)*1.0/nullif(b, 0), 1.0) >= {mostly} AS success, coalesce(round((b - u)*100.0/nullif(b, 0), 2), 100.0) AS success_percent,
 u AS unexpected_count, t AS element_count
FROM (SELECT {base} AS b, count(*) FILTER (WHERE {bad}) AS u, count(*) AS t FROM {source})"""


def exists_sql(column: str) -> str:
    return f"SELECT '{quality.EXISTS}', '{column}', true, 100.0, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"


def unique_sql(a: str, b: str, source: str, mostly: float) -> str:
    return f"""
SELECT '{quality.UNIQUE}' AS expectation, '{a},{b}' AS column_name, (k - u)*1.0/k >= {mostly} AS success,
 round((k - u)*100.0/k, 2) AS success_percent, u AS unexpected_count, t AS element_count FROM (
 SELECT count(*) FILTER (WHERE {a} IS NOT NULL OR {b} IS NOT NULL) AS k,
  count(*) FILTER (WHERE n > 1 AND ({a} IS NOT NULL OR {b} IS NOT NULL)) AS u, count(*) AS t
 FROM (SELECT {a}, {b}, count(*) OVER (PARTITION BY {a}, {b}) AS n FROM {source}))"""


def out_of(column: str, low, high) -> str:
    return f"{column} < {low} OR {column} > {high}"


def listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def named(dataset: str, stage: str, rules: list[str]) -> str:
    body = "\nUNION ALL ".join(f"SELECT * FROM ({r})" for r in rules)
    return (f"SELECT '{dataset}' AS dataset, '{stage}' AS stage, * FROM ({body}) "
            "AS r(expectation, column_name, success, success_percent, unexpected_count, element_count)")


def nulls_sql(column: str, source: str, mostly: float) -> str:
    return rule_sql(quality.NOT_NULL, column, source, f"{column} IS NULL", mostly, non_null=False)


def range_sql(column: str, source: str, low, high, mostly: float) -> str:
    return rule_sql(quality.BETWEEN, column, source, out_of(column, low, high), mostly)


UNIT_BAD = f"unit NOT IN {listed(quality.UNITS)}"
KINGDOM_BAD = f"kingdom NOT IN {listed(quality.KINGDOMS)}"
NAME_BAD = "NOT regexp_matches(scientific_name, '^[A-Z][a-z]+ [a-z\\-]+$')"


def observation_rules(source: str, stage: str) -> list[str]:
    m = "microplastics_measurement"
    return [
        *[exists_sql(c) for c in ("date", "latitude", "longitude", m, "unit", "grid_id", "objectid")],
        *[nulls_sql(c, source, 0.95) for c in ("latitude", "longitude", m, "grid_id")],
        range_sql("latitude", source, 5, 83, 0.98), range_sql("longitude", source, -180, -50, 0.98),
        range_sql(m, source, 0, "1e7", 0.99),
        *([rule_sql(quality.IN_SET, "unit", source, UNIT_BAD, 0.8)] if stage != "post" else []),
        unique_sql("objectid", "grid_id", source, 0.90),
    ]


def climate_rules(source: str) -> list[str]:
    return [
        *[exists_sql(c) for c in ("date", "latitude", "longitude", "grid_id")],
        *[nulls_sql(c, source, 0.95) for c in ("date", "latitude", "longitude", "grid_id")],
        range_sql("latitude", source, 5, 83, 0.99), range_sql("longitude", source, -180, -50, 0.99),
        range_sql("wave_height_max", source, 0, 30, 0.995), range_sql("wave_period_max", source, 0, 25, 0.995),
        range_sql("swell_wave_height_max", source, 0, 20, 0.995),
        range_sql("wind_wave_direction_dominant", source, 0, 360, 0.999),
        unique_sql("date", "grid_id", source, 0.95),
    ]


def occurrence_rules(source: str) -> list[str]:
    return [
        *[exists_sql(c) for c in ("scientific_name", "latitude", "longitude", "grid_id")],
        *[nulls_sql(c, source, 0.80) for c in ("scientific_name", "latitude", "longitude")],
        range_sql("latitude", source, 5, 83, 0.95), range_sql("longitude", source, -180, -50, 0.95),
        range_sql("year", source, 1950, YEAR, 0.95),
        rule_sql(quality.REGEX, "scientific_name", source, NAME_BAD, 0.70),
        rule_sql(quality.IN_SET, "kingdom", source, KINGDOM_BAD, 0.80),
    ]


OBSERVATIONS = named("microplastics", "post", observation_rules("obs", "post"))
CLIMATE = named("climate", "post", climate_rules("cli"))
SPECIES = named("species", "post", occurrence_rules("occ"))
ALL_RULES = {"all_rules": f"{OBSERVATIONS} UNION ALL {CLIMATE} UNION ALL {SPECIES}"}


@query("dq_column_exists", named("raw", "pre", [exists_sql(c) for c in ("objectid", "unit")] + [
    f"SELECT '{quality.EXISTS}', 'grid_id', false, 0.0, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"]))
def _(g):
    return quality.check(g.micro, quality.exists("objectid", "unit", "grid_id"), "raw", "pre", strict=True)


@query("dq_not_null", named("raw", "pre", [nulls_sql("latitude", "fx_micro_raw", 0.95), nulls_sql("microplastics_measurement", "fx_micro_raw", 0.95)]))
def _(g):
    return quality.check(g.micro, quality.not_null(0.95, "latitude", "microplastics_measurement", "absent"), "raw", "pre")


@query("dq_between", named("raw", "pre", [range_sql("latitude", "fx_micro_raw", 5, 83, 0.98), range_sql("longitude", "fx_micro_raw", -180, -50, 0.98)]))
def _(g):
    return quality.check(g.micro, [quality.between("latitude", 5, 83, 0.98), quality.between("longitude", -180, -50, 0.98)], "raw", "pre")


@query("dq_in_set", named("raw", "pre", [rule_sql(quality.IN_SET, "unit", "fx_micro_raw", UNIT_BAD, 0.8)]))
def _(g):
    return quality.check(g.micro, [quality.in_set("unit", quality.UNITS, 0.8)], "raw", "pre")


@query("dq_regex", named("raw", "pre", [rule_sql(quality.REGEX, "scientific_name", "fx_species_raw", NAME_BAD, 0.7)]))
def _(g):
    return quality.check(g.species, [quality.matches("scientific_name", quality.BINOMIAL_PATTERN, 0.7)], "raw", "pre")


@query("dq_compound_unique", named("raw", "pre", [unique_sql("objectid", "unit", "fx_micro_raw", 0.9)]))
def _(g):
    return quality.check(g.micro, [quality.unique(["objectid", "unit"], 0.9)], "raw", "pre")


@query("dq_suite_observations", OBSERVATIONS)
def _(g):
    return quality.check(g.transformed.observations, quality.observation_suite("post"), "microplastics", "post")


@query("dq_suite_observations_pre", named("microplastics", "pre", [
    r for r in observation_rules("fx_micro_raw", "pre") if "grid_id" not in r]))
def _(g):
    """Before the transform there are no cells, so the rules about them do not run."""
    return quality.check(g.micro, quality.observation_suite("pre"), "microplastics", "pre")


@query("dq_suite_climate", CLIMATE)
def _(g):
    return quality.check(g.transformed.climate, quality.climate_suite(), "climate", "post")


@query("dq_suite_occurrences", SPECIES)
def _(g):
    return quality.check(g.transformed.occurrences, quality.occurrence_suite(YEAR), "species", "post")


def _report(g: Given):
    t = g.transformed
    return quality.run_suites(t.observations, t.climate, t.occurrences, YEAR, "post")


@query("dq_run", "SELECT * FROM all_rules", extra=ALL_RULES)
def _(g):
    return _report(g)


@query("dq_summary", "SELECT dataset, stage, expectation, success, success_percent, unexpected_count, element_count FROM all_rules", extra=ALL_RULES)
def _(g):
    return quality.summary(_report(g))


@query("dq_overall", """
SELECT dataset, stage, count(*) FILTER (WHERE success) AS passed, count(*) AS total,
 round(count(*) FILTER (WHERE success)*100.0/count(*), 2) AS passed_percent FROM all_rules GROUP BY 1, 2""", extra=ALL_RULES)
def _(g):
    return quality.overall(_report(g))


# ---------------------------------------------------------------- profiles

NUMBERS = ["latitude", "longitude", "microplastics_measurement"]
TEXTS = ["marine_setting", "sampling_method", "concentration_class_range", "concentration_class_text", "unit"]


def each(columns, template: str) -> str:
    return " UNION ALL ".join(template.replace("@", c) for c in columns)


@query("prof_info", each(["objectid", "latitude", "marine_setting", "unit", "microplastics_measurement"],
                         "SELECT '@' AS column_name, CASE typeof(any_value(@)) WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' "
                         "ELSE 'double' END AS dtype, count(@) AS non_null FROM fx_micro_raw"))
def _(g):
    return profile.column_info(g.micro.select("objectid", "latitude", "marine_setting", "unit", "microplastics_measurement"))


@query("prof_numeric", each(NUMBERS, """
SELECT '@' AS column_name, count(@) AS n, avg(@) AS mean, stddev_samp(@) AS std, min(@) AS "min", quantile_cont(@, 0.25) AS q1,
 quantile_cont(@, 0.5) AS median, quantile_cont(@, 0.75) AS q3, max(@) AS "max" FROM fx_micro_raw"""), rounded="mean std q1 median q3")
def _(g):
    return profile.numeric_profile(g.micro, NUMBERS)


@query("prof_categorical", each(TEXTS, """
SELECT '@' AS column_name, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_unique, (min({'o': -n, 'v': @})).v AS top, max(n) AS freq
FROM (SELECT @, count(*) AS n FROM fx_micro_raw WHERE @ IS NOT NULL GROUP BY 1)"""))
def _(g):
    return profile.categorical_profile(g.micro, TEXTS)


@query("prof_distinct_values", each(TEXTS, "SELECT DISTINCT '@' AS column_name, @ AS value FROM fx_micro_raw"))
def _(g):
    return profile.distinct_values(g.micro)


@query("prof_distinct_counts", each(TEXTS, "SELECT '@' AS column_name, count(DISTINCT @) AS n_unique FROM fx_micro_raw"))
def _(g):
    return profile.distinct_counts(g.micro)


@query("prof_histogram", each(NUMBERS, """
SELECT '@' AS column_name, CAST(least(floor((@ - low)/((high - low)/20)), 19) AS INTEGER) AS bin, low, high, count(*) AS n
FROM fx_micro_raw, (SELECT min(@) AS low, max(@) AS high FROM fx_micro_raw) WHERE @ IS NOT NULL GROUP BY ALL"""))
def _(g):
    return profile.histogram(g.micro, NUMBERS)


@query("prof_value_counts", each(TEXTS, "SELECT '@' AS column_name, @ AS value, count(*) AS n FROM fx_micro_raw WHERE @ IS NOT NULL GROUP BY 2"))
def _(g):
    return profile.value_counts(g.micro, TEXTS)


@query("prof_filter_counts", """
SELECT count(*) AS rows_before, count(*) FILTER (WHERE latitude BETWEEN 5 AND 83 AND longitude BETWEEN -180 AND -50) AS rows_after FROM fx_micro_raw""")
def _(g):
    return profile.filter_counts(g.micro)


@query("string_length_max", each(["scientific_name", "kingdom", "phylum", "class", "family", "genus"],
                                 "SELECT '@' AS column_name, CAST(max(length(@)) AS INTEGER) AS max_length FROM fx_species_raw"))
def _(g):
    return profile.longest_text(g.species, ["scientific_name", "kingdom", "phylum", "class", "family", "genus"])
