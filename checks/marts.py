"""Marts over the star schema and their second-step summaries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.base import query
from tidemark.plans import analytics as a
from tidemark.plans import marts
from tidemark.plans.warehouse import CLIMATE_FK, LOCATION_FK
from tidemark.sources.tables import run_query

PLACE = "latitude, longitude, ocean, marine_setting"
TAXON = "kingdom, phylum, class, order_name, family"
WAVE5 = "wave_height_max, wave_period_max, swell_wave_height_max, wave_direction_dominant, wind_wave_direction_dominant"

# Each mart as SQL over "star", in which every fact carries the attributes of its dimensions.
MART = {
    "mart_zones": f"""
SELECT {PLACE}, count(*) AS num_observaciones, avg(measurement) AS avg_microplasticos, max(measurement) AS max_microplasticos,
 count(DISTINCT species_id) AS num_especies, avg(wave_height_max) AS avg_wave_height, avg(swell_wave_height_max) AS avg_swell_height,
 avg(wave_period_max) AS avg_wave_period FROM star WHERE location_id IS NOT NULL GROUP BY ALL
HAVING avg(measurement) > (SELECT avg(measurement) FROM fact)
ORDER BY avg_microplasticos DESC, num_especies, latitude, longitude, ocean, marine_setting NULLS FIRST LIMIT 100""",
    "mart_trends": """
SELECT year, month, quarter, decade, count(*) AS num_observaciones, avg(measurement) AS avg_microplasticos,
 count(DISTINCT species_id) AS num_especies, avg(wave_height_max) AS avg_wave_height, avg(swell_wave_height_max) AS avg_swell_height,
 avg(wave_period_max) AS avg_wave_period, avg(wave_direction_dominant) AS avg_wave_direction
FROM star WHERE year BETWEEN 1996 AND 2000 GROUP BY ALL""",
    "trends_all": """
SELECT year, month, quarter, decade, count(*) AS num_observaciones, avg(measurement) AS avg_microplasticos,
 count(DISTINCT species_id) AS num_especies, avg(wave_height_max) AS avg_wave_height, avg(swell_wave_height_max) AS avg_swell_height,
 avg(wave_period_max) AS avg_wave_period, avg(wave_direction_dominant) AS avg_wave_direction
FROM star WHERE year IS NOT NULL GROUP BY ALL""",
    "mart_oceans": """
SELECT ocean, marine_setting, count(*) AS num_observaciones, avg(measurement) AS avg_microplasticos,
 stddev_pop(measurement) AS std_microplasticos, count(DISTINCT species_id) AS num_especies, count(DISTINCT phylum) AS num_phylums,
 avg(wave_height_max) AS avg_wave_height, avg(swell_wave_height_max) AS avg_swell_height
FROM star WHERE ocean IS NOT NULL GROUP BY ALL""",
    "taxa_all": f"""
SELECT {TAXON}, count(DISTINCT species_id) AS num_especies, count(DISTINCT observation_id) AS num_observaciones,
 avg(measurement) AS avg_microplasticos, avg(wave_height_max) AS avg_wave_height
FROM star WHERE kingdom IS NOT NULL GROUP BY ALL""",
    "mart_taxa": """
SELECT * FROM taxa_all ORDER BY num_especies DESC, kingdom NULLS FIRST, phylum NULLS FIRST, class NULLS FIRST, order_name NULLS FIRST, family NULLS FIRST LIMIT 100""",
    "mart_waves": f"""
SELECT {WAVE5}, avg(measurement) AS avg_microplasticos, count(observation_id) AS num_observaciones,
 count(DISTINCT species_id) AS num_especies FROM star WHERE climate_id IS NOT NULL
 AND (wave_height_max IS NOT NULL OR swell_wave_height_max IS NOT NULL) GROUP BY ALL HAVING count(observation_id) >= 2""",
    "mart_methods": """
SELECT sampling_method, concentration_class_range, concentration_class_text, count(*) AS num_observaciones,
 avg(measurement) AS avg_microplasticos, min(measurement) AS min_microplasticos, max(measurement) AS max_microplasticos,
 stddev_pop(measurement) AS std_microplasticos, count(DISTINCT species_id) AS num_especies, avg(wave_height_max) AS avg_wave_height
FROM star WHERE sampling_method IS NOT NULL GROUP BY ALL""",
    "mart_bands": """
SELECT CASE WHEN wave_height_max >= 4 THEN 'Alto (> 4m)' WHEN wave_height_max >= 2 THEN 'Medio (2-4m)' ELSE 'Bajo (< 2m)' END AS oleaje_categoria,
 count(DISTINCT species_id) AS num_especies, avg(measurement) AS avg_microplasticos, count(*) AS num_observaciones,
 avg(wave_height_max) AS avg_wave_height, avg(swell_wave_height_max) AS avg_swell FROM star WHERE wave_height_max IS NOT NULL GROUP BY ALL""",
    "mart_spots": f"""
SELECT {PLACE}, avg(measurement) AS microplasticos, count(DISTINCT species_id) AS biodiversidad, avg(wave_height_max) AS oleaje,
 avg(swell_wave_height_max) AS swell, count(*) AS observaciones FROM star WHERE location_id IS NOT NULL GROUP BY ALL""",
    "mart_tens": """
SELECT decade, count(*) AS observaciones, avg(measurement) AS avg_microplasticos, count(DISTINCT species_id) AS especies,
 avg(wave_height_max) AS avg_oleaje FROM star WHERE decade IS NOT NULL GROUP BY ALL""",
}


def exact_means(sql: str) -> str:
    """Wave means as a decimal sum over a count, as the marts compute them."""
    return re.sub(r"avg\(((?:wave|swell)_\w+)\)", r"CAST(sum(CAST(\1 AS DECIMAL(18,6))) AS DOUBLE)/count(\1)", sql)


MART = {name: exact_means(sql) for name, sql in MART.items()}


def mart(key: str, sql: str, rounded: str = ""):
    return query(key, sql, rounded, extra=MART)


@mart("agg_kpi_summary", exact_means("""
SELECT count(DISTINCT observation_id) AS total_observaciones, count(DISTINCT location_id) AS total_ubicaciones,
 count(DISTINCT date_id) AS total_fechas, count(DISTINCT species_id) AS total_especies, count(DISTINCT climate_id) AS total_registros_clima,
 avg(measurement) AS avg_microplasticos, max(measurement) AS max_microplasticos, min(measurement) AS min_microplasticos,
 stddev_pop(measurement) AS std_microplasticos, avg(wave_height_max) AS avg_wave_height, avg(swell_wave_height_max) AS avg_swell_height FROM star"""),
      "std_microplasticos")
def _(g):
    return marts.kpi_summary(g.warehouse)


@mart("mart_critical_zones", "SELECT * FROM mart_zones")
def _(g):
    return marts.critical_zones(g.warehouse)


@mart("topk_100", f"SELECT {PLACE}, avg_microplasticos FROM mart_zones")
def _(g):
    return marts.critical_zones(g.warehouse).select("latitude", "longitude", "ocean", "marine_setting", "avg_microplasticos")


@mart("filter_in_list", "SELECT latitude, longitude, ocean, num_observaciones FROM mart_zones WHERE ocean IN ('Pacific Ocean', 'Arctic Ocean')")
def _(g):
    chosen = a.zones_in_oceans(marts.critical_zones(g.warehouse), ["Pacific Ocean", "Arctic Ocean"])
    return chosen.select("latitude", "longitude", "ocean", "num_observaciones")


@mart("mart_temporal_trends", "SELECT * FROM mart_trends")
def _(g):
    return marts.temporal_trends(g.warehouse, 1996, 2000)


@mart("mart_ocean_comparison", "SELECT * FROM mart_oceans", "std_microplasticos")
def _(g):
    return marts.ocean_comparison(g.warehouse)


@mart("mart_biodiversity", "SELECT * FROM mart_taxa")
def _(g):
    return marts.biodiversity(g.warehouse)


@mart("mart_climate_correlation", "SELECT * FROM mart_waves")
def _(g):
    return marts.climate_correlation(g.warehouse)


@mart("mart_sampling", "SELECT * FROM mart_methods", "std_microplasticos")
def _(g):
    return marts.sampling_effectiveness(g.warehouse)


@mart("mart_wave_band_impact", "SELECT * FROM mart_bands")
def _(g):
    return marts.wave_band_impact(g.warehouse)


@mart("mart_hotspots", "SELECT * FROM mart_spots")
def _(g):
    return marts.hotspots(g.warehouse)


@mart("mart_decades", "SELECT * FROM mart_tens")
def _(g):
    return marts.decades(g.warehouse)


@mart("sort_multi", """
SELECT row_number() OVER (ORDER BY avg_microplasticos DESC, num_especies, latitude, longitude, ocean, marine_setting NULLS FIRST) AS position,
 latitude, longitude, ocean, marine_setting FROM mart_zones""")
def _(g):
    ranked = marts.critical_zones(g.warehouse).orderBy(
        F.desc("avg_microplasticos"), "num_especies", "latitude", "longitude", "ocean", "marine_setting")
    # Positions are numbered over the hundred ranked zones, not over a table.
    listed = ranked.select("latitude", "longitude", "ocean", "marine_setting")
    return listed.agg(F.collect_list(F.struct("*")).alias("z")).select(F.posexplode("z").alias("p", "z")).select(
        (F.col("p").cast("bigint") + 1).alias("position"), "z.*")


# ---------------------------------------------------------------- star joins

@mart("join_star_inner", """
SELECT ocean, year, sampling_method, wave_height_max, count(*) AS n FROM star
WHERE location_id IS NOT NULL AND date_id IS NOT NULL AND climate_id IS NOT NULL AND sampling_method_id IS NOT NULL GROUP BY ALL""")
def _(g):
    g.warehouse.register_views()
    return run_query(g.spark, """
        SELECT l.ocean, d.year, m.sampling_method, c.wave_height_max, count(*) AS n
        FROM fact_microplastics f JOIN dim_location l ON f.dim_location_location_id = l.location_id
        JOIN dim_date d ON f.dim_date_date_id = d.date_id JOIN dim_climate c ON f.dim_climate_climate_id = c.climate_id
        JOIN dim_sampling_method m ON f.dim_sampling_method_sampling_method_id = m.sampling_method_id
        GROUP BY ALL""")


@mart("join_star_left", "SELECT ocean, year, phylum, wave_height_max, count(*) AS n, count(species_id) AS linked FROM star GROUP BY ALL")
def _(g):
    wh = g.warehouse
    sums = marts.summed_facts(wh, wh.fact, [LOCATION_FK, CLIMATE_FK, "obs_year"])
    return (
        sums.join(wh.dim_location.withColumnRenamed("location_id", LOCATION_FK), LOCATION_FK, "left")
        .join(wh.dim_climate.withColumnRenamed("climate_id", CLIMATE_FK), CLIMATE_FK, "left")
        .join(wh.dim_species.select("species_id", "phylum"), "species_id", "left")
        .groupBy("ocean", F.col("obs_year").alias("year"), "phylum", "wave_height_max")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("species_id").isNotNull(), F.col("n")).otherwise(0)).alias("linked"))
    )


@mart("join_bridge_many_to_many", """
SELECT scientific_name, count(DISTINCT observation_id) AS observations, sum(measurement) AS total FROM fact JOIN dim_species USING (species_id) GROUP BY ALL""")
def _(g):
    """Through the bridge table itself, as SQL over the star schema would."""
    g.warehouse.register_views()
    return run_query(g.spark, """
        SELECT s.scientific_name, count(*) AS observations, sum(f.measurement) AS total
        FROM dim_species s JOIN microplastics_species_bridge b ON s.species_id = b.dim_species_species_id
        JOIN fact_microplastics f ON b.fact_microplastics_observation_id = f.observation_id GROUP BY ALL""")


@mart("join_scalar_subquery", """
SELECT ocean, avg(measurement) AS mean FROM star WHERE ocean IS NOT NULL GROUP BY ocean
HAVING avg(measurement) > (SELECT avg(measurement) FROM fact)""")
def _(g):
    wh = g.warehouse
    overall = wh.fact.agg(F.avg("measurement").alias("m")).scalar()
    sums = marts.summed_facts(wh, wh.fact, [LOCATION_FK]).join(
        wh.dim_location.withColumnRenamed("location_id", LOCATION_FK), LOCATION_FK)
    means = sums.dropna(subset=["ocean"]).groupBy("ocean").agg(marts.mean_measurement().alias("mean"))
    return means.where(F.col("mean") > overall)


@mart("src_table_query", "SELECT year, month, count(*) AS n FROM star WHERE year >= 1997 AND year <= 1999 GROUP BY ALL")
def _(g):
    g.warehouse.register_views()
    return run_query(g.spark, """
        SELECT d.year, d.month, count(*) AS n FROM fact_microplastics f JOIN dim_date d ON f.dim_date_date_id = d.date_id
        WHERE d.year >= :lo AND d.year <= :hi GROUP BY d.year, d.month""", {"lo": 1997, "hi": 1999})


# ---------------------------------------------------------------- second step

@mart("temporal_labels", "SELECT concat(CAST(year AS VARCHAR), '-', lpad(CAST(month AS VARCHAR), 2, '0')) AS fecha, num_observaciones FROM trends_all")
def _(g):
    return a.with_month_label(g.mart(marts.temporal_trends)).select("fecha", "num_observaciones")


QUARTERS = """
SELECT q.quarter, coalesce(m.a, 0) AS avg_microplasticos, coalesce(m.w, 0) AS avg_wave_height, concat('Q', CAST(q.quarter AS VARCHAR)) AS quarter_label
FROM (VALUES (1), (2), (3), (4)) q(quarter) LEFT JOIN (
  SELECT quarter, avg(avg_microplasticos) AS a, avg(avg_wave_height) AS w FROM trends_all GROUP BY 1) m ON m.quarter = q.quarter"""


@mart("agg_quarter_profile", QUARTERS, "avg_microplasticos avg_wave_height")
def _(g):
    return a.quarter_profile(g.mart(marts.temporal_trends))


@mart("join_complete_domain", """
SELECT q.quarter, coalesce(m.n, 0) AS n FROM (VALUES (0), (1), (2), (3), (4), (5)) q(quarter) LEFT JOIN (
 SELECT quarter, count(*) AS n FROM dim_date GROUP BY 1) m ON m.quarter = q.quarter""")
def _(g):
    """The quarters of all dates, in a domain that has two values more."""
    known = g.warehouse.dim_date.groupBy("quarter").agg(F.count("*").alias("n"))
    return a.complete_domain(known, "quarter", [0, 1, 2, 3, 4, 5], "int")


TAXON_SUMS = "CAST(sum(num_especies) AS BIGINT) AS num_especies, avg(avg_microplasticos) AS avg_microplasticos"


@mart("agg_phylum_rollup", f"""
SELECT phylum, {TAXON_SUMS} FROM taxa_all WHERE phylum IS NOT NULL GROUP BY 1 ORDER BY num_especies DESC, phylum LIMIT 20""", "avg_microplasticos")
def _(g):
    return a.phylum_rollup(g.mart(marts.biodiversity, None))


@mart("agg_family_rollup", f"""
SELECT family, {TAXON_SUMS} FROM taxa_all WHERE family IS NOT NULL GROUP BY 1 ORDER BY num_especies DESC, family LIMIT 20""", "avg_microplasticos")
def _(g):
    return a.family_rollup(g.mart(marts.biodiversity, None))


@mart("agg_exposure_rollup", f"""
SELECT phylum, family, {TAXON_SUMS} FROM taxa_all WHERE phylum IS NOT NULL AND family IS NOT NULL GROUP BY 1, 2
ORDER BY avg_microplasticos DESC, phylum, family LIMIT 20""", "avg_microplasticos")
def _(g):
    return a.exposure_rollup(g.mart(marts.biodiversity, None))


REPORT = """
SELECT kingdom AS "Reino", phylum AS "Filo", class AS "Clase", order_name AS "Orden", num_especies AS "Num Especies",
 avg_microplasticos AS "Microplásticos", avg_wave_height AS "Oleaje (m)", avg_microplasticos > 50 AS flag FROM mart_taxa
ORDER BY num_especies DESC, kingdom NULLS FIRST, phylum NULLS FIRST, class NULLS FIRST, order_name NULLS FIRST, family NULLS FIRST LIMIT 20"""


def _taxon_report(g):
    return a.taxon_report(g.mart(marts.biodiversity))


@mart("rename_report_table", REPORT)
def _(g):
    return _taxon_report(g)


@mart("topk_20", f'SELECT "Reino", "Filo", "Clase", "Orden", "Num Especies" FROM ({REPORT})')
def _(g):
    return _taxon_report(g).select("Reino", "Filo", "Clase", "Orden", "Num Especies")


@mart("zone_risk_score", f"""
SELECT {PLACE}, 0.6*microplasticos/max(microplasticos) OVER () + 0.4*(1 - biodiversidad/max(biodiversidad) OVER ()) AS riesgo_score,
 microplasticos/max(microplasticos) OVER ()*30 + 8 AS marker_size FROM mart_spots""", "riesgo_score marker_size")
def _(g):
    return a.zone_risk(g.mart(marts.hotspots)).select(
        "latitude", "longitude", "ocean", "marine_setting", "riesgo_score", "marker_size")


METHODS = """
SELECT sampling_method, avg(avg_wave_height) AS avg_wave_height, avg(avg_microplasticos) AS avg_microplasticos,
 CAST(sum(num_observaciones) AS BIGINT) AS num_observaciones FROM mart_methods GROUP BY 1"""


@mart("agg_method_rollup", f"""
SELECT *, num_observaciones/(SELECT max(num_observaciones) FROM ({METHODS}))*30 + 6 AS marker_size FROM ({METHODS})
ORDER BY num_observaciones DESC, sampling_method LIMIT 30""", "avg_wave_height avg_microplasticos marker_size")
def _(g):
    return a.method_rollup(g.mart(marts.sampling_effectiveness))


@mart("topk_30", f"SELECT sampling_method, num_observaciones FROM ({METHODS}) ORDER BY num_observaciones DESC, sampling_method LIMIT 30")
def _(g):
    return a.method_rollup(g.mart(marts.sampling_effectiveness)).select("sampling_method", "num_observaciones")


@mart("topk_15", """
SELECT sampling_method, concentration_class_range, concentration_class_text, num_observaciones FROM mart_methods
ORDER BY num_observaciones DESC, sampling_method, concentration_class_range, concentration_class_text LIMIT 15""")
def _(g):
    return a.method_bars(g.mart(marts.sampling_effectiveness))


@mart("max_scaled_size", """
SELECT *, num_observaciones/max(num_observaciones) OVER ()*20 + 6 AS marker_size FROM (
 SELECT wave_height_max, swell_wave_height_max, avg_microplasticos, num_observaciones, num_especies FROM mart_waves
 WHERE wave_height_max IS NOT NULL AND swell_wave_height_max IS NOT NULL)""", "marker_size")
def _(g):
    return a.wave_scatter(g.mart(marts.climate_correlation))


BINNED = """
SELECT *, CAST(greatest(0, least(4, ceil((wave_height_max - lo)/((hi - lo)/5)) - 1)) AS INTEGER) AS wave_bin
FROM mart_waves, (SELECT min(wave_height_max) AS lo, max(wave_height_max) AS hi FROM mart_waves) WHERE wave_height_max IS NOT NULL"""


@mart("agg_bin_rollup", f"""
SELECT wave_bin, avg(avg_microplasticos) AS avg_microplasticos, CAST(sum(num_especies) AS BIGINT) AS num_especies,
 CAST(sum(num_observaciones) AS BIGINT) AS num_observaciones FROM ({BINNED}) GROUP BY 1""", "avg_microplasticos")
def _(g):
    return a.bin_rollup(g.mart(marts.climate_correlation))


@mart("agg_bin_box_stats", f"""
SELECT wave_bin, count(*) AS n, min(avg_microplasticos) AS low, quantile_cont(avg_microplasticos, 0.25) AS q1,
 quantile_cont(avg_microplasticos, 0.5) AS median, quantile_cont(avg_microplasticos, 0.75) AS q3, max(avg_microplasticos) AS high
FROM ({BINNED}) GROUP BY 1""", "low q1 median q3 high")
def _(g):
    return a.bin_box_stats(g.mart(marts.climate_correlation))


POINTS = """
SELECT list_extract(['N','NE','E','SE','S','SW','W','NW'], CAST(floor((wave_direction_dominant % 360 + 22.5)/45) AS INTEGER) % 8 + 1) AS cardinal,
 avg(avg_microplasticos) AS avg_microplasticos FROM mart_waves WHERE wave_direction_dominant IS NOT NULL GROUP BY 1"""


@mart("agg_direction_rollup", f"""
SELECT c.cardinal, coalesce(p.avg_microplasticos, 0) AS avg_microplasticos FROM (VALUES ('N'),('NE'),('E'),('SE'),('S'),('SW'),('W'),('NW')) c(cardinal)
LEFT JOIN ({POINTS}) p ON p.cardinal = c.cardinal""", "avg_microplasticos")
def _(g):
    return a.direction_rollup(g.mart(marts.climate_correlation))


_COMPLETE = f"SELECT {', '.join(a.CORRELATED)} FROM mart_waves WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in a.CORRELATED)


@mart("agg_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{x}' AS variable_i, '{y}' AS variable_j, corr({x}, {y}) AS r FROM ({_COMPLETE})"
    for x in a.CORRELATED for y in a.CORRELATED), "r")
def _(g):
    return a.correlation_matrix(g.mart(marts.climate_correlation))
