"""Projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import REGION, Given, grid_sql, ocean_sql, query
from tidemark.functions import geo, values
from tidemark.operators import clean, columns
from tidemark.operators.grid import snap_to_grid
from tidemark.plans.analytics import with_zeros
from tidemark.schemas import CLIMATE_FIELDS, OBSERVATION_COLUMNS, OBSERVATION_FIELDS

# The raw headers of each source, over the fixture columns.
RAW_OBSERVATION = {
    "date": " Date (MM-DD-YYYY)", "latitude": "Latitude (degree)", "longitude": "Longitude(degree)",
    "microplastics_measurement": "Microplastics measurement", "marine_setting": "Marine Setting",
    "sampling_method": "Sampling Method", "concentration_class_range": "Concentration class range",
    "concentration_class_text": "Concentration class text", "unit": "Unit",
}
RAW_OCCURRENCE = {"scientific_name": "scientificName", "latitude": "decimalLatitude", "longitude": "decimalLongitude",
                  "individual_count": "individualCount"}


def raw_observations(g: Given):
    return g.micro.withColumnsRenamed(RAW_OBSERVATION)


def raw_occurrences(g: Given):
    return g.species.withColumnsRenamed(RAW_OCCURRENCE)


@query("norm_occurrence_columns", "SELECT * FROM fx_species_raw")
def _(g):
    return columns.rename_occurrences(raw_occurrences(g))


@query("norm_observation_columns", "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM fx_micro_raw")
def _(g):
    return columns.rename_observations(raw_observations(g))


@query("project_safe", """
SELECT CAST(CAST(date AS DATE) AS VARCHAR) AS date, latitude, longitude, CAST(NULL AS VARCHAR) AS ocean, CAST(NULL AS VARCHAR) AS marine_setting,
 wave_direction_dominant, wave_period_max, wave_height_max, wind_wave_direction_dominant, swell_wave_height_max,
 CAST(NULL AS VARCHAR) AS grid_id, CAST(NULL AS DOUBLE) AS grid_lat, CAST(NULL AS DOUBLE) AS grid_lon FROM fx_climate_raw""")
def _(g):
    return columns.project_fields(g.climate, CLIMATE_FIELDS)


@query("project_present", """
SELECT CAST(date AS VARCHAR) AS date, latitude, longitude, marine_setting, sampling_method, concentration_class_range,
 concentration_class_text, unit, microplastics_measurement, objectid FROM fx_micro_raw""")
def _(g):
    return columns.project_present(g.micro, OBSERVATION_COLUMNS)


@query("project_subset", """
SELECT "scientific_name" AS "scientificName", kingdom, phylum, class, "order", family, genus, latitude AS "decimalLatitude",
 longitude AS "decimalLongitude", year, individual_count AS "individualCount" FROM fx_species_raw""")
def _(g):
    return columns.project_present(raw_occurrences(g), columns.OCCURRENCE_ANALYSIS_COLUMNS)


@query("coerce_numeric", """
SELECT event_id, TRY_CAST(CASE WHEN event_id%4=0 THEN 'n/a' WHEN event_id%4=1 THEN '' WHEN event_id%4=2 THEN CAST(user_id AS VARCHAR)
 ELSE concat(CAST(user_id AS VARCHAR), '.25') END AS DOUBLE) AS number FROM events""")
def _(g):
    text = (F.when(F.expr("event_id%4=0"), "n/a").when(F.expr("event_id%4=1"), "")
            .when(F.expr("event_id%4=2"), F.col("user_id").cast("string"))
            .otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".25"))))
    return g.table("events").select("event_id", values.coerce_numeric(text).alias("number"))


@query("coerce_datetime", """
SELECT o_orderkey, CASE WHEN o_orderkey%5=3 OR o_orderkey%5=4 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed FROM orders""")
def _(g):
    day = F.col("o_orderdate")
    text = (F.when(F.expr("o_orderkey%5=0"), F.date_format(day, "MM-dd-yyyy"))
            .when(F.expr("o_orderkey%5=1"), F.date_format(day, "yyyy-MM-dd"))
            .when(F.expr("o_orderkey%5=2"), F.date_format(day, "M/d/yyyy"))
            .when(F.expr("o_orderkey%5=3"), "unknown"))
    return g.table("orders").select("o_orderkey", values.coerce_date(text).alias("parsed"))


@query("drop_missing_coords", "SELECT objectid, latitude, longitude FROM fx_micro_raw WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
def _(g):
    return clean.drop_missing_coords(g.micro).select("objectid", "latitude", "longitude")


@query("filter_valid_coords", """
SELECT objectid, latitude, longitude FROM fx_micro_raw WHERE latitude >= -90 AND latitude <= 90 AND longitude >= -180 AND longitude <= 180""")
def _(g):
    return clean.filter_valid_coords(g.micro).select("objectid", "latitude", "longitude")


@query("filter_region", f"SELECT objectid, latitude, longitude FROM fx_micro_raw WHERE {REGION}")
def _(g):
    return clean.filter_region(g.micro).select("objectid", "latitude", "longitude")


@query("filter_valid_names", "SELECT occurrence_id, scientific_name FROM fx_species_raw WHERE scientific_name IS NOT NULL AND length(scientific_name) >= 3")
def _(g):
    return clean.filter_valid_names(g.species).select("occurrence_id", "scientific_name")


@query("filter_coord_not_null", "SELECT objectid, unit FROM fx_micro_raw WHERE NOT (latitude IS NULL OR longitude IS NULL)")
def _(g):
    return clean.filter_not_null(g.micro, ["latitude", "longitude"]).select("objectid", "unit")


@query("filter_either_not_null", """
SELECT reading_id, wave_height_max, swell_wave_height_max FROM fx_climate_raw WHERE wave_height_max IS NOT NULL OR swell_wave_height_max IS NOT NULL""")
def _(g):
    pair = ["wave_height_max", "swell_wave_height_max"]
    return clean.filter_any_not_null(g.climate, pair).select("reading_id", *pair)


@query("filter_year_range", "SELECT reading_id, CAST(date AS VARCHAR) AS date FROM fx_climate_raw WHERE year(date) >= 1996 AND year(date) <= 1998")
def _(g):
    return clean.filter_years(g.climate, "date", 1996, 1998).select("reading_id", "date")


@query("filter_year_default", "SELECT reading_id FROM (SELECT reading_id, date + INTERVAL 15 YEAR AS date FROM fx_climate_raw) WHERE year(date) >= 2010 AND year(date) <= year(current_date)")
def _(g):
    """Without a chosen range; dates moved on by fifteen years, so that the default range holds some of them."""
    return clean.filter_years(g.climate.withColumn("date", F.expr("date + INTERVAL 15 YEAR"))).select("reading_id")


@query("filter_measured", "SELECT objectid, microplastics_measurement FROM fx_micro_raw WHERE microplastics_measurement IS NOT NULL")
def _(g):
    return clean.filter_not_null(g.micro, ["microplastics_measurement"]).select("objectid", "microplastics_measurement")


@query("filter_values", """
SELECT DISTINCT 'ocean' AS kind, ocean AS value FROM dim_location WHERE ocean IS NOT NULL
UNION ALL SELECT DISTINCT 'setting', marine_setting FROM dim_location WHERE marine_setting IS NOT NULL""")
def _(g):
    place = g.warehouse.dim_location
    oceans = clean.distinct_values(place, "ocean").select(F.lit("ocean").alias("kind"), F.col("ocean").alias("value"))
    settings = clean.distinct_values(place, "marine_setting").select(F.lit("setting"), "marine_setting")
    return oceans.union(settings)


@query("wrap_longitude", """
SELECT reading_id, CASE WHEN lon360 > 180 THEN lon360 - 360 ELSE lon360 END AS wrapped
FROM (SELECT reading_id, CASE WHEN longitude < 0 THEN longitude + 360 ELSE longitude END AS lon360 FROM fx_climate_raw)""")
def _(g):
    east = F.when(F.col("longitude") < 0, F.col("longitude") + 360).otherwise(F.col("longitude"))
    return g.climate.select("reading_id", geo.wrap_longitude(east).alias("wrapped"))


@query("infer_ocean", f"SELECT objectid, latitude, longitude, {ocean_sql()} AS ocean FROM fx_micro_raw")
def _(g):
    return g.micro.select("objectid", "latitude", "longitude", geo.infer_ocean("latitude", "longitude").alias("ocean"))


@query("infer_ocean_if_absent", f"""
SELECT objectid, 'absent' AS kind, {ocean_sql()} AS ocean FROM fx_micro_raw
UNION ALL SELECT objectid, 'all null', {ocean_sql()} FROM fx_micro_raw
UNION ALL SELECT objectid, 'partly known', CASE WHEN unit = 'items/l' THEN 'Known' END FROM fx_micro_raw""")
def _(g):
    absent = clean.with_inferred_ocean(g.micro)
    all_null = clean.with_inferred_ocean(g.micro.withColumn("ocean", F.lit(None).cast("string")))
    partly = clean.with_inferred_ocean(g.micro.withColumn("ocean", F.when(F.col("unit") == "items/l", "Known")))
    parts = [d.select("objectid", F.lit(k).alias("kind"), "ocean")
             for d, k in ((absent, "absent"), (all_null, "all null"), (partly, "partly known"))]
    return parts[0].union(parts[1]).union(parts[2])


@query("ocean_by_longitude", """
SELECT reading_id, CASE WHEN longitude > -100 THEN 'Atlantic Ocean' ELSE 'Pacific Ocean' END AS ocean, 'Beach' AS marine_setting FROM fx_climate_raw""")
def _(g):
    return g.climate.select("reading_id", geo.ocean_by_longitude("longitude").alias("ocean"), F.lit("Beach").alias("marine_setting"))


@query("snap_to_grid", f"SELECT objectid, latitude, longitude, {grid_sql()} FROM fx_micro_raw")
def _(g):
    return snap_to_grid(g.micro).select("objectid", "latitude", "longitude", "grid_lat", "grid_lon", "grid_id")


@query("parse_date_parts", """
SELECT reading_id, CAST(date AS VARCHAR) AS event_date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
 CAST(day(date) AS INTEGER) AS day FROM fx_climate_raw""")
def _(g):
    return clean.with_date_parts(g.climate.select("reading_id", F.col("date").alias("event_date")))


@query("date_dim_parts", """
SELECT reading_id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
 CAST(ceil(month(date)/3.0) AS INTEGER) AS quarter, CAST(floor(year(date)/10.0)*10 AS INTEGER) AS decade FROM fx_climate_raw""")
def _(g):
    year = F.year("date")
    return g.climate.select("reading_id", year.alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
                            F.quarter("date").alias("quarter"), values.decade(year).alias("decade"))


@query("month_key", "SELECT objectid, CAST(month(date) AS INTEGER) AS month FROM fx_micro_raw")
def _(g):
    return g.micro.select("objectid", values.month_key("date").alias("month"))


@query("year_month_label", "SELECT reading_id, strftime(date, '%Y-%m') AS label FROM fx_climate_raw")
def _(g):
    return g.climate.select("reading_id", values.year_month_label(F.year("date"), F.month("date")).alias("label"))


@query("quarter_label", "SELECT reading_id, concat('Q', CAST(quarter(date) AS VARCHAR)) AS label FROM fx_climate_raw")
def _(g):
    return g.climate.select("reading_id", values.quarter_label(F.quarter("date")).alias("label"))


@query("norm_value", """
SELECT objectid, nullif(trim(marine_setting), '') AS marine_setting, nullif(trim(sampling_method), '') AS sampling_method,
 round(latitude/7, 6) AS seventh FROM fx_micro_raw""")
def _(g):
    return g.micro.select("objectid", values.blank_to_null("marine_setting").alias("marine_setting"),
                          values.blank_to_null("sampling_method").alias("sampling_method"),
                          values.norm_number(F.col("latitude") / 7).alias("seventh"))


@query("coalesce_nonblank", """
SELECT objectid, coalesce(nullif(trim(CASE WHEN objectid%3=0 THEN '  ' ELSE marine_setting END), ''), nullif(trim(sampling_method), ''), unit) AS value
FROM fx_micro_raw""")
def _(g):
    first = F.when(F.expr("objectid%3=0"), "  ").otherwise(F.col("marine_setting"))
    return g.micro.select("objectid", values.first_nonblank(first, "sampling_method", "unit").alias("value"))


@query("nan_to_null", "SELECT reading_id, CASE WHEN reading_id%6=0 THEN NULL ELSE wave_height_max END AS wave_height_max FROM fx_climate_raw")
def _(g):
    height = F.when(F.expr("reading_id%6=0"), F.lit(float("nan"))).otherwise(F.col("wave_height_max"))
    return g.climate.select("reading_id", values.nan_to_null(height).alias("wave_height_max"))


@query("fill_null", "SELECT objectid, coalesce(microplastics_measurement, 0) AS microplastics_measurement FROM fx_micro_raw")
def _(g):
    return with_zeros(g.micro.select("objectid", "microplastics_measurement"))


@query("default_column", "SELECT reading_id, 1 AS measurement FROM fx_climate_raw")
def _(g):
    return columns.with_default(g.climate.select("reading_id"), "measurement", 1)


@query("log_scaled_size", """
SELECT objectid, least(100.0, greatest(5.0, ln(1 + coalesce(microplastics_measurement, 0))*10)) AS size FROM fx_micro_raw""", rounded="size")
def _(g):
    return g.micro.select("objectid", values.log_scaled_size("microplastics_measurement").alias("size"))


@query("wave_band", """
SELECT reading_id, CASE WHEN wave_height_max < 2 THEN 'Bajo (< 2m)' WHEN wave_height_max < 4 THEN 'Medio (2-4m)' ELSE 'Alto (> 4m)' END AS band
FROM fx_climate_raw WHERE wave_height_max IS NOT NULL""")
def _(g):
    return g.climate.dropna(subset=["wave_height_max"]).select("reading_id", values.wave_band("wave_height_max").alias("band"))


@query("equal_width_bin", """
SELECT reading_id, CASE WHEN wave_height_max IS NOT NULL THEN
 CAST(greatest(0, least(4, ceil((wave_height_max - lo)/((hi - lo)/5)) - 1)) AS INTEGER) END AS wave_bin
FROM fx_climate_raw, (SELECT min(wave_height_max) AS lo, max(wave_height_max) AS hi FROM fx_climate_raw)""")
def _(g):
    from tidemark.plans.analytics import with_wave_bin
    return with_wave_bin(g.climate.select("reading_id", "wave_height_max")).select("reading_id", "wave_bin")


@query("cardinal_direction", """
SELECT reading_id, list_extract(['N','NE','E','SE','S','SW','W','NW'], CAST(floor(((wave_direction_dominant*3) % 360 + 22.5)/45) AS INTEGER) % 8 + 1) AS cardinal
FROM fx_climate_raw WHERE reading_id%4 <> 0
UNION ALL SELECT reading_id, 'SU' FROM fx_climate_raw WHERE reading_id%4 = 0""")
def _(g):
    text = F.when(F.expr("reading_id%4=0"), " sur ").otherwise((F.col("wave_direction_dominant") * 3).cast("string"))
    return g.climate.select("reading_id", geo.cardinal_direction(text).alias("cardinal"))


@query("regex_binomial", "SELECT occurrence_id, regexp_matches(scientific_name, '^[A-Z][a-z]+ [a-z\\-]+$') AS ok FROM fx_species_raw")
def _(g):
    return g.species.select("occurrence_id", values.is_binomial("scientific_name").alias("ok"))


@query("pipe_clean_observations", "SELECT * EXCLUDE (grid_id, grid_lat, grid_lon) REPLACE (CAST(date AS VARCHAR) AS date) FROM obs")
def _(g):
    cleaned = clean.clean_observations(raw_observations(g))
    return columns.project_fields(cleaned, [f for f in OBSERVATION_FIELDS if not f[0].startswith("grid")])


@query("pipe_clean_occurrences", "SELECT * FROM occ_clean")
def _(g):
    return clean.clean_occurrences(raw_occurrences(g))


@query("pipe_clean_climate", "SELECT * REPLACE (CAST(CAST(date AS DATE) AS VARCHAR) AS date) FROM cli_clean")
def _(g):
    return clean.clean_climate(g.climate)


@query("explore_coordinates", f"""
SELECT objectid, latitude, longitude, measurement FROM (SELECT objectid, latitude, CASE WHEN longitude <= 180 THEN longitude ELSE longitude - 360 END AS longitude,
 microplastics_measurement AS measurement FROM fx_micro_raw WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""")
def _(g):
    renames = {"Latitude (degree)": "latitude", "Longitude(degree)": "longitude", "Microplastics measurement": "measurement"}
    return clean.normalize_explored(raw_observations(g), renames).select("objectid", "latitude", "longitude", "measurement")
