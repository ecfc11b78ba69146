"""Cells, joins, aggregates into the fused table, deduplication, history and the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import RANKS, WAVES, blank, key_sql, micros, query
from checks.scalars import raw_observations
from tidemark.functions.geo import NORTH_AMERICA
from tidemark.operators import asof, clean, climate, dedup
from tidemark.operators.grid import assign_to_nearest_cell, assignment_counts, grid_catalog, snap_to_grid
from tidemark.operators.taxonomy import community_by_cell
from tidemark.plans import etl, fuse, warehouse

W = ", ".join(WAVES)
Q_RANKS = ", ".join(f'"{r}"' for r in RANKS)
WAVE_NAMES = " ".join(WAVES)


# ---------------------------------------------------------------- cells

@query("agg_grid_catalog", "SELECT * FROM cat")
def _(g):
    return grid_catalog(snap_to_grid(clean.clean_observations(g.micro)))


@query("pipe_first_pass", "SELECT * FROM cat")
def _(g):
    return etl.first_pass_catalog(raw_observations(g))


@query("join_nearest_cell", """
SELECT 'reading' AS kind, reading_id AS id, grid_id, grid_lat, grid_lon FROM cli
UNION ALL SELECT 'occurrence', occurrence_id, grid_id, grid_lat, grid_lon FROM occ""")
def _(g):
    cells = g.catalog
    readings = assign_to_nearest_cell(clean.clean_climate(g.climate), cells, extent=NORTH_AMERICA)
    found = assign_to_nearest_cell(clean.clean_occurrences(g.species), cells, extent=NORTH_AMERICA)
    cell = ["grid_id", "grid_lat", "grid_lon"]
    return readings.select(F.lit("reading").alias("kind"), F.col("reading_id").alias("id"), *cell).union(
        found.select(F.lit("occurrence"), "occurrence_id", *cell))


@query("join_nearest_cell_unbounded", "SELECT reading_id, grid_id, grid_lat, grid_lon FROM cli")
def _(g):
    """Without a known extent: shuffled by cell, every cell spread over several tasks."""
    found = assign_to_nearest_cell(clean.clean_climate(g.climate), g.catalog, salts=4)
    return found.select("reading_id", "grid_id", "grid_lat", "grid_lon")


@query("agg_stage_counts", """
SELECT count(*) AS total_rows, count(grid_id) AS assigned_rows, round(count(grid_id)*100.0/count(*), 1) AS assigned_percent FROM cli""")
def _(g):
    return assignment_counts(g.transformed.climate)


@query("pipe_stage_rows", """
SELECT 'observations' AS stage, count(*) AS n FROM obs UNION ALL SELECT 'occurrences', count(*) FROM occ
UNION ALL SELECT 'climate', count(*) FROM cli UNION ALL SELECT 'fused', count(*) FROM fused""")
def _(g):
    t = g.transformed
    parts = [(t.observations, "observations"), (t.occurrences, "occurrences"), (t.climate, "climate"), (t.fused, "fused")]
    counts = [d.agg(F.count("*").alias("n")).select(F.lit(s).alias("stage"), "n") for d, s in parts]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


# ---------------------------------------------------------------- aggregates and fuse

@query("agg_climate_month", """
SELECT c.*, o.ocean FROM cli_month c LEFT JOIN (
  SELECT grid_id, month(date) AS m, arg_min(CASE WHEN longitude > -100 THEN 'Atlantic Ocean' ELSE 'Pacific Ocean' END, reading_id) AS ocean
  FROM cli WHERE reading_id % 3 <> 0 GROUP BY 1, 2) o ON o.grid_id = c.grid_id AND o.m = c.month""", rounded=WAVE_NAMES)
def _(g):
    ocean = F.when(F.expr("reading_id % 3 <> 0"), F.when(F.col("longitude") > -100, "Atlantic Ocean").otherwise("Pacific Ocean"))
    readings = assign_to_nearest_cell(clean.clean_climate(g.climate), g.catalog, extent=NORTH_AMERICA)
    return climate.monthly_climate(readings.withColumn("ocean", ocean), "reading_id")


@query("agg_taxonomy_cell", "SELECT * FROM community")
def _(g):
    return community_by_cell(g.transformed.occurrences, "occurrence_id")


@query("dedup_first_20", "SELECT * FROM names20")
def _(g):
    return community_by_cell(g.transformed.occurrences, "occurrence_id").select("grid_id", "scientific_name")


@query("join_climate_month", f"SELECT objectid, grid_id, month, grid_lat_climate, grid_lon_climate, {W} FROM fused", rounded=WAVE_NAMES)
def _(g):
    t = g.transformed
    joined = fuse.join_monthly_climate(t.observations, climate.monthly_climate(t.climate, "reading_id"), NORTH_AMERICA)
    return joined.select("objectid", "grid_id", "month", "grid_lat_climate", "grid_lon_climate", *WAVES)


@query("join_taxonomy_cell", f"SELECT objectid, grid_id, grid_lat_species, scientific_name, {Q_RANKS} FROM fused")
def _(g):
    t = g.transformed
    joined = fuse.join_community(t.observations, community_by_cell(t.occurrences, "occurrence_id"), NORTH_AMERICA)
    return joined.select("objectid", "grid_id", "grid_lat_species", "scientific_name", *RANKS)


FUSED_SQL = """
SELECT * EXCLUDE (ocean_climate) REPLACE (CAST(date AS VARCHAR) AS date, nullif(ocean, '') AS ocean) FROM fused"""


@query("pipe_transform", FUSED_SQL, rounded=WAVE_NAMES)
def _(g):
    return g.transformed.fused.drop("ocean_climate")


@query("join_asof_nearest", """
SELECT k.objectid, CAST(k.date AS VARCHAR) AS date, k.grid_id, CAST(m.hit.found AS VARCHAR) AS matched_date, m.hit.gap AS days_apart,
 m.hit.h AS wave_height_max FROM obs k LEFT JOIN (
  SELECT a.grid_id, a.date, min({'gap': CAST(abs(date_diff('day', r.date, a.date)) AS INTEGER), 'found': r.date, 'h': r.wave_height_max}) AS hit
  FROM (SELECT DISTINCT grid_id, date FROM obs WHERE date IS NOT NULL) a JOIN readings r ON r.grid_id = a.grid_id
  WHERE abs(date_diff('day', r.date, a.date)) <= 60 GROUP BY 1, 2) m ON m.grid_id = k.grid_id AND m.date = k.date""",
    extra={"readings": """
SELECT grid_id, CAST(date AS DATE) AS date, wave_height_max FROM (
  SELECT *, row_number() OVER (PARTITION BY date, grid_id ORDER BY reading_id DESC) AS rn FROM cli WHERE grid_id IS NOT NULL) WHERE rn = 1"""})
def _(g):
    t = g.transformed
    readings = dedup.keep_last(t.climate.where("grid_id IS NOT NULL"), ["date", "grid_id"], ["reading_id"])
    left = t.observations.select("objectid", "date", "grid_id")
    return asof.nearest_date_join(left, readings, "grid_id", "date", ["wave_height_max"])


# ---------------------------------------------------------------- dedup, duplicates, limits, unions

@query("dedup_keep_last", f"""
SELECT CAST(CAST(date AS DATE) AS VARCHAR) AS date, grid_id, reading_id, {W} FROM (
  SELECT *, row_number() OVER (PARTITION BY date, grid_id ORDER BY reading_id DESC) AS rn FROM cli WHERE grid_id IS NOT NULL) WHERE rn = 1""")
def _(g):
    readings = g.transformed.climate.where("grid_id IS NOT NULL")
    return dedup.keep_last(readings, ["date", "grid_id"], ["reading_id"]).select("date", "grid_id", "reading_id", *WAVES)


@query("union_history", """
SELECT reading_id, CAST(CAST(date AS DATE) AS VARCHAR) AS date, wave_height_max, CAST(NULL AS VARCHAR) AS unit FROM fx_climate_raw
UNION ALL SELECT NULL, CAST(CAST(date AS DATE) AS VARCHAR), NULL, unit FROM fx_micro_raw""")
def _(g):
    first = g.climate.select("reading_id", F.col("date").cast("date").alias("date"), "wave_height_max")
    return dedup.union_by_name(first, g.micro.select("unit", F.col("date").cast("date").alias("date")))


LINE_COLUMNS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@query("dup_rows_full", f"""
SELECT * EXCLUDE (n) REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM (
 SELECT *, count(*) OVER (PARTITION BY {LINE_COLUMNS}) AS n FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 5 = 0)) WHERE n > 1""")
def _(g):
    """All columns of all rows, every fifth order delivered twice."""
    lines = g.table("lineitem")
    return dedup.duplicate_rows(lines.unionByName(lines.where("l_orderkey % 5 = 0")))


DUP_KEYS = ["latitude", "longitude", "marine_setting", "sampling_method", "date"]
DUP_SQL = ", ".join(DUP_KEYS)


@query("dup_rows_subset", f"""
SELECT objectid, latitude, longitude, marine_setting, sampling_method, CAST(date AS VARCHAR) AS date, unit FROM (
  SELECT *, count(*) OVER (PARTITION BY {DUP_SQL}) AS n FROM fx_micro_raw) WHERE n > 1""")
def _(g):
    return dedup.duplicate_rows(g.micro, DUP_KEYS).select("objectid", *DUP_KEYS, "unit")


@query("dup_group_count", f"SELECT count(*) AS duplicated_groups FROM (SELECT 1 FROM fx_micro_raw GROUP BY {DUP_SQL} HAVING count(*) > 1)")
def _(g):
    return dedup.count_duplicate_groups(g.micro, DUP_KEYS)


@query("head_cap", "SELECT objectid, unit FROM (SELECT *, row_number() OVER (ORDER BY objectid, unit) AS rn FROM fx_micro_raw) WHERE rn <= 20000")
def _(g):
    """The head is cut at 60,000 rows and more."""
    return dedup.head_rows(g.micro.select("objectid", "unit"), ["objectid", "unit"], 20_000)


def hash_sql(*ids: str) -> str:
    return "CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({i} AS VARCHAR), '~')" for i in ids) + ", '42')), 1, 15) AS BIGINT)"


@query("sample_fraction", f"SELECT * FROM fx_species_raw WHERE {hash_sql('occurrence_id')} % 1000000 < 500000")
def _(g):
    return dedup.sample_fraction(g.species, 0.5, ["occurrence_id"])


@query("sample_cap", f"""
SELECT objectid, unit FROM (SELECT *, row_number() OVER (ORDER BY {hash_sql('objectid', 'unit')}, objectid, unit) AS rn FROM fx_micro_raw) WHERE rn <= 15000""")
def _(g):
    return dedup.sample_cap(g.micro.select("objectid", "unit"), ["objectid", "unit"], max_rows=15_000)


# ---------------------------------------------------------------- incremental extraction

@query("inc_last_date", "SELECT CAST(max(CAST(date AS DATE)) AS VARCHAR) AS last_date, count(date) > 0 AS history_exists FROM fx_climate_raw")
def _(g):
    return climate.last_date(g.climate)


@query("inc_next_range", """
SELECT CASE WHEN e >= DATE '1972-01-01' THEN CAST(greatest(e - 364, DATE '1972-01-01') AS VARCHAR) END AS start_date,
 CASE WHEN e >= DATE '1972-01-01' THEN CAST(e AS VARCHAR) END AS end_date FROM (SELECT max(CAST(date AS DATE)) - 1 AS e FROM fx_climate_raw)""")
def _(g):
    return climate.next_range(g.climate)


@query("inc_next_range_backfill", """
SELECT CAST(min(CAST(date AS DATE)) - 365 AS VARCHAR) AS start_date, CAST(min(CAST(date AS DATE)) - 1 AS VARCHAR) AS end_date FROM fx_climate_raw""")
def _(g):
    return climate.next_range(g.climate, anchor="min")


@query("inc_new_readings", """
SELECT reading_id, grid_id, CAST(CAST(date AS DATE) AS VARCHAR) AS date FROM cli
WHERE grid_id IN (SELECT grid_id FROM cat) AND date BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'""")
def _(g):
    readings = g.transformed.climate
    return climate.new_readings(readings, g.catalog, "1996-03-01", "1997-02-28").select("reading_id", "grid_id", "date")


@query("src_climate_scaffold", f"""
SELECT CAST(d.day AS VARCHAR) AS date, c.grid_id, c.grid_lat AS latitude, c.grid_lon AS longitude,
 CASE WHEN c.grid_lon > -100 THEN 'Atlantic Ocean' ELSE 'Pacific Ocean' END AS ocean, 'Beach' AS marine_setting, {W}
FROM cat c CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '1997-01-01', DATE '1997-06-30', INTERVAL 1 DAY)) AS DATE) AS day) d
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY date, grid_id ORDER BY reading_id DESC) AS rn FROM cli WHERE grid_id IS NOT NULL) r
 ON r.rn = 1 AND r.grid_id = c.grid_id AND CAST(r.date AS DATE) = d.day""")
def _(g):
    landed = dedup.keep_last(g.transformed.climate.where("grid_id IS NOT NULL"), ["date", "grid_id"], ["reading_id"])
    return climate.scaffold(g.catalog, landed, "1997-01-01", "1997-06-30")


@query("add_event_stamp", "SELECT count(*) AS n, count(*) AS stamped, 1 AS times FROM fx_climate_raw")
def _(g):
    """Every reading is stamped, all of a batch with the same time."""
    stamp = F.col("extraction_timestamp")
    return climate.with_extraction_time(g.climate).agg(
        F.count("*").alias("n"), F.count(stamp).alias("stamped"), F.count_distinct(stamp).cast("int").alias("times"))


@query("agg_history_summary", """
SELECT count(*) AS total_rows, CAST(CAST(max(date) AS DATE) AS VARCHAR) AS newest, CAST(CAST(min(date) AS DATE) AS VARCHAR) AS oldest,
 count(DISTINCT grid_id) AS cells FROM cli""")
def _(g):
    return climate.history_summary(g.transformed.climate)


@query("agg_extract_summary", "SELECT count(*) AS new_rows, count(DISTINCT grid_id) AS cells_covered FROM cli WHERE year(date) = 1999")
def _(g):
    return climate.extract_summary(g.transformed.climate.where(F.year("date") == 1999))


# ---------------------------------------------------------------- star schema

@query("dim_date_build", "SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date")
def _(g):
    return warehouse.dim_date(g.keyed)


@query("dim_location_build", "SELECT * FROM dim_location")
def _(g):
    return warehouse.dim_location(g.keyed)


@query("dim_location_build_nulls_distinct", """
SELECT DISTINCT latitude, longitude, ocean, marine_setting FROM keyed WHERE location_id IS NOT NULL AND ocean IS NOT NULL AND marine_setting IS NOT NULL
UNION ALL SELECT latitude, longitude, ocean, marine_setting FROM keyed WHERE location_id IS NOT NULL AND (ocean IS NULL OR marine_setting IS NULL)""")
def _(g):
    return warehouse.dim_location(warehouse.with_keys(g.fused, null_keys="distinct")).drop("location_id")


@query("dim_climate_build", "SELECT * FROM dim_climate")
def _(g):
    return warehouse.dim_climate(g.keyed)


@query("dim_sampling_build", "SELECT * FROM dim_sampling")
def _(g):
    return warehouse.dim_sampling_method(g.keyed)


@query("dim_species_build", "SELECT * FROM dim_species")
def _(g):
    return warehouse.dim_species(g.keyed, warehouse.cell_members(g.communities))


@query("get_or_create_key", f"""
SELECT objectid, {key_sql("CAST(CAST(date AS DATE) AS VARCHAR)")} AS date_id,
 {key_sql(micros("latitude"), micros("longitude"), "CAST(NULL AS VARCHAR)", blank("marine_setting"))} AS place_id FROM fx_micro_raw""")
def _(g):
    from tidemark.functions.keys import number_part, surrogate_key
    from tidemark.functions.values import blank_to_null
    place = surrogate_key(F.lit(None).cast("string"), blank_to_null("marine_setting"), numbers=[number_part("latitude"), number_part("longitude")])
    return g.micro.select("objectid", surrogate_key(F.col("date").cast("date").cast("string")).alias("date_id"), place.alias("place_id"))


@query("join_natural_key_lookup", """
SELECT k.objectid, k.measurement, l.location_id, d.date_id, c.climate_id, m.sampling_method_id FROM keyed k
LEFT JOIN dim_location l ON l.latitude IS NOT DISTINCT FROM k.latitude AND l.longitude IS NOT DISTINCT FROM k.longitude
 AND l.ocean IS NOT DISTINCT FROM k.ocean AND l.marine_setting IS NOT DISTINCT FROM k.marine_setting
LEFT JOIN dim_date d ON d.full_date = k.full_date
LEFT JOIN dim_climate c ON c.climate_id = k.climate_id
LEFT JOIN dim_sampling m ON m.sampling_method IS NOT DISTINCT FROM k.sampling_method
 AND m.concentration_class_range IS NOT DISTINCT FROM k.concentration_class_range
 AND m.concentration_class_text IS NOT DISTINCT FROM k.concentration_class_text""")
def _(g):
    return g.keyed.select(
        F.col("_order").alias("objectid"), "measurement", "location_id", "date_id", "climate_id", "sampling_method_id")


@query("dim_incremental_upsert", "SELECT * FROM dim_location")
def _(g):
    """Members of the Atlantic first, then of the whole table."""
    keyed = g.keyed
    first = warehouse.dim_location(keyed.where("ocean = 'Atlantic Ocean'"))
    return warehouse.upsert_members(first, warehouse.dim_location(keyed), "location_id")


@query("fact_build", """
SELECT measurement, unit, date_id AS dim_date_date_id, climate_id AS dim_climate_climate_id, location_id AS dim_location_location_id,
 sampling_method_id AS dim_sampling_method_sampling_method_id FROM fact""")
def _(g):
    fact = warehouse.fact_rows(g.keyed, "load")
    return fact.select(*warehouse.FACT_COLUMNS[1:])


@query("bridge_build", """
SELECT date_id AS dim_date_date_id, species_id AS dim_species_species_id, count(*) AS links FROM fact
WHERE species_id IS NOT NULL GROUP BY 1, 2""")
def _(g):
    return g.warehouse.bridge.groupBy("dim_date_date_id", "dim_species_species_id").agg(
        F.count_distinct("fact_microplastics_observation_id").alias("links"))


@query("dim_members_of_skipped", """
SELECT l.location_id, count(f.observation_id) AS facts FROM dim_location l LEFT JOIN fact f USING (location_id) GROUP BY 1""")
def _(g):
    used = g.warehouse.fact.groupBy(F.col(warehouse.LOCATION_FK).alias("location_id")).agg(F.count("*").alias("facts"))
    members = g.warehouse.dim_location.select("location_id").join(used, "location_id", "left")
    return members.fillna(0)


@query("integrity_check", """
SELECT t.a AS table_name, t.b AS foreign_key, 0 AS violations FROM (VALUES
 ('fact_microplastics', 'dim_date_date_id'), ('fact_microplastics', 'dim_climate_climate_id'),
 ('fact_microplastics', 'dim_location_location_id'), ('fact_microplastics', 'dim_sampling_method_sampling_method_id'),
 ('microplastics_species_bridge', 'fact_microplastics_observation_id'), ('microplastics_species_bridge', 'dim_date_date_id'),
 ('microplastics_species_bridge', 'dim_species_species_id')) t(a, b)""")
def _(g):
    return warehouse.integrity_violations(g.warehouse)


@query("agg_load_stats", """
SELECT count(*) FILTER (WHERE measurement IS NOT NULL) AS inserted, count(*) FILTER (WHERE measurement IS NULL) AS skipped,
 count(*) FILTER (WHERE measurement IS NOT NULL AND date_id IS NOT NULL AND species_id IS NOT NULL) AS with_species FROM keyed""")
def _(g):
    return warehouse.load_stats(g.fused, communities=g.communities, extent=NORTH_AMERICA)


@query("sink_warehouse", """
SELECT 'dim_date' AS table_name, count(*) AS n_rows FROM dim_date UNION ALL SELECT 'dim_location', count(*) FROM dim_location
UNION ALL SELECT 'dim_climate', count(*) FROM dim_climate UNION ALL SELECT 'dim_sampling_method', count(*) FROM dim_sampling
UNION ALL SELECT 'dim_species', count(*) FROM dim_species UNION ALL SELECT 'fact_microplastics', count(*) FROM fact
UNION ALL SELECT 'microplastics_species_bridge', count(*) FROM fact WHERE species_id IS NOT NULL""")
def _(g):
    return warehouse.table_counts(g.warehouse)


@query("fact_append", """
SELECT n AS first_load, 2*n AS after_second_load, m AS locations FROM (SELECT count(*) AS n FROM fact), (SELECT count(*) AS m FROM dim_location)""")
def _(g):
    """The same rows loaded twice: facts double, dimensions do not grow."""
    path = g.scratch("append")
    given = {"communities": g.communities, "extent": NORTH_AMERICA}
    once = warehouse.load_warehouse(g.fused, path, load_id="one", **given).fact.count()
    twice = warehouse.load_warehouse(g.fused, path, load_id="two", **given)
    return twice.fact.agg(F.lit(once).cast("bigint").alias("first_load"), F.count("*").alias("after_second_load")).withColumn(
        "locations", twice.dim_location.agg(F.count("*").alias("m")).scalar())


@query("fact_reload", """
SELECT t.a AS table_name, t.n AS n_rows, 0 AS violations FROM (
 SELECT 'dim_location' AS a, (SELECT count(*) FROM dim_location) AS n UNION ALL
 SELECT 'fact_microplastics', (SELECT count(*) FROM fact) + (SELECT count(*) FROM keyed WHERE measurement IS NOT NULL AND ocean = 'Atlantic Ocean')) t""")
def _(g):
    """A whole load, a second of the same rows, and the first again with fewer: members the second uses stay."""
    path = g.scratch("reload")
    given = {"communities": g.communities, "extent": NORTH_AMERICA}
    warehouse.load_warehouse(g.fused, path, load_id="one", **given)
    warehouse.load_warehouse(g.fused, path, load_id="two", **given)
    again = warehouse.load_warehouse(g.fused.where("ocean = 'Atlantic Ocean'"), path, load_id="one", **given)
    violations = warehouse.integrity_violations(again).agg(F.sum("violations").cast("int").alias("violations")).scalar()
    return warehouse.table_counts(again).where("table_name IN ('dim_location', 'fact_microplastics')").withColumn("violations", violations)
