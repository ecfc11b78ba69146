"""Registry, fixtures over the given tables, and the shared SQL building blocks."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.geo import NORTH_AMERICA
from tidemark.operators.climate import monthly_climate
from tidemark.plans.etl import Transformed, first_pass_catalog, transform
from tidemark.plans.fuse import fuse
from tidemark.plans.warehouse import Warehouse, load_warehouse, read_warehouse, with_keys
from tidemark.session import keep_methods_compiled, materialize, path_exists, scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- fixture SQL (Spark dialect)

FIXTURES = {
    "fx_micro_raw": """
SELECT l_orderkey*1000 + l_partkey*10 + l_linenumber AS objectid,
 CASE WHEN (l_partkey+l_orderkey)%101=0 THEN NULL ELSE l_shipdate END AS date,
 CASE WHEN l_orderkey%97=0 THEN NULL ELSE CAST(-10 + ((l_partkey*37 + l_suppkey*11)%10)*10 AS DOUBLE) + CAST((l_orderkey*13)%200 AS DOUBLE)/1e2 END AS latitude,
 CASE WHEN l_orderkey%97=0 THEN NULL ELSE CAST(-190 + ((l_suppkey*53 + l_partkey*7)%16)*10 AS DOUBLE) + CAST((l_orderkey*29)%200 AS DOUBLE)/1e2 END AS longitude,
 CASE WHEN l_partkey%5=0 THEN 'Beach' WHEN l_partkey%5=1 THEN 'Ocean' WHEN l_partkey%5=2 THEN 'Estuary' WHEN l_partkey%5=3 THEN ' Beach ' ELSE NULL END AS marine_setting,
 CASE WHEN l_linenumber%7=0 THEN NULL WHEN l_linenumber%3=0 THEN 'Manta net' WHEN l_linenumber%3=1 THEN 'Grab sample' ELSE 'Hand picking' END AS sampling_method,
 CASE WHEN l_quantity<10 THEN '0-10' WHEN l_quantity<30 THEN '10-30' ELSE '30-50' END AS concentration_class_range,
 CASE WHEN l_quantity<10 THEN 'Low' WHEN l_quantity<30 THEN 'Medium' ELSE 'High' END AS concentration_class_text,
 CASE WHEN l_returnflag='A' THEN 'items/m3' WHEN l_returnflag='R' THEN 'items/l' ELSE 'pieces/10 mins' END AS unit,
 CASE WHEN l_suppkey%23=0 THEN NULL ELSE l_quantity END AS microplastics_measurement
FROM {lineitem}""",
    "fx_species_raw": """
SELECT doc_id AS occurrence_id,
 CASE WHEN doc_id%31=0 THEN NULL WHEN doc_id%37=0 THEN 'ab' WHEN doc_id%29=0 THEN concat('Genus', chr(CAST(97+doc_id%13 AS INT)), ' (L., 1758)') ELSE concat('Genus', chr(CAST(97+doc_id%13 AS INT)), ' species', chr(CAST(97+(doc_id*7)%17 AS INT))) END AS scientific_name,
 CASE WHEN doc_id%4=0 THEN 'Plantae' WHEN doc_id%4=3 THEN NULL WHEN doc_id%41=0 THEN 'Incertae' ELSE 'Animalia' END AS kingdom,
 concat('Phylum', CAST(doc_id%6 AS VARCHAR(10))) AS phylum,
 concat('Class', CAST(doc_id%8 AS VARCHAR(10))) AS class,
 concat('Order', CAST(doc_id%10 AS VARCHAR(10))) AS `order`,
 CASE WHEN doc_id%9=0 THEN NULL ELSE concat('Family', CAST(doc_id%15 AS VARCHAR(10))) END AS family,
 concat('Genus', chr(CAST(97+doc_id%13 AS INT))) AS genus,
 CAST(-10 + ((doc_id*37)%19)*5 AS DOUBLE) + CAST((doc_id*13)%400 AS DOUBLE)/1e2 AS latitude,
 CAST(-185 + ((doc_id*53)%29)*5 AS DOUBLE) + CAST((doc_id*29)%400 AS DOUBLE)/1e2 AS longitude,
 1940 + doc_id%90 AS year,
 CASE WHEN n_chars%10=0 THEN 0 ELSE n_chars%50 END AS individual_count
FROM {documents}""",
    "fx_climate_raw": """
SELECT o_orderkey AS reading_id, o_orderdate AS date,
 CAST(-10 + ((o_custkey*37)%19)*5 AS DOUBLE) + CAST((o_orderkey*13)%400 AS DOUBLE)/1e2 AS latitude,
 CAST(-185 + ((o_custkey*53 + o_orderkey)%29)*5 AS DOUBLE) + CAST((o_orderkey*29)%400 AS DOUBLE)/1e2 AS longitude,
 CAST((o_orderkey*17)%360 AS DOUBLE) AS wave_direction_dominant,
 CASE WHEN o_orderkey%11=0 THEN NULL ELSE CAST((o_orderkey*19)%250 AS DOUBLE)/1e1 END AS wave_period_max,
 CASE WHEN o_orderkey%13=0 THEN NULL ELSE CAST((o_orderkey*23)%700 AS DOUBLE)/1e2 END AS wave_height_max,
 CAST((o_orderkey*31)%360 AS DOUBLE) AS wind_wave_direction_dominant,
 CASE WHEN o_orderkey%17=0 THEN NULL ELSE CAST((o_orderkey*29)%500 AS DOUBLE)/1e2 END AS swell_wave_height_max
FROM {orders}""",
    "fx_metric_rows": """
SELECT event_id, ts,
 CASE event_type WHEN 'view' THEN 'avg_concentration_by_region' WHEN 'click' THEN 'avg_concentration_by_region' WHEN 'purchase' THEN 'ecological_risk_index' WHEN 'signup' THEN 'ecological_risk_index' ELSE 'heartbeat' END AS metric_type,
 CAST(1995 + user_id%7 AS INT) AS year,
 CASE WHEN user_id%3=0 THEN 'Pacific Ocean' WHEN user_id%3=1 THEN 'Atlantic Ocean' ELSE 'Arctic Ocean' END AS ocean_region,
 CASE WHEN user_id%5=0 THEN NULL WHEN user_id%2=0 THEN 'Beach' ELSE 'Ocean' END AS environment_type,
 CASE WHEN user_id%4=0 THEN 'items/l' ELSE 'items/m3' END AS unit,
 value AS metric_value, 1 + event_id%40 AS total_observations
FROM {events}""",
}

# ---------------------------------------------------------------- oracle building blocks (DuckDB dialect)

REGION = "latitude BETWEEN 5 AND 83 AND longitude BETWEEN -180 AND -50"
WAVES = ["wave_direction_dominant", "wave_period_max", "wave_height_max", "wind_wave_direction_dominant",
         "swell_wave_height_max"]
RANKS = ["kingdom", "phylum", "class", "order", "family", "genus"]


def grid_sql(lat: str = "latitude", lon: str = "longitude") -> str:
    glat, glon = f"(round_even({lat}/2.0, 0)*2.0 + 0.0)", f"(round_even({lon}/2.0, 0)*2.0 + 0.0)"
    return (
        f"{glat} AS grid_lat, {glon} AS grid_lon, "
        f"replace(printf('%s%05.1f%s%06.1f', CASE WHEN {glat}>=0 THEN 'N' ELSE 'S' END, abs({glat}), "
        f"CASE WHEN {glon}>=0 THEN 'E' ELSE 'W' END, abs({glon})), '.', '_') AS grid_id"
    )


def ocean_sql(lat: str = "latitude", lon: str = "longitude") -> str:
    return (f"CASE WHEN {lat} IS NULL OR {lon} IS NULL THEN NULL WHEN {lat} > 70 THEN 'Arctic Ocean' "
            f"WHEN {lon} < -100 THEN 'Pacific Ocean' ELSE 'Atlantic Ocean' END")


def nearest_sql(source: str, row_id: str) -> str:
    """Brute force over every (row, cell) pair."""
    return f"""
SELECT s.*, CASE WHEN m.km <= 250 THEN m.id END AS grid_id, CASE WHEN m.km <= 250 THEN m.lat END AS grid_lat,
       CASE WHEN m.km <= 250 THEN m.lon END AS grid_lon
FROM {source} s LEFT JOIN (
  SELECT t.{row_id} AS rid, min({{'km': sqrt((c.grid_lat-t.latitude)*(c.grid_lat-t.latitude)
      + (c.grid_lon-t.longitude)*(c.grid_lon-t.longitude))*111,
      'lat': c.grid_lat, 'lon': c.grid_lon, 'id': c.grid_id}}) AS m
  FROM {source} t CROSS JOIN cat c GROUP BY t.{row_id}) n ON s.{row_id} = n.rid"""


def micros(x: str) -> str:
    return f"CAST(CAST(round({x}*1e6) AS BIGINT) AS VARCHAR)"


def key_sql(*parts: str) -> str:
    escaped = [rf"coalesce('=' || replace(replace(CAST({p} AS VARCHAR), '\', '\\'), '|', '\|'), '~')" for p in parts]
    return "md5(concat_ws('|', " + ", ".join(escaped) + "))"


def blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


_mode = ", ".join(
    f"""(SELECT arg_min(v, {{'o': -n, 'v': v}}) FROM (SELECT "{r}" AS v, count(*) AS n FROM occ x
        WHERE x.grid_id = g.grid_id AND "{r}" IS NOT NULL GROUP BY 1)) AS "{r}\"""" for r in RANKS)

BLOCKS = {
    "obs": f"""
SELECT CAST(date AS DATE) AS date, latitude, longitude, {ocean_sql()} AS ocean, marine_setting, sampling_method,
 concentration_class_range, concentration_class_text, unit, microplastics_measurement, objectid, {grid_sql()}
FROM fx_micro_raw WHERE {REGION}""",
    "cat": "SELECT DISTINCT grid_id, grid_lat, grid_lon FROM obs",
    "occ_clean": f"SELECT * FROM fx_species_raw WHERE length(scientific_name) >= 3 AND {REGION}",
    "occ": nearest_sql("occ_clean", "occurrence_id"),
    "cli_clean": f"SELECT * FROM fx_climate_raw WHERE {REGION}",
    "cli": nearest_sql("cli_clean", "reading_id"),
    "cli_month": "SELECT grid_id, CAST(month(date) AS INTEGER) AS month, min(grid_lat) AS grid_lat, min(grid_lon) AS grid_lon, "
                 + ", ".join(f"avg({w}) AS {w}" for w in WAVES)
                 + " FROM cli WHERE grid_id IS NOT NULL GROUP BY 1, 2",
    "names20": """
SELECT grid_id, string_agg(scientific_name, '|' ORDER BY rn) AS scientific_name FROM (
  SELECT grid_id, scientific_name, row_number() OVER (PARTITION BY grid_id ORDER BY o, scientific_name) AS rn FROM (
    SELECT grid_id, scientific_name, min(occurrence_id) AS o FROM occ WHERE grid_id IS NOT NULL GROUP BY 1, 2))
WHERE rn <= 20 GROUP BY 1""",
    "community": f"""
SELECT g.*, n.scientific_name, {_mode} FROM (
  SELECT grid_id, min(grid_lat) AS grid_lat, min(grid_lon) AS grid_lon FROM occ WHERE grid_id IS NOT NULL GROUP BY 1) g
JOIN names20 n ON n.grid_id = g.grid_id""",
    "fused": "SELECT o.*, CAST(month(o.date) AS INTEGER) AS month, m.grid_lat AS grid_lat_climate, m.grid_lon AS grid_lon_climate, "
             + ", ".join(f"m.{w}" for w in WAVES) + ", CAST(NULL AS VARCHAR) AS ocean_climate, "
             "s.grid_lat AS grid_lat_species, s.grid_lon AS grid_lon_species, s.scientific_name, "
             + ", ".join(f's."{r}"' for r in RANKS)
             + """ FROM obs o LEFT JOIN cli_month m ON o.grid_id = m.grid_id AND month(o.date) = m.month
LEFT JOIN community s ON o.grid_id = s.grid_id""",
    "normed": "SELECT objectid, date AS full_date, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, "
              f"{blank('ocean')} AS ocean, {blank('marine_setting')} AS marine_setting, "
              + ", ".join(f"round({w}, 6) AS {w}" for w in WAVES)
              + f", {blank('sampling_method')} AS sampling_method, concentration_class_range, concentration_class_text, "
              "microplastics_measurement AS measurement, unit, "
              "scientific_name, kingdom, phylum, class, \"order\" AS order_name, family, genus FROM fused",
    "keyed": "SELECT *, CASE WHEN full_date IS NOT NULL THEN " + key_sql("CAST(full_date AS VARCHAR)") + " END AS date_id, "
             "CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN "
             + key_sql(micros("latitude"), micros("longitude"), "ocean", "marine_setting") + " END AS location_id, "
             f"CASE WHEN coalesce({', '.join(WAVES)}) IS NOT NULL THEN " + key_sql(*[micros(w) for w in WAVES])
             + " END AS climate_id, CASE WHEN coalesce(sampling_method, concentration_class_range, concentration_class_text) "
             "IS NOT NULL THEN " + key_sql("sampling_method", "concentration_class_range", "concentration_class_text")
             + " END AS sampling_method_id, CASE WHEN length(scientific_name) >= 2 THEN "
             + key_sql("scientific_name", "genus") + " END AS species_id FROM normed",
    "dim_date": """
SELECT DISTINCT date_id, full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
 CAST(day(full_date) AS INTEGER) AS day, CAST(ceil(month(full_date)/3.0) AS INTEGER) AS quarter,
 CAST(year(full_date)//10*10 AS INTEGER) AS decade FROM keyed WHERE date_id IS NOT NULL""",
    "dim_location": "SELECT DISTINCT location_id, latitude, longitude, ocean, marine_setting FROM keyed WHERE location_id IS NOT NULL",
    "dim_climate": f"SELECT DISTINCT climate_id, {', '.join(WAVES)} FROM keyed WHERE climate_id IS NOT NULL",
    "dim_sampling": "SELECT DISTINCT sampling_method_id, sampling_method, concentration_class_range, concentration_class_text "
                    "FROM keyed WHERE sampling_method_id IS NOT NULL",
    "dim_species": """
SELECT species_id, scientific_name, kingdom, phylum, class, order_name, family, genus FROM (
  SELECT *, row_number() OVER (PARTITION BY species_id ORDER BY objectid, scientific_name, kingdom, phylum, class, order_name, family, genus) AS rn
  FROM keyed WHERE measurement IS NOT NULL AND species_id IS NOT NULL) WHERE rn = 1""",
    "fact": """
SELECT row_number() OVER () AS observation_id, measurement, unit, date_id, climate_id, location_id, sampling_method_id,
 CASE WHEN date_id IS NOT NULL THEN species_id END AS species_id FROM keyed WHERE measurement IS NOT NULL""",
    # every fact with the attributes of all its dimensions
    "star": """
SELECT f.observation_id, f.measurement, f.unit, f.date_id, f.climate_id, f.location_id, f.sampling_method_id, f.species_id,
 l.latitude, l.longitude, l.ocean, l.marine_setting, d.year, d.month, d.quarter, d.decade,
 c.wave_direction_dominant, c.wave_period_max, c.wave_height_max, c.wind_wave_direction_dominant, c.swell_wave_height_max,
 m.sampling_method, m.concentration_class_range, m.concentration_class_text,
 s.kingdom, s.phylum, s.class, s.order_name, s.family, s.genus
FROM fact f LEFT JOIN dim_location l USING (location_id) LEFT JOIN dim_date d USING (date_id)
LEFT JOIN dim_climate c USING (climate_id) LEFT JOIN dim_sampling m USING (sampling_method_id)
LEFT JOIN dim_species s USING (species_id)""",
}


def _all_blocks() -> dict[str, str]:
    plain = {n: re.sub(r"\{(\w+)\}", r"\1", sql).replace("`", '"') for n, sql in FIXTURES.items()}
    return {**plain, **BLOCKS}


def full_sql(body: str, extra: dict[str, str] | None = None) -> str:
    """The body with every building block it needs as leading CTEs."""
    blocks = {**_all_blocks(), **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in blocks:
            if name not in needed and re.search(rf"(?<![\w.'\"]){name}(?![\w'\"])", text):
                visit(blocks[name])
                needed.append(name)

    visit(body)
    ctes = ",\n".join(f"{n} AS ({blocks[n].strip()})" for n in needed)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


# ---------------------------------------------------------------- fixtures as frames

# Folders written by this application, by what they hold and the tables they were made from.
_WRITTEN: dict[tuple[str, str, str], str] = {}


class Given:
    """The given tables of one folder, the fixtures over them, and what is built from these."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        keep_methods_compiled(spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def fixture(self, name: str) -> DataFrame:
        table = re.search(r"\{(\w+)\}", FIXTURES[name]).group(1)
        return self.spark.sql(FIXTURES[name], **{table: self.table(table)})

    @cached_property
    def micro(self) -> DataFrame:
        return self.fixture("fx_micro_raw")

    @cached_property
    def species(self) -> DataFrame:
        return self.fixture("fx_species_raw")

    @cached_property
    def climate(self) -> DataFrame:
        return self.fixture("fx_climate_raw")

    @cached_property
    def metric_rows(self) -> DataFrame:
        return self.fixture("fx_metric_rows")

    @cached_property
    def catalog(self) -> DataFrame:
        """The cell catalogue, written once per session like any stage table."""
        base = self._written("catalog", lambda b: materialize(first_pass_catalog(self.micro), f"{b}/cells"))
        return self.spark.read.parquet(f"{base}/cells")

    @cached_property
    def transformed(self) -> Transformed:
        return transform(self.micro, self.species, self.climate, catalog=self.catalog,
                         occurrence_order="occurrence_id", climate_order="reading_id")

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)

    def _written(self, label: str, write: Callable[[str], object]) -> str:
        """A folder filled once per application, and again if it has gone."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, label)
        if key not in _WRITTEN or not path_exists(self.spark, _WRITTEN[key]):
            base = self.scratch(label)
            write(base)
            _WRITTEN[key] = base
        return _WRITTEN[key]

    def _write_stage(self, base: str) -> None:
        t = self.transformed
        communities = materialize(t.communities, f"{base}/communities")
        fused = materialize(fuse(t.observations, monthly_climate(t.climate, "reading_id"), communities, NORTH_AMERICA), f"{base}/fused")
        load_warehouse(fused, f"{base}/warehouse", load_id="first", communities=communities, extent=NORTH_AMERICA)

    @cached_property
    def stage(self) -> str:
        """Fused table and warehouse, as a load leaves them."""
        return self._written("stage", self._write_stage)

    @cached_property
    def warehouse(self) -> Warehouse:
        return read_warehouse(self.spark, f"{self.stage}/warehouse")

    @cached_property
    def fused(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.stage}/fused")

    @cached_property
    def communities(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.stage}/communities")

    @cached_property
    def keyed(self) -> DataFrame:
        """The fused table with its keys, not written."""
        return with_keys(self.fused, communities=self.communities, extent=NORTH_AMERICA)

    def mart(self, build: Callable[..., DataFrame], *args) -> DataFrame:
        """A mart written once per session, for summaries that read it more than once."""
        name = "-".join([build.__name__, *map(str, args)])
        path = f"{self.stage}/marts/{name}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            materialize(build(self.warehouse, *args), path)
        return self.spark.read.parquet(path)


def _presented(df: DataFrame, rounded: list[str]) -> DataFrame:
    """Dates and times as text, and named averages rounded, so that two engines print them alike."""
    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("string").alias(f.name)
        return F.round(c, 6).alias(f.name) if f.name in rounded else c

    return df.select(*[shown(f) for f in df.schema.fields])


def query(key: str, sql: str | None = None, rounded: str | list[str] = "", extra: dict[str, str] | None = None):
    """Register a query, with the SQL it must agree with where there is one.

    ``rounded`` names the floating results whose last digits depend on the order of summation.
    """
    names = rounded.split() if isinstance(rounded, str) else rounded

    def register(build: Callable[[Given], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: _presented(build(Given(spark, sf_dir)), names)
        if sql is not None:
            body = sql.strip()
            if names:
                replaced = ", ".join(f'round("{n}", 6) AS "{n}"' for n in names)
                body = f"SELECT * REPLACE ({replaced}) FROM ({body}) AS q"
            ORACLES[key] = full_sql(body, extra)
        return build

    return register
