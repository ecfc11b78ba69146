"""Sources and sinks: what is written and read back must equal what SQL says of the given tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.base import FIXTURES, Given, query
from checks.quality import ALL_RULES, YEAR
from checks.scalars import RAW_OBSERVATION, RAW_OCCURRENCE, raw_observations, raw_occurrences
from tidemark.operators import columns, quality
from tidemark.plans import metrics
from tidemark.plans.etl import RunConfig, gate, run
from tidemark.plans.warehouse import table_counts
from tidemark.schemas import CLIMATE_FIELDS
from tidemark.sinks.catalog import load_table
from tidemark.sinks.files import DatedTable, append_history, write_quality_report, write_stage_tables
from tidemark.sinks.topic import write_message_files
from tidemark.sources.files import cached_extract, count_expected_columns, load_inferred, or_placeholder, read_delimited, read_occurrences_tsv
from tidemark.sources.tables import read_relational
from tidemark.streaming.messages import decode

OCCURRENCES = """
SELECT occurrence_id, scientific_name, kingdom, family, latitude, longitude, year, individual_count FROM fx_species_raw"""


def occurrence_lines(g: Given, path: str, broken: str = "false") -> None:
    """The occurrences as tab-separated text with a header; rows chosen as broken get two fields too many."""
    df = raw_occurrences(g)
    names = df.columns
    text = F.concat_ws("\t", *[F.coalesce(columns.quoted(c).cast("string"), F.lit("")) for c in names])
    line = F.when(F.expr(broken), F.concat(text, F.lit("\tx\ty"))).otherwise(text)
    # The header goes into every part file, as a distributed export writes it.
    df.select(line.alias("line")).write.option("header", False).text(f"{path}/body")
    body = g.spark.read.text(f"{path}/body").select(F.col("value").alias("\t".join(names)))
    body.write.option("header", True).option("quote", "").option("emptyValue", "").option(
        "escapeQuotes", False).option("sep", "\x01").csv(f"{path}/tsv")


def read_back(df: DataFrame) -> DataFrame:
    named = columns.rename_occurrences(df)
    return named.select(
        F.col("occurrence_id").cast("bigint").alias("occurrence_id"), "scientific_name", "kingdom", "family",
        F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"),
        F.col("year").cast("bigint").alias("year"), F.col("individual_count").cast("bigint").alias("individual_count"))


@query("src_tsv_occurrences", OCCURRENCES)
def _(g):
    path = g.scratch("tsv")
    occurrence_lines(g, path)
    return read_back(read_occurrences_tsv(g.spark, f"{path}/tsv"))


@query("src_tsv_skip_bad", OCCURRENCES + " WHERE occurrence_id % 50 <> 7")
def _(g):
    path = g.scratch("tsv")
    occurrence_lines(g, path, broken="occurrence_id % 50 = 7")
    return read_back(read_occurrences_tsv(g.spark, f"{path}/tsv", skip_bad=True))


@query("src_delimited_smart", """
SELECT reading_id, CAST(CAST(date AS DATE) AS VARCHAR) AS date, latitude, wave_height_max, sep FROM fx_climate_raw,
 (VALUES ('comma'), ('tab'), ('semicolon')) s(sep)""")
def _(g):
    path = g.scratch("delimited")
    out = None
    for name, sep in (("comma", ","), ("tab", "\t"), ("semicolon", ";")):
        readings = g.climate.withColumn("date", F.col("date").cast("date"))
        readings.write.option("header", True).option("sep", sep).csv(f"{path}/{name}")
        back = read_delimited(g.spark, f"{path}/{name}").select(
            F.col("reading_id").cast("bigint").alias("reading_id"), "date", F.col("latitude").cast("double").alias("latitude"),
            F.col("wave_height_max").cast("double").alias("wave_height_max"), F.lit(name).alias("sep"))
        out = back if out is None else out.union(back)
    return out


@query("src_relational_table", "SELECT objectid, unit, microplastics_measurement FROM fx_micro_raw")
def _(g):
    """A landed table; the JDBC form of the same call needs a driver and a server."""
    path = g.scratch("landed")
    g.micro.write.parquet(path)
    return read_relational(g.spark, path).select("objectid", "unit", "microplastics_measurement")


@query("src_infer_types", """
SELECT 'date' AS column_name, 'timestamp' AS dtype, count(*) AS n FROM fx_micro_raw UNION ALL SELECT 'latitude', 'double', count(*) FROM fx_micro_raw
UNION ALL SELECT 'microplastics_measurement', 'double', count(*) FROM fx_micro_raw
UNION ALL SELECT 'objectid', CASE WHEN max(objectid) FILTER (WHERE objectid % 2 = 0) > 2147483647 THEN 'bigint' ELSE 'int' END, count(*) FROM fx_micro_raw
UNION ALL SELECT 'unit', 'string', count(*) FROM fx_micro_raw""")
def _(g):
    """A catalog table made from the first text export, to which a second one is added; read by its name."""
    path = g.scratch("inferred")
    name = "observations_" + path[-12:]
    stamped = g.micro.withColumn("date", F.col("date").cast("timestamp"))
    for part in (0, 1):
        stamped.where(F.pmod("objectid", F.lit(2)) == part).write.option("header", True).csv(f"{path}/{part}")
        load_table(read_delimited(g.spark, f"{path}/{part}", infer=True), name, f"{path}/table")
    read = g.spark.table(name)
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(read.schema[c].dataType.simpleString()).alias("dtype"))
             for c in ("date", "latitude", "microplastics_measurement", "objectid", "unit")]
    return read.agg(F.count("*").alias("n")).select(F.inline(F.array(*cells)), "n")


@query("src_bulk_load_null", "SELECT objectid, CASE WHEN objectid % 3 = 0 THEN NULL ELSE microplastics_measurement END AS measurement FROM fx_micro_raw")
def _(g):
    value = F.when(F.expr("objectid % 3 = 0"), F.lit(float("nan"))).otherwise(F.col("microplastics_measurement"))
    path = g.scratch("bulk")
    load_inferred(g.micro.select("objectid", value.alias("measurement"))).write.parquet(path)
    return g.spark.read.parquet(path)


@query("src_cached_extract", "SELECT 1 AS extractions, count(*) AS n FROM fx_species_raw")
def _(g):
    calls = []

    def extract():
        calls.append(1)
        return g.species

    path = g.scratch("cache")
    cached_extract(g.spark, path, extract)
    again = cached_extract(g.spark, path, extract)
    return again.agg(F.lit(len(calls)).alias("extractions"), F.count("*").alias("n"))


@query("src_empty_placeholder", "SELECT 'full' AS kind, count(*) AS n FROM fx_climate_raw UNION ALL SELECT 'empty', 0")
def _(g):
    ddl = ", ".join(f"{n} {t}" for n, t in CLIMATE_FIELDS)
    full = or_placeholder(g.climate, g.spark, ddl)
    empty = or_placeholder(g.spark.createDataFrame([], T.StructType([])), g.spark, ddl).select("date", "grid_id")
    return full.agg(F.lit("full").alias("kind"), F.count("*").alias("n")).union(
        empty.agg(F.lit("empty"), F.count("*")))


@query("src_check_columns", "SELECT 6 AS n_expected_present, count(*) AS n_rows FROM fx_species_raw")
def _(g):
    raw = raw_occurrences(g)
    return raw.agg(F.lit(count_expected_columns(raw)).alias("n_expected_present"), F.count("*").alias("n_rows"))


@query("detect_lat_lon", "SELECT objectid, latitude AS lat, longitude AS lon FROM fx_micro_raw")
def _(g):
    raw = raw_observations(g)
    lat, lon = columns.find_coordinates(raw)
    return raw.select("objectid", columns.quoted(lat).alias("lat"), columns.quoted(lon).alias("lon"))


@query("dq_critical_columns", """
SELECT c AS missing, n AS n_rows FROM (SELECT unnest(['date', 'latitude', 'longitude', 'microplastics_measurement', 'unit']) AS c), (SELECT count(*) AS n FROM fx_micro_raw)""")
def _(g):
    """The critical columns that the raw observations lack before they are renamed."""
    raw = raw_observations(g)
    lacking = F.array(*[F.lit(c) for c in columns.missing_columns(raw, quality.CRITICAL_COLUMNS)])
    return raw.agg(F.count("*").alias("n_rows")).select(F.explode(lacking).alias("missing"), "n_rows")


@query("dq_non_blocking_gate", "SELECT dataset, count(*) AS total, count(*) FILTER (WHERE success) AS passed FROM all_rules GROUP BY 1", extra=ALL_RULES)
def _(g):
    """Failed rules are reported and the run goes on."""
    t = g.transformed
    report = quality.run_suites(t.observations, t.climate, t.occurrences, YEAR, "post")
    gate(report, "warn", "post")
    return quality.overall(report).select("dataset", F.col("total").cast("long").alias("total"), F.col("passed").cast("long").alias("passed"))


@query("sink_stage_tables", """
SELECT 'catalog' AS stage, count(*) AS n FROM cat UNION ALL SELECT 'climate', count(*) FROM cli UNION ALL
SELECT 'observations', count(*) FROM obs UNION ALL SELECT 'occurrences', count(*) FROM occ""")
def _(g):
    t = g.transformed
    tables = {"catalog": t.catalog, "climate": t.climate, "observations": t.observations, "occurrences": t.occurrences}
    parts = None
    for name, path in write_stage_tables(tables, g.scratch("stages"), fmt="csv").items():
        read = g.spark.read.option("header", True).csv(path).agg(F.lit(name).alias("stage"), F.count("*").alias("n"))
        parts = read if parts is None else parts.union(read)
    return parts


@query("sink_quality_report", "SELECT * FROM all_rules", extra=ALL_RULES)
def _(g):
    t = g.transformed
    report = quality.run_suites(t.observations, t.climate, t.occurrences, YEAR, "post")
    paths = write_quality_report(report, g.scratch("report"), "post")
    return g.spark.read.parquet(paths["rules"]).select(*quality.REPORT_COLUMNS)


@query("sink_topic_write", """
SELECT 'avg_concentration_by_region' AS metric_type, count(DISTINCT year) AS messages FROM dim_date
UNION ALL SELECT 'ecological_risk_index', count(DISTINCT year) FROM dim_date""")
def _(g):
    path = g.scratch("topic")
    write_message_files(metrics.publish(g.warehouse), path)
    return decode(g.spark.read.text(path)).groupBy("metric_type").agg(F.count("*").alias("messages"))


@query("sink_history_keep_last", """
SELECT CAST(CAST(date AS DATE) AS VARCHAR) AS date, grid_id, reading_id, wave_height_max FROM (
 SELECT *, row_number() OVER (PARTITION BY date, grid_id ORDER BY reading_id DESC) AS rn FROM cli WHERE grid_id IS NOT NULL) WHERE rn = 1""")
def _(g):
    """The readings arrive in three batches: those of even numbers, all later ones again with the others, and a repeated one."""
    history = DatedTable(g.spark, g.scratch("history"))
    readings = g.transformed.climate.where("grid_id IS NOT NULL").select("date", "grid_id", "reading_id", "wave_height_max")
    append_history(history, readings.where("reading_id % 2 = 0"), ["reading_id"], "even")
    for batch in ("rest", "rest"):
        append_history(history, readings.where("reading_id % 2 = 1 OR date >= DATE '1997-01-01'"), ["reading_id"], batch)
    return history.read()


@query("sink_history_manifest", """
SELECT CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS start, CAST(CAST(min(date) AS DATE) AS VARCHAR) AS oldest,
 CAST(CAST(max(date) AS DATE) AS VARCHAR) AS newest, count(DISTINCT (date, grid_id)) AS n_rows,
 CASE WHEN max(date) >= DATE '1997-03-15' THEN 'late' ELSE 'first' END AS batch FROM cli WHERE grid_id IS NOT NULL GROUP BY 1""")
def _(g):
    """The months of the history and the batch that wrote each last."""
    history = DatedTable(g.spark, g.scratch("history"))
    readings = g.transformed.climate.where("grid_id IS NOT NULL").select("date", "grid_id", "reading_id")
    append_history(history, readings, ["reading_id"], "first")
    append_history(history, readings.where("date >= DATE '1997-03-15'"), ["reading_id"], "late")
    return history.manifest().drop("written_at")


# What the text exports hold that cannot be read; it must come out as null.
UNREADABLE = {
    "fx_micro_raw": "CASE WHEN objectid % 50 = 7 THEN NULL ELSE microplastics_measurement END AS microplastics_measurement, "
                    "CASE WHEN objectid % 61 = 3 THEN NULL ELSE latitude END AS latitude, CASE WHEN objectid % 43 = 5 THEN NULL ELSE date END AS date",
    "fx_species_raw": "CASE WHEN occurrence_id % 19 = 4 THEN NULL ELSE longitude END AS longitude",
    "fx_climate_raw": "CASE WHEN reading_id % 23 = 6 THEN NULL ELSE wave_height_max END AS wave_height_max",
}
RUN_BLOCKS = {name: f"SELECT * REPLACE ({cells}) FROM ({re.sub(r'{(\w+)}', r'\1', FIXTURES[name]).replace('`', chr(34))})" for name, cells in UNREADABLE.items()}


def text_export(g: Given, table: DataFrame, path: str, names: dict[str, str], unreadable: dict[str, tuple[str, str]], sep: str) -> DataFrame:
    """A table as delimited text under its raw headers, with text that is no value in some rows; read back as it is landed."""
    cells = []
    for f in table.schema.fields:
        text = F.date_format(f.name, "MM-dd-yyyy") if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) else columns.quoted(f.name).cast("string")
        rows, junk = unreadable.get(f.name, ("false", ""))
        cells.append(F.when(F.expr(rows), junk).otherwise(text).alias(names.get(f.name, f.name).strip()))
    table.select(*cells).write.option("header", True).option("sep", sep).csv(path)
    return read_delimited(g.spark, path)


@query("pipe_run", """
SELECT 'dim_date' AS table_name, count(*) AS n_rows FROM dim_date UNION ALL SELECT 'dim_location', count(*) FROM dim_location
UNION ALL SELECT 'dim_climate', count(*) FROM dim_climate UNION ALL SELECT 'dim_sampling_method', count(*) FROM dim_sampling
UNION ALL SELECT 'dim_species', count(*) FROM dim_species UNION ALL SELECT 'fact_microplastics', count(*) FROM fact
UNION ALL SELECT 'microplastics_species_bridge', count(*) FROM fact WHERE date_id IS NOT NULL AND species_id IS NOT NULL""", extra=RUN_BLOCKS)
def _(g):
    """All steps, from text exports with unreadable values to the loaded star schema."""
    base = g.scratch("run")

    def observations():
        junk = {"microplastics_measurement": ("objectid % 50 = 7", "n/a"), "latitude": ("objectid % 61 = 3", "12,5"), "date": ("objectid % 43 = 5", "spring")}
        return text_export(g, g.micro, f"{base}/observations.csv", RAW_OBSERVATION, junk, ",")

    def occurrences():
        landed = text_export(g, g.species, f"{base}/occurrences.tsv", RAW_OCCURRENCE, {"longitude": ("occurrence_id % 19 = 4", "W 90")}, "\t")
        return landed.withColumn("occurrence_id", F.col("occurrence_id").cast("bigint"))

    def climate(_catalog):
        landed = text_export(g, g.climate, f"{base}/climate.csv", {}, {"wave_height_max": ("reading_id % 23 = 6", "high")}, ";")
        return landed.withColumn("reading_id", F.col("reading_id").cast("bigint"))

    result = run(g.spark, RunConfig(
        work_dir=f"{base}/work", extract_observations=observations, extract_occurrences=occurrences, extract_climate=climate, current_year=YEAR,
        transform_options={"occurrence_order": "occurrence_id", "climate_order": "reading_id"}))
    return table_counts(result.warehouse)
