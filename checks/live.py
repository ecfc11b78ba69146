"""Yearly metrics, messages, live state and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import FIXTURES, Given, query
from tidemark.plans import live, metrics
from tidemark.plans.metrics import CONCENTRATION, RISK
from tidemark.sinks.files import VersionedTable
from tidemark.sinks.topic import write_message_files
from tidemark.sources.topic import read_message_files
from tidemark.streaming import messages, state, windows

PLACE = "year, ocean AS ocean_region, marine_setting AS environment_type"
BLOCKS = {
    "m_conc": f"SELECT {PLACE}, avg(measurement) AS avg_concentration, count(*) AS total_observations, unit FROM star "
              "WHERE location_id IS NOT NULL AND date_id IS NOT NULL GROUP BY ALL",
    "m_raw": f"""
SELECT {PLACE}, count(*) AS total_microplastics, avg(measurement) AS avg_pollution, count(DISTINCT species_id) AS species_count,
 avg(measurement)*count(DISTINCT species_id) AS risk_raw FROM star WHERE location_id IS NOT NULL AND date_id IS NOT NULL GROUP BY ALL""",
    "m_risk": """
SELECT *, CASE WHEN hi = lo THEN 0 ELSE (risk_raw - lo)*100/(hi - lo) END AS risk_index FROM (
 SELECT *, min(risk_raw) OVER (PARTITION BY year) AS lo, max(risk_raw) OVER (PARTITION BY year) AS hi FROM m_raw)""",
    "s_conc": """
SELECT year, ocean_region, environment_type, unit, metric_value AS avg_concentration, total_observations FROM (
 SELECT *, row_number() OVER (PARTITION BY year, ocean_region, environment_type, unit ORDER BY ts DESC, event_id DESC) AS rn
 FROM fx_metric_rows WHERE metric_type = 'avg_concentration_by_region') WHERE rn = 1""",
    "s_risk": """
SELECT year, ocean_region, environment_type, metric_value AS avg_pollution, total_observations AS species_count,
 total_observations*2 AS total_microplastics, metric_value*total_observations AS risk_raw, metric_value/5 AS risk_index FROM (
 SELECT *, row_number() OVER (PARTITION BY year, ocean_region, environment_type ORDER BY ts DESC, event_id DESC) AS rn
 FROM fx_metric_rows WHERE metric_type = 'ecological_risk_index') WHERE rn = 1""",
    "k_conc": """
SELECT year, ocean_region, environment_type, unit, metric_value AS avg_concentration, total_observations FROM (
 SELECT *, row_number() OVER (PARTITION BY year, ocean_region, environment_type, unit ORDER BY ts DESC, event_id DESC) AS rn
 FROM sent WHERE metric_type = 'avg_concentration_by_region' AND event_id % 4 <> 0) WHERE rn = 1 OR environment_type IS NULL""",
    "k_risk": """
SELECT year, ocean_region, environment_type, metric_value AS avg_pollution, total_observations AS species_count,
 total_observations*2 AS total_microplastics, metric_value*total_observations AS risk_raw, metric_value/5 AS risk_index FROM (
 SELECT *, row_number() OVER (PARTITION BY year, ocean_region, environment_type ORDER BY ts DESC, event_id DESC) AS rn
 FROM sent WHERE metric_type = 'ecological_risk_index' AND event_id % 4 <> 0) WHERE rn = 1 OR environment_type IS NULL""",
    "sent": "SELECT * FROM fx_metric_rows WHERE metric_type <> 'heartbeat'",
}
RISK_SHOWN = ("SELECT year, ocean_region, environment_type, total_microplastics, avg_pollution, species_count, risk_raw, "
              "risk_index FROM m_risk")


def check(key: str, sql: str | None = None, rounded: str | list[str] = ""):
    return query(key, sql, rounded, extra=BLOCKS)


# ---------------------------------------------------------------- batch metrics

@check("metric_years", "SELECT DISTINCT year FROM dim_date")
def _(g):
    return metrics.years(g.warehouse)


@check("metric_avg_concentration", "SELECT * FROM m_conc")
def _(g):
    return metrics.avg_concentration(g.warehouse)


@check("metric_risk_raw", "SELECT * FROM m_raw")
def _(g):
    return metrics.risk_raw(g.warehouse)


@check("metric_risk_index", RISK_SHOWN, "risk_index")
def _(g):
    return metrics.ecological_risk(g.warehouse)


@check("stream_publish", """
SELECT y.year, m.metric_type, m.rows_in AS record_count, m.observations FROM (SELECT DISTINCT year FROM dim_date) y JOIN (
 SELECT year, 'avg_concentration_by_region' AS metric_type, CAST(count(*) AS INTEGER) AS rows_in, CAST(sum(total_observations) AS BIGINT) AS observations FROM m_conc GROUP BY 1
 UNION ALL SELECT year, 'ecological_risk_index', CAST(count(*) AS INTEGER), CAST(sum(total_microplastics) AS BIGINT) FROM m_raw GROUP BY 1) m USING (year)""")
def _(g):
    """Messages as published, decoded again."""
    decoded = messages.decode(metrics.publish(g.warehouse).select("value"))
    total = F.aggregate("data", F.lit(0).cast("bigint"), lambda acc, r: acc + F.coalesce(r["total_observations"], r["total_microplastics"]))
    return decoded.select("year", "metric_type", "record_count", total.alias("observations"))


# ---------------------------------------------------------------- messages over the events table

def as_messages(rows: DataFrame) -> DataFrame:
    """One JSON message per metric row, as a topic would deliver it."""
    concentration = F.struct(
        "ocean_region", "environment_type", F.col("metric_value").alias("avg_concentration"), "total_observations", "unit")
    risk = F.struct(
        "ocean_region", "environment_type", (F.col("total_observations") * 2).alias("total_microplastics"),
        F.col("metric_value").alias("avg_pollution"), F.col("total_observations").alias("species_count"),
        (F.col("metric_value") * F.col("total_observations")).alias("risk_raw"), (F.col("metric_value") / 5).alias("risk_index"))
    def envelope(data):
        stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return messages.encode("metric_type", "year", stamp.alias("timestamp"), F.array(data).alias("data"), F.lit(1).alias("record_count"))

    value = F.when(F.col("metric_type") == RISK, envelope(risk)).otherwise(envelope(concentration))
    return rows.select(value.alias("value"), F.col("ts").cast("timestamp").alias("arrival"), F.col("event_id").alias("seq"))


def event_stream(g: Given) -> DataFrame:
    """The events table as a file stream, shaped like the metric rows."""
    schema = g.table("events").schema
    events = g.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(g.sf_dir)
    return g.spark.sql(FIXTURES["fx_metric_rows"], events=events)


def message_stream(g: Given) -> DataFrame:
    return as_messages(event_stream(g))


def message_batch(g: Given) -> DataFrame:
    return as_messages(g.metric_rows)


def run_stream(g: Given, stream: DataFrame, label: str, mode: str = "complete") -> DataFrame:
    """Run a stream over all that is there and return the table it keeps."""
    base = g.scratch(label)
    table = VersionedTable(g.spark, f"{base}/table")
    state.finish(state.run_to_table(stream, table, f"{base}/checkpoint", mode))
    return table.read()


def run_append(g: Given, stream: DataFrame, label: str) -> DataFrame:
    """Run an append-mode stream into Parquet."""
    base = g.scratch(label)
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{base}/checkpoint")
    state.finish(writer.option("path", f"{base}/table").trigger(availableNow=True).start())
    return g.spark.read.parquet(f"{base}/table")


@check("stream_parse", "SELECT event_id AS seq, metric_type, year, CAST(ts AS VARCHAR) AS sent_at, 1 AS record_count FROM sent")
def _(g):
    return run_append(g, messages.decode(message_stream(g)).select("seq", "metric_type", "year", "sent_at", "record_count"), "parse")


@check("json_decode", "SELECT event_id AS seq, metric_type, year, metric_value FROM sent")
def _(g):
    rows = messages.decode(message_batch(g))
    value = F.coalesce(F.col("data")[0]["avg_concentration"], F.col("data")[0]["avg_pollution"])
    return rows.select("seq", "metric_type", "year", value.alias("metric_value"))


@check("json_encode", """
SELECT event_id, to_json({'event_id': event_id, 'metric_type': metric_type, 'year': year, 'unit': unit}) AS value FROM fx_metric_rows""")
def _(g):
    return g.metric_rows.select("event_id", messages.encode("event_id", "metric_type", "year", "unit").alias("value"))


@check("filter_message_type", "SELECT metric_type, count(*) AS n FROM sent GROUP BY 1")
def _(g):
    return messages.decode(message_batch(g)).groupBy("metric_type").agg(F.count("*").alias("n"))


@check("filter_message_columns", "SELECT metric_type, count(*) AS n FROM sent WHERE event_id % 3 <> 0 GROUP BY 1")
def _(g):
    """Every third message lacks the setting field and must not reach the state."""
    cut = F.when(F.expr("seq % 3 = 0"), F.regexp_replace("value", '"environment_type":("[^"]*"|null),', "")).otherwise(F.col("value"))
    decoded = messages.decode(message_batch(g).withColumn("value", cut))
    kept = messages.explode_rows(decoded, CONCENTRATION).select(F.lit(CONCENTRATION).alias("metric_type")).union(
        messages.explode_rows(decoded, RISK).select(F.lit(RISK)))
    return kept.groupBy("metric_type").agg(F.count("*").alias("n"))


@check("iso_timestamp", "SELECT event_id, CAST(ts AS VARCHAR) AS stated FROM events")
def _(g):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return g.table("events").select("event_id", messages.message_time(text).alias("stated"))


def live_tables(g: Given) -> state.LiveTables:
    """The tables of one stream over all messages, a quarter of them broken and half of those not JSON at all.

    Messages arrive in two parts; the stream stops between them and goes on from its checkpoint.
    """
    broken = F.when(F.expr("seq % 8 = 0"), F.expr("concat('[', value, ']')")).when(F.expr("seq % 8 = 4"), F.expr("left(value, 25)"))

    def run(base: str) -> None:
        for part in ("ts < '2024-01-15'", "ts >= '2024-01-15'"):
            rows = as_messages(g.metric_rows.where(part)).withColumn("value", F.coalesce(broken, F.col("value")))
            rows.write.mode("append").parquet(f"{base}/landed")
            arriving = g.spark.readStream.schema(rows.schema).parquet(f"{base}/landed")
            state.finish(state.LiveTables(g.spark, f"{base}/tables").run(arriving, f"{base}/checkpoint"))

    base = g._written("live", run)
    return state.LiveTables(g.spark, f"{base}/tables")


@check("stream_skip_bad", """
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN event_id % 4 = 0 THEN 'unreadable' ELSE 'unknown type' END AS reason
 FROM fx_metric_rows WHERE event_id % 4 = 0 OR metric_type = 'heartbeat') GROUP BY 1""")
def _(g):
    return live_tables(g).rejected().groupBy("reason").agg(F.count("*").alias("n"))


@check("stream_explode_rows", """
SELECT event_id AS seq, year, ocean_region, environment_type, unit, metric_value AS avg_concentration, total_observations FROM sent
WHERE metric_type = 'avg_concentration_by_region'""")
def _(g):
    rows = messages.explode_rows(messages.decode(message_stream(g)), CONCENTRATION)
    return run_append(g, rows.select("seq", "year", "ocean_region", "environment_type", "unit", "avg_concentration",
                                     "total_observations"), "rows")


@check("stream_upsert_concentration", "SELECT * FROM s_conc")
def _(g):
    return run_stream(g, state.latest_rows_stream(message_stream(g), CONCENTRATION), "concentration")


@check("stream_upsert_risk", "SELECT * FROM s_risk")
def _(g):
    return run_stream(g, state.latest_rows_stream(message_stream(g), RISK), "risk")


@check("stream_null_key_append", """
SELECT * FROM k_conc WHERE environment_type IS NOT NULL UNION ALL
SELECT year, ocean_region, environment_type, unit, metric_value, total_observations FROM sent
WHERE metric_type = 'avg_concentration_by_region' AND environment_type IS NULL AND event_id % 4 <> 0""")
def _(g):
    return live_tables(g).rows(CONCENTRATION)


@check("stream_counts", "SELECT metric_type, count(*) AS messages, CAST(max(ts) AS VARCHAR) AS last_seen FROM sent GROUP BY 1")
def _(g):
    return run_stream(g, state.counts_stream(message_stream(g)), "counts")


@check("stream_last_seen", "SELECT CAST(max(ts) AS VARCHAR) AS last_seen FROM sent WHERE event_id % 4 <> 0")
def _(g):
    return live_tables(g).last_seen()


@check("stream_message_totals", "SELECT metric_type, count(*) AS messages FROM sent GROUP BY 1 UNION ALL SELECT NULL, count(*) FROM sent")
def _(g):
    return live.message_counts(messages.decode(message_batch(g)))


@check("stream_latest_by_type", """
SELECT metric_type, CAST(arg_max(ts, ts) AS VARCHAR) AS sent_at, arg_max(event_id, ts) AS seq, arg_max(year, ts) AS year, 1 AS record_count FROM sent GROUP BY 1""")
def _(g):
    return run_stream(g, state.latest_type_stream(message_stream(g)), "types")


@check("stream_recent_ring", """
SELECT CAST(ts AS VARCHAR) AS sent_at, event_id AS seq, metric_type, 1 AS record_count FROM sent ORDER BY ts DESC, event_id DESC LIMIT 500""")
def _(g):
    base = g.scratch("ring")
    table = VersionedTable(g.spark, f"{base}/table")
    state.finish(state.run_recent_ring(message_stream(g), table, f"{base}/checkpoint"))
    return table.read().drop("timestamp")


@check("src_topic_read", "SELECT metric_type, year, count(*) AS n FROM sent GROUP BY 1, 2")
def _(g):
    """Landed message files read as a stream, in place of a broker."""
    path = g.scratch("landed")
    write_message_files(message_batch(g), path)
    decoded = messages.decode(read_message_files(g.spark, path))
    return run_append(g, decoded.select("metric_type", "year"), "topic").groupBy("metric_type", "year").agg(F.count("*").alias("n"))


@check("stream_resume", "SELECT metric_type, count(*) AS messages, CAST(max(ts) AS VARCHAR) AS last_seen FROM sent GROUP BY 1")
def _(g):
    """Messages land in two halves; the stream is stopped between them and picks up from its checkpoint."""
    base = g.scratch("resume")
    table = VersionedTable(g.spark, f"{base}/table")
    for half in ("ts < '2024-01-15'", "ts >= '2024-01-15'"):
        write_message_files(as_messages(g.metric_rows.where(half)), f"{base}/landed")
        counted = state.counts_stream(read_message_files(g.spark, f"{base}/landed"))
        state.finish(state.run_to_table(counted, table, f"{base}/checkpoint"))
    return table.read()


# ---------------------------------------------------------------- live views

@check("agg_live_kpis", """
SELECT y AS current_year, CAST(coalesce((SELECT sum(total_observations) FROM k_conc WHERE year = y), 0) AS BIGINT) AS total_observations,
 (SELECT avg(avg_concentration) FROM k_conc WHERE year = y) AS avg_concentration, (SELECT avg(risk_index) FROM k_risk WHERE year = y) AS avg_risk
FROM (SELECT max(year) AS y FROM (SELECT year FROM k_conc UNION ALL SELECT year FROM k_risk))""", "avg_concentration avg_risk")
def _(g):
    tables = live_tables(g)
    return live.live_kpis(tables.rows(CONCENTRATION), tables.rows(RISK))


OCEANS = ["Arctic Ocean", "Atlantic Ocean", "Pacific Ocean"]


@check("agg_live_pivot", "SELECT year, " + ", ".join(
    f"coalesce(avg(avg_concentration) FILTER (WHERE ocean_region = '{o}'), 0) AS \"{o}\"" for o in OCEANS)
    + " FROM k_conc GROUP BY 1", OCEANS)
def _(g):
    return live.concentration_pivot(live_tables(g).rows(CONCENTRATION), OCEANS)


@check("agg_live_obs_by_year", """
SELECT year, CAST(t AS BIGINT) AS total_observations, avg(t) OVER () AS mean_of_years FROM (SELECT year, sum(total_observations) AS t FROM k_conc GROUP BY 1)""", "mean_of_years")
def _(g):
    return live.observations_by_year(live_tables(g).rows(CONCENTRATION))


@check("agg_live_risk_series", """
SELECT ocean_region, year, risk_index, environment_type, species_count, total_microplastics, avg_pollution, risk_raw FROM k_risk WHERE ocean_region IS NOT NULL""")
def _(g):
    return live.risk_series(live_tables(g).rows(RISK))


# ---------------------------------------------------------------- windows, alerts, indicators

# A tumbling window is complete once the watermark, the newest time less the lateness, has passed its end.
CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def timed_stream(g: Given) -> DataFrame:
    rows = event_stream(g)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def timed_batch(g: Given) -> DataFrame:
    return g.metric_rows.withColumn("ts", F.col("ts").cast("timestamp"))


@check("stream_windowed_metrics", f"""
SELECT CAST(w AS VARCHAR) AS window_start, CAST(w + INTERVAL 1 HOUR AS VARCHAR) AS window_end, metric_type, n, avg_value, max_value, min_value FROM (
 SELECT date_trunc('hour', ts) AS w, metric_type, count(metric_value) AS n, avg(metric_value) AS avg_value, max(metric_value) AS max_value,
  min(metric_value) AS min_value FROM fx_metric_rows GROUP BY 1, 2) WHERE w + INTERVAL 1 HOUR <= {CLOSED}""", "avg_value")
def _(g):
    """Tumbling windows of a stream, emitted once closed."""
    return run_append(g, windows.windowed_metrics(timed_stream(g), "ts", "metric_value", ["metric_type"], "1 hour"), "tumbling")


@check("stream_sliding_metrics", """
SELECT CAST(w AS VARCHAR) AS window_start, CAST(w + INTERVAL 5 MINUTE AS VARCHAR) AS window_end, metric_type, count(metric_value) AS n,
 avg(metric_value) AS avg_value, max(metric_value) AS max_value, min(metric_value) AS min_value
FROM fx_metric_rows, (SELECT unnest(generate_series(0, 4)) AS k), LATERAL (SELECT date_trunc('minute', ts) - to_minutes(k) AS w) GROUP BY 1, 2, 3""", "avg_value")
def _(g):
    return windows.windowed_metrics(timed_batch(g), "ts", "metric_value", ["metric_type"], "5 minutes", "1 minute")


@check("stream_threshold_alerts", """
SELECT event_id, CAST(ts AS VARCHAR) AS ts, metric_type, metric_value, CAST(100 AS DOUBLE) AS threshold FROM fx_metric_rows WHERE metric_value > 100""")
def _(g):
    alerts = windows.threshold_alerts(timed_stream(g), "metric_value", 100)
    return run_append(g, alerts.select("event_id", "ts", "metric_type", "metric_value", "threshold"), "alerts")


@check("stream_ops_indicators", """
SELECT CAST(w AS VARCHAR) AS window_start, valid, discarded, (valid + discarded)/3600.0 AS per_second, avg_ingest_seconds, max_ingest_seconds FROM (
 SELECT date_trunc('hour', ts + to_seconds(event_id % 7)) AS w, count(*) FILTER (WHERE metric_type <> 'heartbeat') AS valid,
  count(*) FILTER (WHERE metric_type = 'heartbeat') AS discarded, avg(event_id % 7) FILTER (WHERE metric_type <> 'heartbeat') AS avg_ingest_seconds,
  CAST(max(event_id % 7) FILTER (WHERE metric_type <> 'heartbeat') AS DOUBLE) AS max_ingest_seconds FROM fx_metric_rows GROUP BY 1)
WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts + to_seconds(event_id % 7)) - INTERVAL 10 MINUTE FROM events)""", "per_second avg_ingest_seconds")
def _(g):
    """Messages arrive up to six seconds after they were sent."""
    parsed = messages.parse(message_stream(g)).withColumns({
        "valid": F.coalesce(F.col("m.metric_type").isin(messages.ALLOWED_TYPES), F.lit(False)),
        "sent_at": messages.message_time("m.timestamp"),
        "arrival": F.expr("arrival + make_dt_interval(0, 0, 0, seq % 7)")})
    return run_append(g, windows.throughput(windows.with_latency(parsed), "arrival", "valid"), "rates")


def observation_stream(g: Given) -> DataFrame:
    schema = g.table("lineitem").schema
    lines = g.spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(g.sf_dir)
    return g.spark.sql(FIXTURES["fx_micro_raw"], lineitem=lines)


@check("stream_point_map_feed", "SELECT latitude, longitude, microplastics_measurement AS value FROM obs")
def _(g):
    return run_append(g, windows.point_feed(observation_stream(g)), "points")


@check("stream_new_records", """
SELECT CAST(w AS VARCHAR) AS window_start, CAST(w + INTERVAL 30 DAY AS VARCHAR) AS window_end, grid_id, n, avg_value, max_value, min_value FROM (
 SELECT time_bucket(INTERVAL 30 DAY, CAST(date AS TIMESTAMP), TIMESTAMP '1970-01-01') AS w, grid_id, count(microplastics_measurement) AS n,
  avg(microplastics_measurement) AS avg_value, max(microplastics_measurement) AS max_value, min(microplastics_measurement) AS min_value
 FROM obs WHERE date IS NOT NULL GROUP BY 1, 2)
WHERE w + INTERVAL 30 DAY <= (SELECT max(CAST(date AS TIMESTAMP)) - INTERVAL 10 MINUTE FROM obs)""")
def _(g):
    arriving = observation_stream(g).withColumn("date", F.col("date").cast("timestamp"))
    return run_append(g, windows.cell_metrics(arriving, "date"), "cells")
