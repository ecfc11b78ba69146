"""Sources, sinks, streams and the end-to-end run over files."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.climate import next_range
from tidemark.plans import etl, live, warehouse
from tidemark.plans.metrics import CONCENTRATION, RISK
from tidemark.session import path_exists
from tidemark.sinks import catalog
from tidemark.sinks import files as files_sink
from tidemark.sinks.files import VersionedTable
from tidemark.sources import files
from tidemark.sources.topic import read_message_files
from tidemark.streaming import messages, state, windows


def test_expected_columns(spark):
    df = spark.createDataFrame([("a", "b")], "scientificName string, other string")
    assert files.count_expected_columns(df) == 1


@pytest.mark.parametrize("text, names", [("a,b\n1,2\n", ["a", "b"]), ("a\tb\n1\t2\n", ["a", "b"]), ("a;b\n1;2\n", ["a", "b"]), ("a\n1\n", []), ("", [])])
def test_separator_is_found(spark, tmp_path, text, names):
    path = tmp_path / "x.csv"
    path.write_text(text)
    df = files.read_delimited(spark, str(path))
    assert df.columns == names and df.count() == (1 if names else 0)


def test_tsv_keeps_quotes_and_skips_bad_lines(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_text('scientificName\tyear\textra\nAa "b\t2001\tx\nCc\t2002\ty\tz\tz\nDd\t2003\tw\n', encoding="utf-8")
    kept = files.read_occurrences_tsv(spark, str(path), skip_bad=True)
    assert [(r.scientificName, r.year) for r in kept.orderBy("year").collect()] == [('Aa "b', 2001), ("Dd", 2003)]
    assert files.read_occurrences_tsv(spark, str(path)).count() == 3


def test_catalog_table_from_an_inferred_batch(spark, tmp_path):
    name, path = "loaded_batches", str(tmp_path / "table")

    def land_text(folder, text):
        (tmp_path / folder).write_text(text)
        return files.read_delimited(spark, str(tmp_path / folder), infer=True)

    try:
        first = catalog.load_table(land_text("1.csv", "id,v,day\n1,1.5,2020-01-01\n2,NaN,2020-01-02\n"), name, path)
        kinds = dict(first.dtypes)
        assert (kinds["id"], kinds["v"]) == ("int", "double") and first.where("v is null").count() == 1
        catalog.load_table(land_text("2.csv", "day,v,id\n2020-01-03,7,3\n"), name, path)  # other order, whole numbers
        assert spark.table(name).dtypes == first.dtypes and spark.table(name).where("id = 3").first().v == 7.0
        for text, wrong in (("id,v\n1,2\n", "missing columns: day"), ("id,v,day,x\n1,2,2020-01-01,y\n", "unknown columns: x"),
                            ("id,v,day\n1.5,2,2020-01-01\n2,2,2020-01-01\n", "id: 1 values are no int"), ("id,v,day\n9,n/a,2020-01-01\n", "v: 1 values are no double")):
            with pytest.raises(ValueError, match=wrong):
                catalog.load_table(land_text("bad.csv", text), name, path)
        assert spark.sql(f"SELECT count(*) AS n FROM {name}").first().n == 3
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_unfinished_extract_is_redone(spark, tmp_path):
    path = tmp_path / "x"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"broken")
    assert files.cached_extract(spark, str(path), lambda: spark.range(3)).count() == 3


def test_placeholder_for_few_rows(spark):
    assert files.or_placeholder(spark.range(3), spark, "id bigint, x string").count() == 3
    assert files.or_placeholder(None, spark, "x string").count() == 0


def test_versioned_table_survives_a_broken_write(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), keep=2)
    assert table.read() is None
    for n in (1, 2, 3, 4):
        table.replace(spark.range(n))
    (tmp_path / "t" / "v=4").mkdir()
    assert table.read().count() == 4
    assert table.replace(table.read().union(spark.range(1))).count() == 5
    assert not path_exists(spark, str(tmp_path / "t" / "v=0"))


def folder_times(root):
    return {p.name: {f.name: f.stat().st_mtime_ns for f in p.glob("*.parquet")} for p in root.glob("partition_start=*")}


def test_history_rewrites_only_the_days_of_a_batch(spark, tmp_path):
    root = tmp_path / "history"
    history = files_sink.DatedTable(spark, str(root), grain="day")
    assert history.read() is None and history.manifest() is None
    rows = lambda *given: spark.createDataFrame(given, "date string, grid_id string, seq int, v double").withColumn("date", F.col("date").cast("date"))
    order = ["seq"]
    files_sink.append_history(history, rows(*[(f"2020-01-0{d}", "a", 1, 1.0) for d in range(1, 6)], (None, "a", 1, 1.0)), order, "one")
    before = folder_times(root)
    assert len(before) == 6
    more = rows(("2020-01-03", "a", 2, 7.0), ("2020-01-03", "b", 1, 8.0), ("2020-01-04", "a", 0, 9.0), ("2020-02-01", "a", 1, 5.0)).withColumn("unit", F.lit("m"))
    for batch in ("two", "two"):
        after = files_sink.append_history(history, more, order, batch)
        times = folder_times(root)
        for day in ("2020-01-01", "2020-01-02", "2020-01-05", "__HIVE_DEFAULT_PARTITION__"):
            assert times[f"partition_start={day}"] == before[f"partition_start={day}"]
        got = {(str(r.date), r.grid_id): (r.v, r.unit) for r in after.collect()}
        assert len(got) == after.count() == 8
        assert got["2020-01-03", "a"] == (7.0, "m") and got["2020-01-03", "b"] == (8.0, "m") and got["2020-01-04", "a"] == (1.0, None)
        assert got["2020-02-01", "a"] == (5.0, "m") and got["None", "a"] == (1.0, None)
    days = {str(r.start): (r.n_rows, r.batch) for r in history.manifest().collect()}
    assert days == {"2020-01-01": (1, "one"), "2020-01-02": (1, "one"), "2020-01-05": (1, "one"), "None": (1, "one"),
                    "2020-01-03": (2, "two"), "2020-01-04": (1, "two"), "2020-02-01": (1, "two")}
    assert str(next_range(history.dates(), 10).first().end_date) == "2020-01-31"
    assert history.between("2020-01-03", "2020-01-04").count() == 3
    files_sink.append_history(history, rows((None, "a", 5, 6.0)), order, "three")
    assert history.read().where("date is null").first().v == 6.0 and history.read().count() == 8
    with pytest.raises(ValueError):
        history.merge(more, ["grid_id"], order, "x")
    months = files_sink.DatedTable(spark, str(tmp_path / "months"))
    files_sink.append_history(months, history.read(), order, "all")
    plan = months.between("2020-01-03", "2020-01-31")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_start" in plan and months.between("2020-01-03", "2020-01-31").count() == 4
    assert [(str(r.start), str(r.oldest), str(r.newest), r.n_rows) for r in months.manifest().orderBy("start").collect()] == [
        ("None", "None", "None", 1), ("2020-01-01", "2020-01-01", "2020-01-05", 6), ("2020-02-01", "2020-02-01", "2020-02-01", 1)]


@pytest.mark.parametrize("newest, start, end", [("2021-01-01", "2020-01-02", "2020-12-31"), ("2020-03-01", "2020-01-01", "2020-02-29"), ("2020-01-01", None, None)])
def test_request_range(spark, newest, start, end):
    history = spark.createDataFrame([(newest,)], "date string")
    row = next_range(history, 365, "2020-01-01").first()
    assert [str(v) if v else None for v in row] == [start, end]
    none_yet = next_range(history.limit(0), 10, "2020-01-01").first()
    assert (str(none_yet.start_date), str(none_yet.end_date)) == ("2023-12-21", "2023-12-30")


def concentration(year, value, ocean="A", at="2024-01-01T00:00:00", setting="Beach"):
    data = [{"ocean_region": ocean, "environment_type": setting, "avg_concentration": value, "total_observations": 2, "unit": "u"}]
    return json.dumps({"metric_type": CONCENTRATION, "year": year, "timestamp": at, "data": data, "record_count": 1})


BAD = ["not json", "[1, 2]", "7", '{"metric_type": "other", "year": 1}', '{"broken": ', ""]


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def latest(spark, tmp_path, folder):
    table = VersionedTable(spark, str(tmp_path / "table"))
    stream = state.latest_rows_stream(read_message_files(spark, str(folder)), CONCENTRATION)
    state.finish(state.run_to_table(stream, table, str(tmp_path / "checkpoint")))
    return {(r.year, r.ocean_region, r.environment_type): r.avg_concentration for r in table.read().collect()}


def test_stream_skips_bad_orders_by_time_and_resumes(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "1.txt", [concentration(2000, 1.0), concentration(2000, 3.0, at="2024-01-03T00:00:00"), *BAD])
    land(folder, "2.txt", [concentration(2000, 2.0, at="2024-01-02T00:00:00"), concentration(2001, 9.0, setting=None)])
    assert latest(spark, tmp_path, folder) == {(2000, "A", "Beach"): 3.0, (2001, "A", None): 9.0}
    land(folder, "3.txt", [concentration(2000, 4.0, at="2024-01-04T00:00:00"), concentration(2001, 8.0, at="2024-02-01T00:00:00", setting=None)])
    assert latest(spark, tmp_path, folder) == {(2000, "A", "Beach"): 4.0, (2001, "A", None): 8.0}


def test_rejected_messages_are_told_apart(spark):
    raw = spark.createDataFrame([(m,) for m in [*BAD, concentration(2000, 1.0)]], "value string")
    reasons = [r.reason for r in messages.rejected(raw).collect()]
    assert sorted(reasons) == ["unknown type"] + ["unreadable"] * 5
    assert messages.decode(raw).count() == 1


def test_missing_fields_do_not_reach_the_state_but_are_counted(spark):
    partial = json.dumps({"metric_type": RISK, "year": 2000, "timestamp": "t", "data": [{"ocean_region": "A"}], "record_count": 1})
    empty = json.dumps({"metric_type": RISK, "year": 2000, "data": [], "record_count": 0})
    decoded = messages.decode(spark.createDataFrame([(partial,), (empty,)], "value string"))
    assert decoded.count() == 2
    assert messages.explode_rows(decoded, RISK).count() == 0
    assert decoded.where("sent_at IS NULL").count() == 0


def message(metric, year, rows, at):
    return json.dumps({"metric_type": metric, "year": year, "timestamp": at, "data": rows, "record_count": len(rows)})


def test_all_rows_of_the_latest_message_stay_and_fields_count_over_all_rows(spark):
    row = {"ocean_region": "A", "environment_type": "Beach", "avg_concentration": 1.0, "total_observations": 1, "unit": "u"}
    without_unit = {k: v for k, v in row.items() if k != "unit"}
    raw = [
        (message(CONCENTRATION, 2000, [row], "2024-01-01T00:00:00"), 1),
        (message(CONCENTRATION, 2000, [row | {"avg_concentration": 2.0}, row | {"avg_concentration": 3.0}, row | {"ocean_region": "B"}], "2024-01-02T00:00:00"), 2),
        (message(CONCENTRATION, 2001, [without_unit, row], "2024-01-02T00:00:00"), 3),  # one row names the unit
        (message(CONCENTRATION, 2002, [without_unit], "2024-01-02T00:00:00"), 4),
        (message(CONCENTRATION, None, [row], "2024-01-02T00:00:00"), 5),
    ]
    decoded = messages.decode(spark.createDataFrame(raw, "value string, seq bigint"))
    got = live.latest_by_key(messages.explode_keys(decoded, CONCENTRATION), CONCENTRATION, state.ARRIVAL_ORDER).collect()
    assert sorted((r.year, r.ocean_region, r.unit or "", r.avg_concentration) for r in got) == [
        (2000, "A", "u", 2.0), (2000, "A", "u", 3.0), (2000, "B", "u", 1.0), (2001, "A", "", 1.0), (2001, "A", "u", 1.0)]


def test_live_tables_survive_restarts_and_repeated_batches(spark, tmp_path):
    folder = tmp_path / "in"
    tables = state.LiveTables(spark, str(tmp_path / "tables"))
    with pytest.raises(ValueError):
        tables.rows(CONCENTRATION)
    risk = {"ocean_region": "A", "environment_type": "Beach", "avg_pollution": 1.0, "species_count": 2, "risk_index": 5.0}

    def run():
        state.finish(state.LiveTables(spark, str(tmp_path / "tables")).run(read_message_files(spark, str(folder)), str(tmp_path / "cp")))

    def kept():
        return (sorted(map(str, tables.rows(CONCENTRATION).collect())), sorted(map(str, tables.rows(RISK).collect())),
                sorted(map(str, tables.rejected().collect())), sorted(map(str, tables.counts().collect())))

    land(folder, "1.txt", [concentration(2000, 1.0), concentration(2001, 1.0, setting=None), message(RISK, 2000, [risk], "2024-01-05T00:00:00"), *BAD])
    run()
    first = kept()
    land(folder, "2.txt", [concentration(2000, 4.0, at="2024-01-04T00:00:00"), concentration(2001, 9.0, at="2024-01-04T00:00:00", setting=None), "broken"])
    run()
    rows = {(r.year, r.environment_type, r.avg_concentration) for r in tables.rows(CONCENTRATION).collect()}
    assert rows == {(2000, "Beach", 4.0), (2001, None, 1.0), (2001, None, 9.0)} and tables.rows(RISK).count() == 1
    assert tables.rejected().count() == len(BAD) + 1 and tables.rejected().where("reason = 'unreadable'").count() == len(BAD)
    assert {r.metric_type: r.messages for r in tables.counts().collect()} == {CONCENTRATION: 4, RISK: 1}
    assert str(tables.last_seen().first()[0]) == "2024-01-05 00:00:00"
    after = kept()
    assert after != first
    again = spark.createDataFrame([(line,) for line in (folder / "2.txt").read_text().splitlines()], "value string").withColumn("seq", F.xxhash64("value"))
    tables.take(again, 1)  # the second batch once more, as after a failure
    assert kept() == after
    assert "json" not in live.live_kpis(tables.rows(CONCENTRATION), tables.rows(RISK))._jdf.queryExecution().toString().lower()


def test_messages_of_a_batch_are_parsed_once(spark, tmp_path, monkeypatch):
    """What is rejected and what counts come from one parsed table; a key's rows are found once for each metric."""
    written, write = [], state.materialize
    monkeypatch.setattr(state, "materialize", lambda df, path: written.append((path.rsplit("/", 1)[-1], df)) or write(df, path))
    tables = state.LiveTables(spark, str(tmp_path / "tables"))
    lines = [concentration(2000, 1.0), concentration(2001, 1.0, setting=None), *BAD]
    tables.take(spark.createDataFrame([(line,) for line in lines], "value string").withColumn("seq", F.xxhash64("value")), 0)
    assert [name for name, _ in written] == ["parsed", "decoded", *state.KEYS]
    envelopes = [name for name, df in written if "from_json(StructField(metric_type" in df._jdf.queryExecution().analyzed().toString()]
    assert envelopes == ["parsed"]
    assert tables.rejected().count() == len(BAD) and tables.rows(CONCENTRATION).count() == 2
    assert {r.metric_type: r.messages for r in tables.counts().collect()} == {CONCENTRATION: 2}


def test_latencies_are_observed(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "1.txt", [concentration(2000, 1.0, at="2024-01-01T00:00:00"), concentration(2000, 2.0, at="2024-01-01T00:00:50"), "broken"])
    raw = read_message_files(spark, str(folder))
    parsed = messages.parse(raw).select("m", F.lit("2024-01-01 00:01:00").cast("timestamp").alias("arrival")).withColumns({
        "valid": F.col("m.metric_type").isNotNull(), "sent_at": F.col("m.timestamp").try_cast("timestamp")})
    listener = windows.OpsListener()
    spark.streams.addListener(listener)
    try:
        stream = windows.observed(windows.with_latency(parsed), "valid")
        state.finish(stream.select("ingest_seconds").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True).start(str(tmp_path / "out")))
        deadline = time.time() + 30
        while not listener.batches and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    got = listener.batches[0]
    assert (got["valid"], got["discarded"], got["input_rows"]) == (2, 1, 3)
    assert (got["avg_ingest_seconds"], got["max_ingest_seconds"]) == (35.0, 60.0)
    assert got["avg_processing_seconds"] > 86400 and got["batch_millis"] >= 0


def test_recent_ring_is_bounded(spark, tmp_path):
    folder = tmp_path / "in"
    table = VersionedTable(spark, str(tmp_path / "ring"))
    for part in range(3):
        land(folder, f"{part}.txt", [concentration(2000 + part, float(i), at=f"2024-01-0{part + 1}T00:00:{i:02d}") for i in range(8)])
        state.finish(state.run_recent_ring(read_message_files(spark, str(folder)), table, str(tmp_path / "cp"), keep=10))
    times = [r.timestamp for r in table.read().orderBy(F.desc("sent_at")).collect()]
    assert len(times) == 10 and times[0] == "2024-01-03T00:00:07" and times[-1] == "2024-01-02T00:00:06"


def test_late_rows_are_dropped(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path / "out")

    def run():
        rows = spark.readStream.schema("t timestamp, k string, v double").json(str(folder))
        query = windows.windowed_metrics(rows, "t", "v", ["k"], "1 hour").writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(base)
        state.finish(query)
        assert windows.progress_indicators(query)["input_rows"] >= 0
        return {(r.window_start.hour, r.n, r.avg_value) for r in spark.read.parquet(base).collect()}

    line = lambda t, v: json.dumps({"t": f"2024-01-01T{t}Z", "k": "a", "v": v})
    land(folder, "1.json", [line("00:10:00", 1.0), line("00:20:00", 3.0), line("03:00:00", 5.0)])
    assert run() == {(0, 2, 2.0)}
    land(folder, "2.json", [line("00:30:00", 100.0), line("06:00:00", 7.0)])
    assert run() == {(0, 2, 2.0), (3, 1, 5.0)}


def test_alerts_and_points(spark):
    rows = spark.createDataFrame([(50.0, -100.0, 3.0), (1.0, -100.0, 9.0), (None, -100.0, 1.0)], "latitude double, longitude double, microplastics_measurement double")
    assert windows.threshold_alerts(rows, "microplastics_measurement", 2).count() == 2
    assert [r.value for r in windows.point_feed(rows).collect()] == [3.0]


# ---------------------------------------------------------------- end to end

@pytest.fixture(scope="module")
def sources(spark):
    observations = spark.createDataFrame(
        [(i, f"0{i % 9 + 1}-15-2020", 30.0 + i, -90.0 - i, "items/l", "Beach", float(i)) for i in range(12)],
        "OBJECTID bigint, `Date (MM-DD-YYYY)` string, `Latitude (degree)` double, `Longitude(degree)` double, Unit string, `Marine Setting` string, `Microplastics measurement` double")
    occurrences = spark.createDataFrame(
        [(f"Aa b{'c' * (i % 3)}", "Animalia", "P", "C", "O", "F", "G", 30.2 + i, -90.3 - i, f"2019-05-{i + 1:02d}") for i in range(12)],
        "scientificName string, kingdom string, phylum string, class string, `order` string, family string, genus string, decimalLatitude double, decimalLongitude double, eventDate string")

    def climate(catalog):
        return catalog.select(
            F.lit("2020-03-15").alias("date"), F.col("grid_lat").alias("latitude"), F.col("grid_lon").alias("longitude"),
            *[F.lit(2.5).alias(c) for c in ("wave_direction_dominant", "wave_period_max", "wave_height_max", "wind_wave_direction_dominant", "swell_wave_height_max")])

    return observations, occurrences, climate


def config(sources, tmp_path, **changes):
    observations, occurrences, climate = sources
    return etl.RunConfig(work_dir=str(tmp_path), extract_observations=lambda: observations, extract_occurrences=lambda: occurrences,
                         extract_climate=climate, current_year=2026, **changes)


def test_run_and_run_again(spark, sources, tmp_path):
    first = etl.run(spark, config(sources, tmp_path, load_id="a"))
    assert first.missing == [] and first.warehouse.fact.count() == 12
    fused = spark.read.parquet(first.paths["fused"])
    assert fused.count() == 12 and len(fused.columns) == 32
    assert fused.where("wave_height_max IS NOT NULL").count() == fused.where("month = 3").count() > 0
    assert fused.where("scientific_name IS NOT NULL").count() > 0
    assert set(first.reports) == {"pre", "post"} and spark.read.parquet(first.reports["post"]["rules"]).count() > 20
    again = etl.run(spark, config(sources, tmp_path, load_id="b"))
    assert again.warehouse.fact.count() == 24 and again.warehouse.dim_location.count() == first.warehouse.dim_location.count()


def test_run_cleans_observations_once_and_checks_side_by_side(spark, sources, tmp_path, monkeypatch):
    read, stages, together = [], [], threading.Barrier(3, timeout=120)
    catalogue, check = etl.grid_catalog, quality.check
    monkeypatch.setattr(etl, "grid_catalog", lambda df: read.append(df.inputFiles()) or catalogue(df))

    def met(df, rules, dataset, stage):
        together.wait()  # breaks unless all three datasets are under way
        stages.append((stage, dataset))
        return check(df, rules, dataset, stage)

    monkeypatch.setattr(quality, "check", met)
    result = etl.run(spark, config(sources, tmp_path, load_id="a"))
    assert len(read) == 1 and read[0] and all("/clean/observations/" in f for f in read[0])
    assert len(stages) == len(set(stages)) == 6
    for stage in ("pre", "post"):
        assert spark.read.parquet(result.reports[stage]["rules"]).select("dataset").distinct().count() == 3
    written = {r["grid_id"] for r in spark.read.parquet(result.paths["catalog"]).collect()}
    assert written == {r["grid_id"] for r in etl.first_pass_catalog(sources[0]).collect()}


def test_run_on_text_with_unreadable_values(spark, sources, tmp_path):
    observations, occurrences, climate = sources
    as_text = lambda df: df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    odd = as_text(observations).withColumn("Microplastics measurement", F.when(F.col("OBJECTID") == "3", "n/a").otherwise(F.col("Microplastics measurement")))
    odd = odd.withColumn("Date (MM-DD-YYYY)", F.when(F.col("OBJECTID") == "4", "spring").otherwise(F.col("Date (MM-DD-YYYY)")))
    odd = odd.withColumn("Latitude (degree)", F.when(F.col("OBJECTID") == "5", "north").otherwise(F.col("Latitude (degree)")))
    cfg = config((odd, as_text(occurrences), lambda catalog: as_text(climate(catalog))), tmp_path, load_id="a")
    result = etl.run(spark, cfg)
    assert result.missing == [] and result.warehouse.fact.count() == 10  # one unmeasured, one without a place
    assert result.warehouse.fact.where("dim_date_date_id IS NULL").count() == 1
    pre = spark.read.parquet(result.reports["pre"]["rules"])
    assert pre.where("dataset = 'species'").count() > 5  # raw names are known to the rules
    assert {r.violations for r in warehouse.integrity_violations(result.warehouse).collect()} == {0}


def test_gate(spark, sources, tmp_path):
    observations, occurrences, climate = sources
    bad = (observations.withColumn("Unit", F.lit("odd")).drop("OBJECTID"), occurrences, climate)
    result = etl.run(spark, config(bad, tmp_path / "warn"))
    assert result.missing == ["objectid"] and result.warehouse.fact.count() == 12
    with pytest.raises(ValueError, match="stage pre"):
        etl.run(spark, config(bad, tmp_path / "fail", gate="fail"))
