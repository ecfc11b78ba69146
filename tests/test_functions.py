"""Scalar expressions and table operators against plain Python, NumPy and pandas."""

import datetime as dt
import math
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo, values
from tidemark.functions.keys import surrogate_key
from tidemark.operators import asof, clean, columns, dedup, profile, selection, skew
from tidemark.operators.grid import assign_to_nearest_cell, grid_catalog, search_rings, snap_to_grid
from tidemark.operators.taxonomy import community_by_cell
from tidemark.plans import analytics


def one(spark, *exprs, **cells):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cells.items()]).select(*exprs).first()
    return row[0] if len(exprs) == 1 else tuple(row)


@pytest.mark.parametrize("lat, lon, inside", [
    (5.0, -180.0, True), (83.0, -50.0, True), (4.999, -100.0, False), (83.001, -100.0, False), (40.0, -49.99, False)])
def test_region_edges(spark, lat, lon, inside):
    df = spark.createDataFrame([(lat, lon)], "latitude double, longitude double")
    assert (clean.filter_region(df).count() == 1) is inside


def test_null_coordinates_leave_the_region(spark):
    df = spark.createDataFrame([(None, -100.0), (50.0, None)], "latitude double, longitude double")
    assert clean.filter_region(df).count() == 0


@pytest.mark.parametrize("lat, lon, ocean, two", [
    (71.0, -100.0, "Arctic Ocean", "Pacific Ocean"), (70.0, -100.0, "Atlantic Ocean", "Pacific Ocean"),
    (50.0, -100.1, "Pacific Ocean", "Pacific Ocean"), (50.0, -99.9, "Atlantic Ocean", "Atlantic Ocean")])
def test_oceans(spark, lat, lon, ocean, two):
    got = one(spark, geo.infer_ocean("a", "b"), geo.ocean_by_longitude("b"), a=lat, b=lon)
    assert got == (ocean, two)


@pytest.mark.parametrize("lat, lon", [(24.9, -80.2), (25.0, -81.0), (27.0, -79.0), (-0.4, 0.4), (83.0, -180.0), (5.0, -50.0)])
def test_snap_rounds_half_to_even(spark, lat, lon):
    df = spark.createDataFrame([(lat, lon)], "latitude double, longitude double")
    row = snap_to_grid(df).first()
    want_lat, want_lon = round(lat / 2) * 2.0, round(lon / 2) * 2.0
    assert (row.grid_lat, row.grid_lon) == (want_lat, want_lon)
    assert math.copysign(1, row.grid_lat) == (1 if want_lat >= 0 else -1)
    name = f"{'N' if want_lat >= 0 else 'S'}{abs(want_lat):05.1f}{'E' if want_lon >= 0 else 'W'}{abs(want_lon):06.1f}"
    assert row.grid_id == name.replace(".", "_")


def compass(value):
    try:
        return geo.CARDINALS[int((float(value) % 360 + 22.5) // 45) % 8]
    except ValueError:
        return value.strip().upper()[:2]


@pytest.mark.parametrize("value", ["0", "22.4", "22.5", "337.4", "337.5", "359.9", "720", "-45", " nw ", "sur", "n", "nan"])
def test_cardinal(spark, value):
    assert one(spark, geo.cardinal_direction("v"), v=value) == compass(value)


@pytest.mark.parametrize("text, want", [
    ("03-14-2020", "2020-03-14"), ("2020-03-14", "2020-03-14"), ("3/4/2020", "2020-03-04"),
    ("3/4/2020 12:00:00 AM", "2020-03-04"), (" 03-14-2020 ", "2020-03-14"), ("soon", None), ("", None)])
def test_dates(spark, text, want):
    got = one(spark, values.coerce_date("t"), t=text)
    assert (str(got) if got else None) == want


def test_numbers_and_blanks(spark):
    got = one(spark, values.coerce_numeric("a"), values.coerce_numeric("b"), values.blank_to_null("c"), values.blank_to_null("d"),
              values.norm_number("e"), values.norm_number("f"), a=" 7.5 ", b="seven", c=" \t x\n", d="  ", e=1.23456789, f=float("nan"))
    assert got == (7.5, None, "x", None, 1.234568, None)


def test_size_is_clipped(spark):
    assert one(spark, *[values.log_scaled_size(F.lit(v)) for v in (None, 0.0, 1.0, 1e9)]) == (5.0, 5.0, math.log1p(1) * 10, 100.0)


@pytest.mark.parametrize("heights", [[1.0, 2.0, 3.5, 4.0, 9.0, None, 1.0], [3.0, 3.0], [0.0, 0.0]])
def test_bins_agree_with_cut(spark, heights):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(heights)], "i int, wave_height_max double")
    got = [r.wave_bin for r in analytics.with_wave_bin(df).orderBy("i").collect()]
    want = pd.cut(pd.Series(heights, dtype=float), bins=5, labels=False)
    assert got == [None if pd.isna(w) else int(w) for w in want]


@pytest.mark.parametrize("numbers", [[1.0, 2.0, 2.5, 7.0, 10.0], [4.0, 4.0, 4.0]])
def test_histogram_agrees_with_numpy(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    got = {r.bin: r.n for r in profile.histogram(df).collect()}
    counts, _ = np.histogram(numbers, bins=20)
    assert got == {i: c for i, c in enumerate(counts) if c}


def test_exact_quantiles(spark, monkeypatch):
    monkeypatch.setattr(selection, "FEW", 20)
    rng = random.Random(1)
    odd = {"odd": [-math.inf, -1e308, 1e308, math.inf, math.nan, 5e-324, 0.0], "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(3000)],
           "one": [4.0], "same": [2.5] * 50, "mixed": [rng.choice([rng.gauss(0, 1), 3.0]) for _ in range(5000)]}
    rows = [(name, v) for name, values in odd.items() for v in values] + [("mixed", None), ("none", None)]
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.column_name, r.p): r.quantile for r in selection.quantiles(spark.createDataFrame(rows, "column_name string, value double"), shares).collect()}
    assert len(got) == len(odd) * len(shares)
    for name, values in odd.items():
        values = sorted(v for v in values if not math.isnan(v)) + [v for v in values if math.isnan(v)]
        for p in shares:
            at = p * (len(values) - 1)
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            want = low if at == int(at) or low == high or math.isinf(low) else low + (high - low) * (at - int(at))
            assert got[name, p] == want or math.isnan(want) and math.isnan(got[name, p]), (name, p)


@pytest.mark.parametrize("kind, make", [
    ("int", lambda r: r.randint(-50, 2**31 - 1)), ("bigint", lambda r: r.choice([-2**63, 2**63 - 1, 2**62 + r.randint(0, 9000), 2**62])),
    ("double", lambda r: r.choice([r.gauss(0, 1e-9), 1e300 * r.random(), -0.5, math.nan, math.inf, -math.inf])),
    ("float", lambda r: r.choice([0.1, 1.5, 3e38, -3e38, r.random()])), ("boolean", lambda r: r.random() < 0.3),
    ("decimal(38,6)", lambda r: Decimal(10) ** 29 + Decimal(r.randint(0, 4000)) / 1000), ("decimal(5,2)", lambda r: Decimal(r.randint(-9000, 9000)) / 100),
    ("date", lambda r: dt.date(1970, 1, 1) + dt.timedelta(days=r.randint(-9000, 9000))), ("timestamp", lambda r: dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=r.randint(0, 10**13))),
    ("string", lambda r: "common prefix " * r.randint(0, 2) + r.choice(["", "a", "é", "日本", "z" * r.randint(0, 40), str(r.random())])),
    ("binary", lambda r: bytes(r.randint(0, 255) for _ in range(r.randint(0, 3))))])
def test_heads_of_any_type(spark, monkeypatch, kind, make):
    """The head of a table by a column with nulls and ties, then by a number; against a sort of the whole table."""
    monkeypatch.setattr(dedup, "SMALL_HEAD", 5)
    monkeypatch.setattr(selection, "FEW", 30)
    rng = random.Random(kind)
    rows = [(None if rng.random() < 0.05 else make(rng), i % 700) for i in range(1400)]
    df = spark.createDataFrame(rows, f"a {kind}, b int").repartition(4)
    shown = lambda frame: [str(r) for r in frame.collect()]
    whole = shown(df.orderBy("a", "b"))
    for n in (20, 60, 333, 1399, 5000):
        head = dedup.head_rows(df, ["a", "b"], n)
        assert shown(head) == whole[:n]
        assert "TakeOrderedAndProject" not in head._jdf.queryExecution().executedPlan().toString()
    assert dedup.head_rows(df, ["a"], 777).count() == 777  # cut within ties of all keys


def brute_nearest(points, cells, max_km):
    out = []
    for i, lat, lon in points:
        best = min(((math.sqrt((c[1] - lat) ** 2 + (c[2] - lon) ** 2) * 111, c[1], c[2], c[0]) for c in cells), default=None)
        out.append((i, best[3] if best and best[0] <= max_km else None))
    return sorted(out)


@pytest.mark.parametrize("precision, max_km", [(2.0, 250.0), (1.0, 250.0), (2.0, 100.0), (3.0, 400.0)])
@pytest.mark.parametrize("extent", [None, geo.NORTH_AMERICA])
def test_nearest_cell_is_brute_force(spark, precision, max_km, extent):
    rng = random.Random(7)
    seeds = [(i, rng.uniform(5, 83), rng.uniform(-180, -50)) for i in range(120)]
    points = [(i, rng.uniform(5, 83), rng.uniform(-180, -50)) for i in range(400)]
    points += [(1000 + i, 30.0 + precision / 2, -100.0) for i in range(3)]  # on an edge between cells
    ddl = "id int, latitude double, longitude double"
    catalog = grid_catalog(snap_to_grid(spark.createDataFrame(seeds, ddl), precision=precision))
    target = spark.createDataFrame([*points, (5000, None, -100.0)], ddl)
    got = assign_to_nearest_cell(target, catalog, max_km=max_km, precision=precision, extent=extent, salts=3)
    cells = [(c.grid_id, c.grid_lat, c.grid_lon) for c in catalog.collect()]
    assert sorted((r.id, r.grid_id) for r in got.where("id < 5000").collect()) == brute_nearest(points, cells, max_km)
    assert got.where("id = 5000").first().grid_id is None
    assert got.count() == len(points) + 1


def test_search_rings():
    assert search_rings(2.0, 250) == 1 and search_rings(1.0, 250) == 2 and search_rings(5.0, 250) == 0


def test_nearest_date_is_merge_asof(spark):
    rng = random.Random(3)
    day = pd.Timestamp("2020-01-01")
    right = {(rng.choice("ab"), day + pd.Timedelta(days=rng.randrange(900))) for _ in range(25)}
    left = [(i, rng.choice("abc"), day + pd.Timedelta(days=rng.randrange(900))) for i in range(300)] + [(900, None, day), (901, "a", None)]
    right_rows = [(k, d.date(), float(n)) for n, (k, d) in enumerate(sorted(right))]
    ldf = spark.createDataFrame([(i, k, d.date() if d is not None else None) for i, k, d in left], "i int, k string, date date")
    rdf = spark.createDataFrame(right_rows, "k string, date date, v double")
    got = {r.i: r.v for r in asof.nearest_date_join(ldf, rdf, "k", "date", ["v"]).collect()}
    assert len(got) == len(left)
    for i, k, d in left:
        near = sorted((abs((d.date() - rd).days), rd, v) for rk, rd, v in right_rows if d is not None and rk == k)
        assert got[i] == (near[0][2] if near and near[0][0] <= 60 else None)


def test_salted_lookup_keeps_rows(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("cold", 1), ("none", 2), (None, 3)], "k string, i int")
    right = spark.createDataFrame([("hot", 1.0), ("cold", 2.0)], "k string, v double")
    got = skew.salted_lookup(left, right, ["k"], salts=5)
    assert got.count() == 503 and got.where("v = 1").count() == 500 and got.where("v IS NULL").count() == 2


def test_counted_lookup_keeps_rows(spark):
    left = spark.createDataFrame([("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(1500)] + [(None, 7)] * 5, "k string, i int")
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    right = counts.withColumn("v", F.when(F.col("k") != "k3", F.length("k")))
    got = skew.lookup_counted(left, right, ["k"], "n")
    assert got.columns == ["k", "i", "v"] and got.count() == 4505
    assert got.where("k = 'hot' AND v = 3").count() == 3000 and got.where("v IS NULL").count() == 6


def test_duplicates_with_a_hot_group_and_nulls(spark):
    rows = [("x", None)] * 3000 + [("y", i) for i in range(2000)] + [(None, None)] * 2 + [("z", 5)] * 2
    df = spark.createDataFrame(rows, "a string, b int")
    got = dedup.duplicate_rows(df)
    assert got.count() == 3004 and got.where("a IS NULL").count() == 2
    assert dedup.count_duplicate_groups(df).first()[0] == 3


def test_keep_last_takes_whole_rows(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, "b"), ("k", 3, None), (None, 1, "n"), (None, 2, "m")], "k string, seq int, v string")
    assert sorted(map(str, dedup.keep_last(df, ["k"], ["seq"]).collect())) == sorted(
        ["Row(k='k', seq=3, v=None)", "Row(k=None, seq=2, v='m')"])


def test_large_head_is_exact(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SMALL_HEAD", 10)
    numbers = list(range(3000))
    random.Random(2).shuffle(numbers)
    df = spark.createDataFrame([(n // 3, n) for n in numbers] + [(None, 9999)], "a int, b int")
    for n in (11, 500, 2900, 5000):
        got = [r.b for r in dedup.head_rows(df, ["a", "b"], n).collect()]
        assert got == [9999, *range(3000)][:n]


def test_samples_are_repeatable(spark):
    df = spark.range(20000)
    once, twice = (set(r.id for r in dedup.sample_fraction(df.repartition(n), 0.5, ["id"]).collect()) for n in (3, 7))
    assert once == twice and 9500 < len(once) < 10500
    assert dedup.sample_cap(df, ["id"], max_rows=100).count() == 100
    assert dedup.sample_cap(df, ["id"]).count() == 20000


def test_first_names_and_modes(spark):
    rows = [(i, "c", 1.0, 2.0, f"Name{i % 25:02d}", "K" if i % 2 else "A", "P", "C", None, "F", "G") for i in range(60)]
    rows += [(99, None, None, None, "Lost", "K", "P", "C", "O", "F", "G")]
    ddl = "o int, grid_id string, grid_lat double, grid_lon double, scientific_name string, kingdom string, phylum string, class string, `order` string, family string, genus string"
    row = community_by_cell(spark.createDataFrame(rows, ddl), "o").collect()
    assert len(row) == 1
    assert row[0].scientific_name == "|".join(f"Name{i:02d}" for i in range(20))
    assert (row[0].kingdom, row[0]["order"], row[0].genus) == ("A", None, "G")


def test_columns(spark):
    raw = spark.createDataFrame([(1.0, 2.0, "x")], "`Latitude (degree)` double, `Longitude(degree)` double, ` Unit ` string")
    assert columns.rename_observations(raw).columns == ["latitude", "longitude", "unit"]
    assert columns.rename_observations(raw, strict=True).columns == ["latitude", "longitude", " Unit "]
    assert columns.find_coordinates(raw) == ("Latitude (degree)", "Longitude(degree)")
    assert columns.find_coordinates(raw.select(" Unit ")) == (None, None)
    assert columns.project_present(raw, ["nothing"]).columns == raw.columns
    assert columns.missing_columns(raw, ["a", " Unit "]) == ["a"]
    assert columns.with_default(raw, "measurement", 1).first().measurement == 1


def test_keys_tell_null_from_text(spark):
    a, b = one(spark, surrogate_key(F.lit(None).cast("string"), F.lit("x")), surrogate_key(F.lit("x"), F.lit(None).cast("string")))
    assert a != b


def test_occurrences_without_names_are_dropped(spark):
    assert clean.clean_occurrences(spark.createDataFrame([(10.0, -100.0)], "decimalLatitude double, decimalLongitude double")).count() == 0
