"""Star schema, marts and metrics on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions.geo import Extent
from tidemark.operators import quality
from tidemark.plans import analytics, live, marts, metrics, warehouse

DDL = ("objectid bigint, date date, latitude double, longitude double, ocean string, marine_setting string, sampling_method string, "
       "concentration_class_range string, concentration_class_text string, unit string, microplastics_measurement double, "
       "wave_direction_dominant double, wave_period_max double, wave_height_max double, wind_wave_direction_dominant double, "
       "swell_wave_height_max double, scientific_name string, kingdom string, phylum string, class string, `order` string, "
       "family string, genus string")
D = dt.date(2021, 11, 5)
TAXON = ("Animalia", "P", "C", "O", "F", "G")


def row(i, measurement=1.0, date=D, lat=10.0, setting="Beach", wave=3.0, names="Aa b|Cc d", method="Net"):
    return (i, date, lat, -80.0, "Atlantic Ocean", setting, method, "0-10", "Low", "items/l", measurement,
            90.0, 5.0, wave, 80.0, 1.0, names, *(TAXON if names else (None,) * 6))


@pytest.fixture(scope="module")
def fused(spark):
    return spark.createDataFrame([
        row(1, 2.0), row(2, 4.0), row(2, 4.0), row(3, None, lat=20.0), row(4, 6.0, setting=" "), row(5, 8.0, date=None),
        row(6, 1.0, names=None), row(7, 9.0, wave=None, names="x"), row(8, 5.0, setting=None, method="  "),
    ], DDL)


def test_duplicate_rows_get_their_own_fact(fused):
    wh = warehouse.build_warehouse(fused)
    ids = [r.observation_id for r in wh.fact.collect()]
    assert len(ids) == len(set(ids)) == 8
    assert wh.bridge.groupBy(warehouse.FACT_FK).count().where("count > 1").count() == 0


def test_skipped_rows_still_make_members(fused):
    assert warehouse.build_warehouse(fused).dim_location.where("latitude = 20").count() == 1


def test_null_keys(fused):
    settings = [r.marine_setting for r in warehouse.build_warehouse(fused).dim_location.where("latitude = 10").collect()]
    assert sorted(settings, key=str) == ["Beach", None]
    distinct = warehouse.build_warehouse(fused, null_keys="distinct").dim_location.where("marine_setting IS NULL")
    assert distinct.count() == 2


def test_short_names_and_undated_rows_are_not_linked(fused):
    wh = warehouse.build_warehouse(fused)
    assert wh.bridge.count() == 5  # of 8 facts: one undated, one unnamed, one with a one-letter name
    assert wh.dim_species.count() == 1


def test_date_parts(fused):
    r = warehouse.build_warehouse(fused).dim_date.first()
    assert (r.year, r.month, r.day, r.quarter, r.decade) == (2021, 11, 5, 4, 2020)


def test_loads_append_and_repeat(spark, fused, tmp_path):
    path = str(tmp_path / "wh")
    first = warehouse.load_warehouse(fused, path, load_id="a")
    assert first.fact.count() == 8
    warehouse.load_warehouse(fused, path, load_id="a")
    assert warehouse.read_warehouse(spark, path).fact.count() == 8
    more = fused.unionByName(spark.createDataFrame([row(20, 3.0, lat=30.0)], DDL))
    wh = warehouse.load_warehouse(more, path, load_id="b")
    assert wh.fact.count() == 17 and wh.dim_location.count() == 4
    assert wh.dim_location.select("location_id").distinct().count() == 4
    assert wh.fact.select("observation_id").distinct().count() == 17
    assert {r.violations for r in warehouse.integrity_violations(wh).collect()} == {0}
    assert warehouse.load_warehouse(fused, path, load_id="c", append=False).fact.count() == 8


def test_a_repeated_load_keeps_what_others_use(spark, tmp_path):
    path = str(tmp_path / "wh")
    load = lambda rows, name: warehouse.load_warehouse(spark.createDataFrame(rows, DDL), path, load_id=name)
    violations = lambda wh: sum(r.violations for r in warehouse.integrity_violations(wh).collect())
    old = dt.date(1999, 3, 2)
    load([row(1, lat=10.0), row(2, lat=20.0, names="Other one"), row(3, lat=30.0, date=old)], "a")
    load([row(4, lat=20.0, names="Other one")], "b")
    wh = load([row(1, lat=10.0)], "a")
    assert violations(wh) == 0 and wh.fact.count() == 2 and wh.bridge.count() == 2
    # 20 is still used by b, 30 and the other year by none
    assert sorted(r.latitude for r in wh.dim_location.collect()) == [10.0, 20.0]
    assert wh.dim_date.count() == 1 and wh.dim_species.count() == 2
    loads = {tuple(r.loads) for r in warehouse.member_loads(spark, path, "dim_location").collect()}
    assert loads == {("a",), ("b",)}
    wh = load([row(4, None, lat=10.0)], "b")  # b lets go of the last use of 20, which a had brought
    assert [r.latitude for r in wh.dim_location.collect()] == [10.0] and wh.fact.count() == 1 and wh.bridge.count() == 1
    assert violations(wh) == 0 and wh.dim_species.count() == 1
    wh = load([row(9, None, date=None, names=None, lat=40.0)], "a")  # nothing measured is left
    assert wh.fact.count() == wh.bridge.count() == wh.dim_species.count() == 0 and violations(wh) == 0


@pytest.mark.parametrize("explode", [False, True])
def test_communities_by_reference_equal_names_in_rows(spark, fused, tmp_path, explode):
    """The same load with names in every row and with the cells' dictionary."""
    cells = spark.createDataFrame([
        ("c1", 10.0, -80.0, "Aa b|Cc d", *TAXON), ("c2", 20.0, -80.0, "Cc d|Ee f", *TAXON[:-1], "H"), ("c3", 30.0, -80.0, "x", *TAXON), ("c4", 40.0, -80.0, "Aa b|Cc d", *TAXON[:-2], "F2", "G")],
        "grid_id string, grid_lat double, grid_lon double, scientific_name string, kingdom string, phylum string, class string, `order` string, family string, genus string")
    cell = F.element_at(F.array(*[F.lit(c) for c in ("c1", "c2", "c3", "c4", "none")]), (F.col("objectid") % 5 + 1).cast("int"))
    bare = fused.drop("scientific_name", "kingdom", "phylum", "class", "order", "family", "genus").withColumn("grid_id", cell)
    named = bare.join(cells.drop("grid_lat", "grid_lon"), "grid_id", "left")
    a = warehouse.load_warehouse(named, str(tmp_path / f"a{explode}"), load_id="x", explode_species=explode)
    b = warehouse.load_warehouse(bare, str(tmp_path / f"b{explode}"), load_id="x", explode_species=explode, communities=cells)
    rows = lambda df, *drop: sorted(map(str, df.drop(*drop).collect()))
    assert rows(a.dim_species) == rows(b.dim_species) and a.dim_species.count() >= 2
    assert rows(a.communities) == rows(b.communities)
    assert rows(a.fact, "observation_id") == rows(b.fact, "observation_id")
    assert rows(a.bridge.groupBy(warehouse.SPECIES_FK, warehouse.DATE_FK).count()) == rows(b.bridge.groupBy(warehouse.SPECIES_FK, warehouse.DATE_FK).count())
    assert {r.violations for r in warehouse.integrity_violations(b).collect()} == {0}


def test_a_load_by_cells_writes_no_rows_but_facts(spark, fused, tmp_path, monkeypatch):
    """Members come from distinct values, and no table of rows with their keys is written in between."""
    cells = spark.createDataFrame([("c1", 10.0, -80.0, "Aa b", *TAXON), ("c2", 90.0, -80.0, "Cc d", *TAXON)],
        "grid_id string, grid_lat double, grid_lon double, scientific_name string, kingdom string, phylum string, class string, `order` string, family string, genus string")
    odd = spark.createDataFrame([row(30, 2.0, lat=-0.0), row(31, 2.0, lat=0.0, setting="a|b\\"), row(32, 2.0, lat=float("nan"), wave=float("nan")), row(33, None, lat=1e300, date=None)], DDL)
    cell = F.element_at(F.array(F.lit("c1"), F.lit("c2"), F.lit(None)), (F.col("objectid") % 3 + 1).cast("int"))
    bare = fused.unionByName(odd).drop("scientific_name", "kingdom", "phylum", "class", "order", "family", "genus").withColumn("grid_id", cell)
    extent = Extent(5, 83, -180, -50)  # the second cell lies outside
    keyed = warehouse.with_keys(bare, communities=cells, extent=extent)
    want = warehouse.members_of(keyed, warehouse.cell_members(cells))
    written, write = [], warehouse.materialize
    monkeypatch.setattr(warehouse, "materialize", lambda df, path: written.append(path) or write(df, path))
    wh = warehouse.load_warehouse(bare, str(tmp_path / "wh"), load_id="x", communities=cells, extent=extent)
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    for name, built in want.items():
        assert rows(getattr(wh, {warehouse.COMMUNITIES: "communities"}.get(name, name))) == rows(built), name
    assert rows(wh.fact.drop("observation_id")) == rows(warehouse.fact_rows(keyed, "x").drop("observation_id"))
    assert wh.communities.count() == 1 and {r.violations for r in warehouse.integrity_violations(wh).collect()} == {0}
    assert not [p for p in written if p.endswith("/keyed")]


def test_facts_are_looked_up_without_grouping(fused):
    """Nearly every bridge row has a fact of its own; they are not grouped, and each orphan counts."""
    wh = warehouse.build_warehouse(fused)
    broken = warehouse.Warehouse(**{**wh.__dict__, "fact": wh.fact.limit(0)})
    checks = warehouse.integrity_violations(broken)
    found = {(r.table_name, r.foreign_key): r.violations for r in checks.collect()}
    assert found[warehouse.BRIDGE, warehouse.FACT_FK] == 5
    plan = checks._jdf.queryExecution().analyzed().toString()
    assert f"Aggregate [{warehouse.FACT_FK}" not in plan and "Aggregate [observation_id" not in plan


class Session:
    """The settings of a session."""

    def __init__(self, **given):
        self.given, self.conf = {k.replace("__", "."): v for k, v in given.items()}, self

    def get(self, name, default=None):
        return self.given.get(name, default)

    def set(self, name, value):
        self.given[name] = value


def test_long_stages_stay_compiled():
    plain, own, told = Session(), Session(spark__sql__codegen__hugeMethodLimit="9000"), Session(spark__executor__extraJavaOptions=session.JIT_OPTION)
    for s in (plain, own, told):
        session.keep_methods_compiled(s)
    assert [s.get(session.METHOD_LIMIT_CONF) for s in (plain, own, told)] == [session.COMPILED_BYTES, "9000", None]


def test_members_of_null_attributes_are_stable(spark, fused, tmp_path):
    wh = warehouse.load_warehouse(fused.repartition(3), str(tmp_path / "wh"), load_id="x", null_keys="distinct")
    assert {r.violations for r in warehouse.integrity_violations(wh).collect()} == {0}
    assert wh.dim_location.where("marine_setting IS NULL").count() == 2


def test_integrity_finds_orphans(fused):
    wh = warehouse.build_warehouse(fused)
    broken = warehouse.Warehouse(**{**wh.__dict__, "dim_date": wh.dim_date.limit(0)})
    found = {(r.table_name, r.foreign_key): r.violations for r in warehouse.integrity_violations(broken).collect()}
    assert found["fact_microplastics", warehouse.DATE_FK] == 7


def test_single_species_do_not_inflate_means(spark, fused, tmp_path):
    """With one entry per species a fact has two bridge rows, but still one measurement."""
    single = warehouse.load_warehouse(fused, str(tmp_path / "single"), load_id="x", explode_species=True)
    community = warehouse.load_warehouse(fused, str(tmp_path / "community"), load_id="x")
    assert single.bridge.count() == 10
    for mart in (marts.hotspots, marts.ocean_comparison, marts.sampling_effectiveness, marts.decades, marts.wave_band_impact):
        a, b = (mart(w) for w in (single, community))
        shared = [c for c in a.columns if "especies" not in c and c not in ("biodiversidad", "num_phylums")]
        assert sorted(map(str, a.select(*shared).collect())) == sorted(map(str, b.select(*shared).collect()))
    taxa = marts.biodiversity(single).first()
    assert (taxa.num_especies, taxa.num_observaciones) == (2, 5)


def test_deviation_of_large_close_values(spark, tmp_path):
    """Sums of squares of such values would leave no digit of their spread."""
    values = [1e9 + d for d in (0.0, 0.25, 0.5, 0.75, 1.0, 3.0)]
    rows = [row(i, v, lat=10.0 + i % 3, wave=float(i % 2), names="Aa b" if i % 2 else None) for i, v in enumerate(values)]
    wh = warehouse.load_warehouse(spark.createDataFrame(rows, DDL), str(tmp_path / "wh"), load_id="x", explode_species=True)
    mean = sum(values) / len(values)
    want = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
    assert marts.ocean_comparison(wh).first().std_microplasticos == pytest.approx(want, rel=1e-6)
    assert marts.sampling_effectiveness(wh).first().std_microplasticos == pytest.approx(want, rel=1e-6)


def test_marts_without_limits_or_years(spark, fused, tmp_path):
    wh = warehouse.load_warehouse(fused, str(tmp_path / "wh"), load_id="x")
    assert marts.critical_zones(wh, limit=None).count() >= marts.critical_zones(wh, limit=1).count() == 1
    assert marts.temporal_trends(wh).count() == marts.temporal_trends(wh, 2021).count() == marts.temporal_trends(wh, None, 2021).count() == 1
    assert marts.temporal_trends(wh, 2022).count() == 0


def test_waves_beyond_decimals(spark):
    sums = spark.createDataFrame([(1e300, 1), (2.5, 2), (None, 4)], "w double, n bigint")
    assert sums.agg(marts.mean_wave("w")).first()[0] == pytest.approx(1e300 / 3)
    assert sums.where("w < 5").agg(marts.mean_wave("w")).first()[0] == 2.5


STAR_SQL = """
SELECT l.latitude, l.longitude, l.ocean, l.marine_setting, AVG(f.measurement) AS microplasticos,
       COUNT(DISTINCT s.species_id) AS biodiversidad, AVG(c.wave_height_max) AS oleaje, COUNT(DISTINCT f.observation_id) AS observaciones
FROM fact_microplastics f JOIN dim_location l ON f.dim_location_location_id = l.location_id
LEFT JOIN dim_climate c ON f.dim_climate_climate_id = c.climate_id
LEFT JOIN microplastics_species_bridge b ON f.observation_id = b.fact_microplastics_observation_id
LEFT JOIN dim_species s ON b.dim_species_species_id = s.species_id GROUP BY ALL"""


def test_sql_over_the_star_schema_agrees_with_the_mart(spark, fused, tmp_path):
    wh = warehouse.load_warehouse(fused, str(tmp_path / "sql"), load_id="x")
    wh.register_views()
    want = spark.sql(STAR_SQL)
    got = marts.hotspots(wh).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_risk_index_edges(spark):
    ddl = "year int, ocean_region string, environment_type string, total_microplastics bigint, avg_pollution double, species_count bigint, risk_raw double"
    rows = [(2000, "A", "x", 1, 1.0, 1, 5.0), (2000, "B", "x", 1, 1.0, 1, 10.0), (2001, "A", "x", 1, 1.0, 1, 7.0)]
    got = {(r.year, r.ocean_region): r.risk_index for r in metrics.with_risk_index(spark.createDataFrame(rows, ddl)).collect()}
    assert got == {(2000, "A"): 0.0, (2000, "B"): 100.0, (2001, "A"): 0.0}


def test_messages_cover_years_without_rows(spark):
    rows = spark.createDataFrame([(2000, "A", None, 1.5, 2, "u")], "year int, ocean_region string, environment_type string, avg_concentration double, total_observations bigint, unit string")
    years = spark.createDataFrame([(2000,), (2001,)], "year int")
    got = {r.year: r for r in metrics.envelopes(metrics.CONCENTRATION, rows, years, F.lit("t")).collect()}
    assert got[2000].record_count == 1 and got[2001].record_count == 0
    assert got[2001].value == '{"metric_type":"avg_concentration_by_region","year":2001,"timestamp":"t","data":[],"record_count":0}'


def test_zero_maxima_give_no_score(spark):
    spots = spark.createDataFrame([(1.0, 0), (2.0, 0)], "microplasticos double, biodiversidad bigint")
    assert {r.riesgo_score for r in analytics.zone_risk(spots).collect()} == {None}


def test_correlation_needs_rows(spark):
    ddl = ", ".join(f"{c} double" for c in analytics.CORRELATED)
    few = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0)] * 3, ddl)
    assert analytics.correlation_matrix(few).count() == 0 and analytics.correlation_matrix(few, more_than=0).count() == 25
    flat = spark.createDataFrame([(float(i), 2.0, float(-i), float(i * i), 1.0) for i in range(5)], ddl)
    r = {(x.variable_i, x.variable_j): x.r for x in analytics.correlation_matrix(flat).collect()}
    assert len(r) == 25 and r["wave_height_max", "swell_wave_height_max"] == pytest.approx(-1) and r["wave_period_max", "wave_height_max"] is None


def test_live_kpis_without_concentration(spark):
    empty = spark.createDataFrame([], "year int, avg_concentration double, total_observations bigint")
    risk = spark.createDataFrame([(2001, 4.0), (2001, 6.0)], "year int, risk_index double")
    assert tuple(live.live_kpis(empty, risk).first()) == (2001, 0, None, 5.0)
    assert live.live_kpis(empty, risk.limit(0)).count() == 0


def test_rules_pass_without_values(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a")], "x double, y string")
    got = {r.expectation: r for r in quality.check(df, [
        quality.between("x", 0, 1, 0.9), *quality.not_null(0.5, "x"), quality.unique(["y"], 0.5), quality.between("z", 0, 1, 1)], "d", "s").collect()}
    assert len(got) == 3
    assert got[quality.BETWEEN].success and got[quality.BETWEEN].success_percent == 100.0
    assert not got[quality.NOT_NULL].success and got[quality.NOT_NULL].unexpected_count == 2
    assert not got[quality.UNIQUE].success and got[quality.UNIQUE].unexpected_count == 2


def test_rules_on_an_empty_table(spark):
    df = spark.createDataFrame([], "latitude double, longitude double, objectid bigint, grid_id string")
    report = quality.check(df, quality.observation_suite(), "d", "s")
    assert report.where("NOT success").count() == 0 and report.count() > 5


def test_a_broken_dataset_does_not_hide_the_others(spark):
    good = spark.createDataFrame([(10.0, -100.0)], "latitude double, longitude double")
    wrong_type = spark.createDataFrame([([1],)], "latitude array<int>")
    report = quality.run_suites(good, wrong_type, good, 2026, "pre")
    assert {r.dataset for r in report.select("dataset").distinct().collect()} == {"microplastics", "species"}
