"""Physical plans: what must and must not be in them."""

import pytest
from pyspark.sql import functions as F

from checks.base import Given
from checks.registry import QUERIES
from tidemark.functions.geo import NORTH_AMERICA
from tidemark.operators import asof, clean, dedup, skew
from tidemark.operators.grid import assign_to_nearest_cell
from tidemark.plans import marts, warehouse


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return Given(spark, sf_dir)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_cell_does_not_shuffle_the_target(given):
    plan = plan_of(assign_to_nearest_cell(clean.clean_climate(given.climate), given.catalog, extent=NORTH_AMERICA))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the candidate table


def test_unbounded_nearest_cell_is_not_broadcast_by_hint(spark, given):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(assign_to_nearest_cell(clean.clean_climate(given.climate), given.catalog))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "_salt" in plan


def test_observations_reach_the_fused_table_without_a_shuffle(given):
    plan = plan_of(given.transformed.fused)
    assert plan.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in plan


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k.startswith(("mart_", "join_", "agg_", "dedup_", "dim_", "metric_", "topk_", "prof_", "dq_"))))
def test_no_cross_join_and_no_python(spark, sf_dir, key):
    plan = plan_of(QUERIES[key](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan, word


def test_ranked_marts_take_the_top(given):
    for mart in (marts.critical_zones, marts.biodiversity):
        assert "TakeOrderedAndProject" in plan_of(mart(given.warehouse))


def test_years_prune_fact_partitions(given):
    assert "PartitionFilters: [isnotnull(obs_year" in plan_of(marts.temporal_trends(given.warehouse, 1996, 1997))


def test_region_filter_and_columns_reach_the_scan(spark, tmp_path, given):
    given.climate.write.parquet(str(tmp_path / "c"))
    df = clean.filter_region(spark.read.parquet(str(tmp_path / "c"))).select("reading_id")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(latitude,5.0)" in plan and "ReadSchema: struct<reading_id:bigint,latitude:double,longitude:double>" in plan


def test_keep_last_needs_no_window(given):
    assert "Window" not in plan_of(dedup.keep_last(given.climate, ["date"], ["reading_id"]))


def test_species_are_not_grouped_by_names_at_fact_grain(given):
    """Facts carry the id of a community; only cells are joined to names."""
    plan = plan_of(warehouse.dim_species(given.keyed, warehouse.cell_members(given.communities)))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("microplastics_measurement" in line and "scientific_name" not in line for line in scans)
    assert not any("microplastics_measurement" in line and "scientific_name" in line for line in scans)


def scans_of(df):
    """How often each file source is read by the plan that ran, exchanges that are used twice counted once."""
    df.write.format("noop").mode("overwrite").save()
    return [line for line in plan_of(df).splitlines() if "FileScan" in line]


def test_counts_are_written_once_and_the_left_read_once(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    duplicates = scans_of(dedup.duplicate_rows(lines, ["l_returnflag", "l_quantity"]))
    assert sum("l_extendedprice" in line for line in duplicates) == 1  # the counts come from their own table
    assert sum("lineitem" in line for line in duplicates) == 1
    readings = lines.select(F.col("l_suppkey").alias("cell"), F.col("l_shipdate").cast("date").alias("day"), "l_tax").dropDuplicates(["cell", "day"])
    left = lines.select(F.col("l_suppkey").alias("cell"), F.col("l_shipdate").cast("date").alias("day"), "l_extendedprice")
    nearest = scans_of(asof.nearest_date_join(left, readings, "cell", "day", ["l_tax"]))
    assert sum("lineitem" in line for line in nearest) == 1


def test_skewed_lookups_agree_with_plain_joins(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, F.lit(7)).when(F.col("id") % 50 == 0, F.lit(None)).otherwise((F.col("id") % 90).cast("int")).alias("k"), (F.col("id") % 2).alias("kind"))
    counted = rows.groupBy("k", "kind").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    found = skew.lookup_counted(rows, counted, ["k", "kind"], "n")
    assert found.columns == ["id", "k", "kind", "top"] and found.count() == 20_000
    tops = {(r.k, r.kind): r.top for r in counted.collect()}
    assert all(r.top == tops[r.k, r.kind] for r in found.collect())
    kept = skew.semi_join_counted(rows, counted.where("n > 200"), ["k", "kind"], "n")
    assert kept.columns == rows.columns and kept.count() == counted.where("n > 200").agg(F.sum("n")).first()[0]
