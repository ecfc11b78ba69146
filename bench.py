"""Time the headline queries at one scale and print one JSON line.

Each query is run to the end into a sink that keeps nothing. The warehouse is loaded
once, timed as ``stage_and_load``; the marts are timed on the loaded tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from checks.base import Given  # noqa: E402
from checks.registry import QUERIES  # noqa: E402
from tidemark.session import get_session  # noqa: E402

HEADLINES = """
snap_to_grid agg_grid_catalog join_nearest_cell agg_climate_month agg_taxonomy_cell join_asof_nearest pipe_transform
dedup_keep_last dup_rows_full dup_rows_subset head_cap sample_fraction
dim_location_build dim_species_build fact_build
agg_kpi_summary mart_critical_zones mart_temporal_trends mart_ocean_comparison mart_biodiversity mart_climate_correlation
mart_sampling mart_wave_band_impact mart_hotspots mart_decades
metric_avg_concentration metric_risk_index stream_publish
dq_suite_observations dq_suite_climate prof_numeric prof_categorical prof_histogram
stream_upsert_concentration stream_windowed_metrics agg_live_kpis
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    spark = get_session("bench", f"local[{cpus}]", spark__driver__memory="16g", spark__ui__enabled="false",
                        spark__sql__shuffle__partitions=str(2 * int(cpus)))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads

    seconds: dict[str, float] = {}
    start = time.time()
    facts = Given(spark, sf_dir).warehouse.fact.count()
    seconds["stage_and_load"] = round(time.time() - start, 3)
    for name in names:
        runs = []
        for _ in range(repeats):
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        seconds[name] = round(statistics.median(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "facts": facts,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
