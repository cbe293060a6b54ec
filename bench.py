"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the local cores.  Each query runs
once to completion without collecting its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "a8_hourly_payload", "b10_keep_covered", "c3_effective_sum", "c5_prices_by_time", "c6_fill_weather",
    "c11_nearest_neighbours", "c12_neighbour_mean", "c13_alarm_hours", "d1_d4_feature_set",
    "d6_window_samples", "d8_outage_flag", "d10_decompose", "e4_growth_factor", "e5_quartiles_by_hour",
    "e7_load_shapes", "e12_entity_summary", "f10_vocabulary_codes", "g9_score_by_entity",
    "g9_score_suppliers", "g11_models_by_split", "h1_monthly_baseline", "h5_cluster_search",
    "h8_boosted_trees", "h14_rolling_seasonal", "h15_recursive_linear", "s2_predict_then_learn",
    "s3_prequential", "s4_meter_stream", "silver_build", "t3_missing_report", "t5_blocks",
    "t6_keep_last", "t7_full_grid_users", "t9_interpolate_users", "t15_local_to_utc",
)


def main() -> None:
    from gridspan import build_session, catalog

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["e2_time_profile"](spark, folder).write.format("noop").mode("overwrite").save()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
