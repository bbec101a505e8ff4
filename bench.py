"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local cores, BENCH_RUNS how often
each query runs (the best time counts). Every result is computed whole and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from querybook import QUERIES  # noqa: E402

HEADLINE = (
    "Q1_us_series",
    "Q1_us_series_one_row_per_place",
    "Q1_us_series_from_long",
    "Q1_us_series_from_long_stacked",
    "Q2_us_current",
    "Q2_us_current_one_row_per_place",
    "Q3_global_series_daily",
    "Q4_global_series_wide",
    "Q5_global_series_basic",
    "Q6_ingest_daily_reports",
    "Q7_state_rollup",
    "S1_wide_csv_scan",
    "S13_publish_on_arrival",
    "R1_unpivot_wide",
    "J1_full_align_2",
    "J1_full_align_2_stacked",
    "J2_full_align_3",
    "W4_trailing_avg_28",
    "G1_rollup_region",
    "F6_safe_ratio",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("casetrends-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
