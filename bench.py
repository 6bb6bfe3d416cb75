"""Time the headline queries; prints one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times; the fastest run counts. A run
includes building the plan and computing every column of every row (a no-op sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from fleetgauge.plans.catalog import CATALOG
from fleetgauge.session import build_session

HEADLINE = (
    "realtime_stop_time_updates",
    "scheduled_stop_times_normalized",
    "stop_time_schedule_vs_actual",
    "trip_schedule_vs_actual",
    "quality_duplicate_vehicle_entities",
    "quality_realtime_trip_referential_integrity",
    "quality_snapshot_freshness",
    "fct_feed_quality",
    "fct_route_realtime_activity",
    "fct_on_time_performance",
    "fct_headway",
    "fct_anomaly_findings",
    "synthetic_anomaly_evaluation",
    "anomaly_detection_metrics",
    "assert_match_rate",
    "top_findings",
    "top_routes",
    "top_delayed_routes",
    "top_variable_routes",
)


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    CATALOG[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.log.level": "ERROR",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(min(seconds(spark, name, folder) for _ in range(runs)), 4)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds_total",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
