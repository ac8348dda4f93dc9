"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and run in full into a sink that discards rows, once to warm up (its time is
reported as cold) and then ``BENCH_RUNS`` times, of which the median counts. Times include planning.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from deskwise.registry import QUERIES
from deskwise.session import build_session

HEADLINE = [
    "fct_requests",
    "fct_daily",
    "agency_performance",
    "heat_season",
    "dim_agency",
    "orders_daily",
    "raw_upsert",
    "incremental_merge",
    "incremental_merge_table",
    "scd2_history",
    "scd2_point_in_time",
    "dq_row_checks",
    "dq_relationships",
    "dq_summary",
    "extract_audit",
    "stream_upsert",
    "stream_daily_demand",
]


def run(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "deskwise-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in names.split(",") if names else HEADLINE:
        cold[name] = round(run(QUERIES[name], spark, sf_dir), 3)
        times = [run(QUERIES[name], spark, sf_dir) for _ in range(runs)]
        warm[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
