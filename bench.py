"""Time the headline queries and print one JSON line.

Every query is run three times to its last row into Spark's no-op sink, and the median counts;
a small query is run before, untimed, to load classes. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and threads.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from faremill.registry import registered
from faremill.session import build_session

HEADLINE = [
    "scan_parquet_count",
    "count_distinct_zone",
    "staging_clean",
    "base_code",
    "union_services",
    "monthly_zone_revenue_id",
    "monthly_zone_revenue",
    "hourly_revenue_outer",
    "revenue_with_zone",
    "daily_service_report",
    "fct_enriched",
    "dedup_earliest",
    "dedup_latest",
    "either_side_join",
    "player_summary",
    "running_total",
    "merge_upsert",
    "merge_partitioned",
    "interval_replace",
    "dq_sanity_report",
    "dq_relationships",
    "stream_passthrough",
    "stream_tumbling",
    "stream_resume",
    "ingest_months",
    "interval_refresh",
    "green_fact_build",
    "layered_build",
    "dq_fact_checks",
    "merge_bucketed",
    "monthly_zone_revenue_parts",
    "stream_late_rows",
    "dq_unique_growing",
    "nested_lists",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else None,
        extra={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    queries["scan_parquet_count"].run(spark, sf_dir).collect()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
