"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8). Each
query runs once to warm up and then BENCH_RUNS times (default 3); the median is reported. A result is
consumed in full by a sink that writes nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from medley import session
from medley.plans import REGISTRY

HEADLINE = [
    "nation_revenue", "filter_project", "join_three", "group_agg_set", "asof_last_event", "rate_interval_join",
    "running_max", "dup_rows", "dup_keys", "latest_per_key", "dense_rank_month", "mdm_enrich_unmatched",
    "describe_values", "dq_tag", "dq_log", "merge_upsert", "delete_vanished", "count_reconcile", "value_drift",
    "section_rows", "allocation_areas", "sales_rows", "html_title_meta", "page_links", "pii_hash", "json_props",
    "event_partition_counts", "forecast_rows", "backtest_orders",
]


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session.build(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, path).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            session.clear(spark)
        times[name] = round(statistics.median(taken[1:]), 3)
    total = round(sum(times.values()), 3)
    sf = path.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline queries, sum of medians", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
