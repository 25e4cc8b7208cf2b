"""Time the queries: one JSON line with seconds per query.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose tables and threads, ``BENCH_RUNS`` the timed runs.
Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. Batch results
go to a sink that discards them; stream queries are timed until all input is handled.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES
from tradewake import build_session

HEADLINE = [
    "bounces", "unique_visits", "repair_is_new", "split_logs_page", "split_logs_display",
    "visitor_stats", "route_cdc_facts", "upsert_dim", "order_wide", "order_wide_dims",
    "payment_wide", "search_keywords", "sql_keywords", "tokenize_documents", "product_stats",
    "product_keywords", "stream_bounces", "stream_order_wide", "stream_repair_is_new",
    "stream_visitor_stats", "stream_unique_visits", "job_business_dims", "job_user_log",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in names:
        seconds(spark, name, sf_dir)
        times = [seconds(spark, name, sf_dir) for _ in range(1 if "stream" in name else runs)]
        took[name] = round(statistics.median(times), 3)
        print(name, took[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
