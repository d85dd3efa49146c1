"""Headline queries over the tables in $BENCH_SF_DIR; prints one line of JSON.

Each query runs once to warm up and then three times; its number is the median. All rows of the result
are computed and written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from tidegate.catalog import QUERIES
from tidegate.session import build_session

HEADLINES = ("payment_analysis", "price_demand_analysis", "customer_behavior", "product_performance", "scd2_history",
             "customer_behavior_batch", "product_performance_batch", "scd1_customers", "temporal_join_fallback",
             "clean_orders", "dedup_full_row", "append_only_commits", "tumbling_window_agg")
RUNS = 3


def seconds(spark, run, sf_dir) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.log.level": "ERROR"})
    times = {}
    for name in names:
        seconds(spark, QUERIES[name], sf_dir)
        times[name] = round(statistics.median(seconds(spark, QUERIES[name], sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
