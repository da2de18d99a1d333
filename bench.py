"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS: data folder and cores.  BENCH_QUERIES: names instead of the headline set, or
``all``.  Every query is run once to warm up and then BENCH_REPEAT times (median) into the noop sink; a
query that takes LONG seconds or more is timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oreflow.plans.catalog import catalog  # noqa: E402
from oreflow.sources.scratch import share_locally, sweep  # noqa: E402

LONG = 10.0
HEADLINE = (
    "hash_order_items validate_customers bronze_new_rows_order_items order_items_promotable quarantine_order_items "
    "silver_customers silver_products silver_orders silver_order_items silver_payments latest_customers "
    "silver_hash_lookup batch_transition pipeline_health pipeline_daily_metrics failure_summary "
    "stage_result_counts bronze_append_order_items run_commerce"
).split()


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Keeps Python from recording a call site for every expression it builds.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    share_locally(spark)
    return spark


def run(spark: SparkSession, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    queries = catalog()
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    names = list(queries) if wanted == ["all"] else wanted
    spark = session(cpus)
    seconds = {}
    for name in names:
        run(spark, queries[name], sf_dir)
        times = [run(spark, queries[name], sf_dir)]
        while len(times) < repeat and times[0] < LONG:
            times.append(run(spark, queries[name], sf_dir))
        seconds[name] = round(statistics.median(times), 3)
        sweep(spark)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over the queries, median of warm runs",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
