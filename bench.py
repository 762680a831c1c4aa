"""Times the headline queries and prints one JSON line.

Each query runs to completion into Spark's noop sink: one warm-up, then the median of three runs, everything the query
does on the way (reads, stored intermediate tables, joins) included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from starmart.registry.queries import all_queries
from starmart.session import get_or_create_spark_session

HEADLINE = [
    "stg_orders",
    "stg_order_items",
    "agg_order_items",
    "join_inner_items_orders",
    "join_role_playing_dates",
    "date_key_arith",
    "stg_product",
    "dim_customer_after_2_batches",
    "dim_seller_after_2_batches",
    "dim_product_after_2_batches",
    "pit_join_product",
    "fact_order_items",
    "fact_order_summary",
    "daily_run_counts",
]
RUNS = 3


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_or_create_spark_session(
        "starmart-bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in names:
        timed(queries[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(queries[name], spark, sf_dir) for _ in range(RUNS)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
