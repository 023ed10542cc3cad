"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` choose data and cores.  A
query's plan is built and collected once, then run to the ``noop`` sink; the
median counts.  For queries that write tables the building is where the work
is done, so there it is timed as well.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelake.queries import REGISTRY  # noqa: E402

PLAIN = (
    "gold_total_orders",
    "gold_top5_orders_value",
    "gold_top5_orders_of_many_customers",
    "gold_top5_products_sold",
    "gold_low_stock_products",
    "silver_latest_by_key",
    "silver_latest_one",
    "silver_latest_event_by_user",
    "bronze_orders_by_date",
    "stabilize_types_wide",
    "mask_column",
    "text_line_suffix",
    "strip_tags",
    "is_night",
)
WRITING = (
    "bronze_load_orders",
    "silver_full_load",
    "silver_overwrite",
    "silver_incremental_append",
    "silver_stream_append",
    "kpi_report",
    "silver_refresh",
    "silver_refresh_bucketed",
    "silver_stream_corrections",
    "gold_total_orders_incremental",
    "gold_top5_products_incremental",
    "gold_top5_orders_as_of",
    "bronze_rejects",
    "bronze_compacted",
    "bronze_backfill",
    "silver_stream_replace",
    "medallion_end_to_end",
)
#: These write thousands of day folders; they are run once, after a first time.
SLOW = ("bronze_backfill", "medallion_end_to_end")
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidelake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(result: Callable[[], DataFrame]) -> float:
        started = time.perf_counter()
        result().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names or PLAIN + WRITING:
        build = partial(REGISTRY[name], spark, sf_dir)
        built = build()
        built.collect()
        repeats = 1 if name in SLOW else REPEATS
        result = build if name in WRITING else lambda: built
        seconds[name] = round(statistics.median(timed(result) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
