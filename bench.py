"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orderstrata.functions import business_days
from orderstrata.samples.queries import QUERIES, input_files

HEADLINES = (
    "top_color_by_year",
    "avg_lead_time_by_category",
    "color_revenue_summed_by_product",
    "avg_lead_time_summed_by_product",
    "published_orders",
    "product_master",
    "uncategorised_subcategories",
    "business_day_total",
    "clean_order_headers",
    "clean_order_details",
    "kept_order_headers",
    "kept_order_details",
    "duplicate_order_details",
    "details_except_kept",
    "details_of_catalogued_products",
    "orphaned_details",
    "repeated_detail_keys",
    "bronze_order_details",
    "layers_row_counts",
    "layers_top_color_by_year",
)
RUNS = 3


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    """From building the query to its last row; the rows are made in full and thrown away."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def cached_span_seconds(spark: SparkSession, sf_dir: str) -> float:
    """The business day expression alone: summed over pairs of dates held in memory."""
    pairs = QUERIES["business_day_spans"](spark, sf_dir).select("order_date", "ship_date")
    pairs = pairs.cache()
    pairs.count()

    def once() -> float:
        start = time.perf_counter()
        pairs.agg(F.sum(business_days("order_date", "ship_date"))).collect()
        return time.perf_counter() - start

    times = [once() for _ in range(RUNS)]
    pairs.unpersist()
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderstrata-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    input_files(spark, sf_dir)  # CSV inputs are no part of what is timed
    seconds(spark, sf_dir, HEADLINES[0])  # warm the JVM
    queries = {
        name: round(statistics.median(seconds(spark, sf_dir, name) for _ in range(RUNS)), 3)
        for name in HEADLINES
    }
    queries["business_days_of_cached_pairs"] = round(cached_span_seconds(spark, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": f"headline queries, sum of medians of {RUNS} runs",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
