"""Times the headline jobs and queries; prints one JSON line.

Each is run once to warm up and then BENCH_RUNS times; the median counts. The result is
computed in full and discarded, so neither collecting nor writing rows is measured.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import date, datetime

import pyspark
from pyspark.sql import functions as F

from ledgerlake import session
from ledgerlake.catalog import QUERIES
from ledgerlake.plans import dimensions
from ledgerlake.sources import tables

HEADLINE = [
    "fact_sales",
    "fact_merge",
    "fact_second_load",
    "staging_upsert",
    "scd2_product",
    "scd2_customer",
    "scd2_1_percent",
    "scd2_50_percent",
    "rule_results",
    "update_segments",
    "sales_daily",
    "product_performance",
    "customer_summary",
    "customer_rfm",
    "category_analysis",
    "category_growth",
    "kpi_summary",
    "daily_trend",
    "sales_by_category",
    "top_products",
    "top10_products",
    "revenue_by_date_product",
    "customer_segments",
    "sales_by_region",
    "monthly_sales",
    "quality_summary",
    "quality_by_source",
    "quality_trend",
    "recent_runs",
    "rejection_analysis",
    "daily_quality_summary",
    "csv_ingest",
    "json_ingest",
]


def history_merge(share: int):
    """The customer dimension merged with a staging where `share` per cent moved."""

    def query(spark, folder):
        people = (
            tables.star_customers(spark, folder)
            .withColumn("is_current", F.lit(True))
            .withColumns({c: F.lit(None).cast("string") for c in TEXT})
            .withColumn("registration_date", F.lit(None).cast("date"))
        )
        dim = (
            people.withColumn("effective_from", F.lit(date(2000, 1, 1)))
            .withColumn("effective_to", F.lit(date(9999, 12, 31)))
            .withColumns({c: F.lit(datetime(2000, 1, 1)) for c in ("created_at", "updated_at")})
        )
        moved = F.col("customer_key") % 100 < share
        staged = people.withColumn(
            "city", F.when(moved, F.lit("Elsewhere")).otherwise(F.col("city"))
        ).drop("customer_key", "is_current")
        day, now = F.lit(date(2001, 1, 1)), F.lit(datetime(2001, 1, 1))
        return dimensions.merge_customers(dim, staged, day, now)

    return query


TEXT = ("first_name", "last_name", "phone", "state")
EXTRA = {"scd2_1_percent": history_merge(1), "scd2_50_percent": history_merge(50)}


def run(spark, name: str, folder: str) -> float:
    query = EXTRA.get(name) or QUERIES[name]
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session.build(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(spark, name, folder)
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        print(f"{name:24} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "median seconds, all headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "spark": pyspark.__version__,
                "master": f"local[{cpus}]",
                "shuffle_partitions": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
