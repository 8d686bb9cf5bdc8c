"""The twelve dashboard views and the dashboard queries on them.

The fact's `sale_key` is unique, and no join here repeats a fact row, so a distinct count
of sales is a plain count. Facts are totalled per product or customer before a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.measures import percentage, profit, ratio
from ledgerlake.operators.ranking import rank_all
from ledgerlake.plans.marts import AMOUNT, cents

AVERAGE = "decimal(22,6)"


def _totals(facts: DataFrame, *group: str) -> DataFrame:
    return facts.groupBy(*group).agg(
        F.count("sale_key").alias("orders"),
        F.sum("quantity").alias("units_sold"),
        F.sum("total_amount").cast(AMOUNT).alias("revenue"),
        profit(F.col("total_amount"), F.col("cost_amount")).cast(AMOUNT).alias("profit"),
    )


def _again(name: str, kind: str = AMOUNT) -> Column:
    return F.sum(name).cast(kind).alias(name)


def ignoring_case(products: DataFrame) -> DataFrame:
    """Products whose categories group together whatever their case, as in a database with
    a case-insensitive collation. Without it spellings stay apart.
    """
    return products.withColumn("category", F.collate("category", "UTF8_LCASE"))


# ------------------------------------------------------------------ sales views


def sales_kpi_summary(facts: DataFrame) -> DataFrame:
    """One row. Facts are grouped by customer and product first, so that what the distinct
    counts copy is pairs and not sales.
    """
    pairs = facts.groupBy("customer_key", "product_key").agg(
        F.count("sale_key").alias("_orders"),
        F.sum("quantity").alias("_units"),
        F.sum("total_amount").cast(AMOUNT).alias("_total"),
        F.count("total_amount").alias("_lines"),
        F.sum("cost_amount").cast(AMOUNT).alias("_cost"),
    )
    total, cost = F.sum("_total").cast(AMOUNT), F.coalesce(F.sum("_cost"), F.lit(0))
    return pairs.agg(
        F.coalesce(F.sum("_orders"), F.lit(0)).alias("total_orders"),
        F.sum("_units").alias("total_units_sold"),
        total.alias("total_revenue"),
        (F.sum("_total") - cost).cast(AMOUNT).alias("total_profit"),
        ratio(total, F.sum("_lines"), AVERAGE).alias("avg_order_value"),
        F.countDistinct("customer_key").alias("unique_customers"),
        F.countDistinct("product_key").alias("unique_products"),
    )


def daily_sales_trend(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    days = _totals(facts, "date_key").join(calendar, "date_key")
    return days.select(
        "full_date",
        "day_name",
        "month_name",
        "year",
        "orders",
        "units_sold",
        "revenue",
        "profit",
    )


def sales_by_category(facts: DataFrame, products: DataFrame) -> DataFrame:
    current = products.filter("is_current").select("product_key", "category")
    return (
        _totals(facts, "product_key")
        .join(current, "product_key")
        .groupBy("category")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("units_sold").alias("units_sold"),
            _again("revenue"),
            _again("profit"),
        )
        .withColumn("avg_order_value", ratio(F.col("revenue"), F.col("orders"), AVERAGE))
    )


def _products_sold(facts: DataFrame, products: DataFrame) -> DataFrame:
    group = ["product_id", "product_name", "category", "price"]
    current = products.filter("is_current").select(
        "product_key", "product_id", F.col("title").alias("product_name"), "category", "price"
    )
    return (
        _totals(facts, "product_key")
        .join(current, "product_key")
        .groupBy(*group)
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("units_sold").alias("units_sold"),
            _again("revenue"),
        )
    )


def top_products(facts: DataFrame, products: DataFrame) -> DataFrame:
    sold = _products_sold(facts, products)
    return rank_all(sold, {"revenue_rank": cents(F.col("revenue"))})


def _per_customer(facts: DataFrame, customers: DataFrame, *attributes: str) -> DataFrame:
    """Every current customer, with or without sales."""
    totals = facts.groupBy("customer_key").agg(
        F.count("sale_key").alias("orders"), F.sum("total_amount").cast(AMOUNT).alias("revenue")
    )
    current = customers.filter("is_current").select("customer_key", *attributes)
    return current.join(totals, "customer_key", "left")


def customer_segments(facts: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        _per_customer(facts, customers, "customer_segment")
        .groupBy("customer_segment")
        .agg(
            F.count("customer_key").alias("customer_count"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
            F.sum("revenue").cast(AMOUNT).alias("total_revenue"),
        )
        .withColumn(
            "avg_order_value", ratio(F.col("total_revenue"), F.col("total_orders"), AVERAGE)
        )
    )


def sales_by_region(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Unknown places are named after grouping, so NULL and 'Unknown' stay two rows."""
    return (
        _per_customer(facts, customers, "region", "country")
        .groupBy("region", "country")
        .agg(
            F.count("customer_key").alias("customers"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
            _again("revenue"),
        )
        .withColumn("region", F.coalesce("region", F.lit("Unknown")))
        .withColumn("country", F.coalesce("country", F.lit("Unknown")))
    )


def monthly_sales(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales per month beside the month before that has any. The window sees months only."""
    months = (
        _totals(facts, "date_key")
        .join(calendar.select("date_key", "year", "month_num", "month_name"), "date_key")
        .groupBy("year", "month_num", "month_name")
        .agg(F.sum("orders").alias("orders"), _again("revenue"), _again("profit"))
    )
    before = F.lag("revenue").over(Window.orderBy("year", "month_num"))
    return months.withColumn("prev_month_revenue", before)


# ---------------------------------------------------------------- quality views


def quality_summary(log: DataFrame) -> DataFrame:
    received, stored = F.sum("records_received"), F.sum("records_stored")
    return log.agg(
        F.count(F.lit(1)).alias("total_pipeline_runs"),
        received.alias("total_records_received"),
        stored.alias("total_records_stored"),
        F.sum("records_rejected").alias("total_records_rejected"),
        percentage(stored, received).alias("overall_quality_score"),
        F.count_if(F.col("status") == "success").alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
    )


def _score() -> Column:
    total = F.sum("quality_score").cast(AMOUNT)
    return ratio(total, F.count("quality_score"), AVERAGE).alias("avg_quality_score")


def quality_by_source(log: DataFrame) -> DataFrame:
    return log.groupBy("source_name", "source_type").agg(
        F.count(F.lit(1)).alias("run_count"),
        F.sum("records_received").alias("total_received"),
        F.sum("records_stored").alias("total_stored"),
        F.sum("records_rejected").alias("total_rejected"),
        _score(),
        F.max("created_at").alias("last_run"),
    )


def quality_trend(log: DataFrame) -> DataFrame:
    return log.groupBy(F.to_date("created_at").alias("run_date")).agg(
        F.count(F.lit(1)).alias("pipeline_runs"),
        F.sum("records_received").alias("records_received"),
        F.sum("records_stored").alias("records_stored"),
        F.sum("records_rejected").alias("records_rejected"),
        _score(),
    )


RUN_COLUMNS = [
    "batch_id",
    "pipeline_name",
    "source_name",
    "source_type",
    "records_received",
    "records_stored",
    "records_rejected",
    "quality_score",
    "status",
    "duration_seconds",
    "created_at",
]


def recent_runs(log: DataFrame, limit: int = 100) -> DataFrame:
    """The latest runs; equal times are settled by batch and source."""
    newest = log.orderBy(F.desc("created_at"), "batch_id", "source_name")
    return newest.limit(limit).select(*RUN_COLUMNS)


def rejection_analysis(details: DataFrame) -> DataFrame:
    return details.groupBy("source_name", "rejection_reason").agg(
        F.sum("rejection_count").alias("total_rejections"),
        F.countDistinct("batch_id").alias("affected_batches"),
    )


# ----------------------------------------------------------- dashboard queries


def kpi_cards(facts: DataFrame) -> DataFrame:
    return sales_kpi_summary(facts).select(
        "total_revenue", "total_orders", "unique_customers", "avg_order_value"
    )


def daily_series(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    return daily_sales_trend(facts, calendar).select("full_date", "revenue", "profit").orderBy(
        "full_date"
    )


def category_shares(facts: DataFrame, products: DataFrame) -> DataFrame:
    return sales_by_category(facts, products).select("category", "revenue")


def best_products(facts: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Top products by revenue; equal revenue is settled by the id. Whatever outranks one of
    them is among them, so their ranks follow from those few rows.
    """
    best = _products_sold(facts, products).orderBy(F.desc("revenue"), "product_id").limit(limit)
    rank = F.rank().over(Window.orderBy(F.desc("revenue"))).cast("long")
    return best.withColumn("revenue_rank", rank).select(
        "product_name", "category", "units_sold", "revenue", "revenue_rank"
    )


def segment_counts(facts: DataFrame, customers: DataFrame) -> DataFrame:
    return customer_segments(facts, customers).select("customer_segment", "customer_count")


def month_by_year(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Revenue and profit per month name, one pair of columns per year of the calendar."""
    # One row per year.
    years = [row[0] for row in calendar.select("year").distinct().orderBy("year").collect()]
    return (
        monthly_sales(facts, calendar)
        .groupBy("month_num", "month_name")
        .pivot("year", years)
        .agg(_again("revenue"), _again("profit"))
    )


def quality_cards(log: DataFrame) -> DataFrame:
    return quality_summary(log).select(
        "overall_quality_score",
        "total_records_received",
        "total_records_stored",
        "total_records_rejected",
    )


def quality_series(log: DataFrame) -> DataFrame:
    return quality_trend(log).select("run_date", "avg_quality_score").orderBy("run_date")


def source_volumes(log: DataFrame) -> DataFrame:
    return quality_by_source(log).select(
        "source_name", "total_received", "total_stored", "total_rejected"
    )


def run_table(log: DataFrame, limit: int = 20) -> DataFrame:
    return recent_runs(log, limit).select(
        "pipeline_name",
        "source_name",
        "records_received",
        "records_stored",
        "quality_score",
        "status",
        "created_at",
    )


def status_counts(log: DataFrame) -> DataFrame:
    """Success and Failed with their counts, as two rows."""
    return quality_summary(log).selectExpr(
        "stack(2, 'Success', successful_runs, 'Failed', failed_runs) AS (status, count)"
    )


def revenue_by_date_product(
    facts: DataFrame, calendar: DataFrame, products: DataFrame
) -> DataFrame:
    """Revenue per day and product title, over every version of a product."""
    return (
        facts.groupBy("date_key", "product_key")
        .agg(F.sum("total_amount").alias("revenue"))
        .join(calendar.select("date_key", "full_date"), "date_key")
        .join(products.select("product_key", "title"), "product_key")
        .groupBy("full_date", "title")
        .agg(_again("revenue"))
    )


def register(tables: dict[str, DataFrame]) -> None:
    """Make the twelve views available to SQL under their usual names."""
    facts, calendar = tables["dw.fact_sales"], tables["dw.dim_date"]
    products, customers = tables["dw.dim_product"], tables["dw.dim_customer"]
    log, details = tables["quality.ingestion_log"], tables["quality.rejection_details"]
    views = {
        "vw_sales_kpi_summary": sales_kpi_summary(facts),
        "vw_daily_sales_trend": daily_sales_trend(facts, calendar),
        "vw_sales_by_category": sales_by_category(facts, products),
        "vw_top_products": top_products(facts, products),
        "vw_customer_segments": customer_segments(facts, customers),
        "vw_sales_by_region": sales_by_region(facts, customers),
        "vw_monthly_sales": monthly_sales(facts, calendar),
        "vw_quality_summary": quality_summary(log),
        "vw_quality_by_source": quality_by_source(log),
        "vw_quality_trend": quality_trend(log),
        "vw_recent_runs": recent_runs(log),
        "vw_rejection_analysis": rejection_analysis(details),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
