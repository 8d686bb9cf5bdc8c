"""The four marts, rebuilt from the star schema.

Facts are aggregated on their own keys before they meet a dimension. A product or customer
with a third of all sales is then combined in the map tasks and is one row in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.measures import profit, ratio
from ledgerlake.operators.ranking import rank_all
from ledgerlake.session import store_once

AMOUNT = "decimal(22,2)"


def cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def _sums() -> list[Column]:
    return [
        F.sum("quantity").alias("_quantity"),
        F.sum("total_amount").cast(AMOUNT).alias("_total"),
        profit(F.col("total_amount"), F.col("cost_amount")).cast(AMOUNT).alias("_profit"),
        F.count(F.lit(1)).alias("_lines"),
    ]


def _again(*more: str) -> list[Column]:
    """The sums of `_sums` taken together."""
    kinds = {"_quantity": "bigint", "_total": AMOUNT, "_profit": AMOUNT, "_lines": "bigint"}
    kinds.update({name: AMOUNT for name in more})
    return [F.sum(name).cast(kind).alias(name) for name, kind in kinds.items()]


def _distinct(rows: DataFrame, group: list[str], column: str, name: str) -> DataFrame:
    """Exact distinct count per group.

    Kept apart from the sums: Spark counts several distinct values by copying every row for
    each of them. `rows` is grouped already and stored.
    """
    pairs = rows.select(*group, column).distinct()
    return pairs.groupBy(*group).agg(F.count(column).alias(name))


def sales_daily(facts: DataFrame, calendar: DataFrame, folder: str | None = None) -> DataFrame:
    day = ["date_key"]
    sold = facts.groupBy(*day, "sale_id", "customer_key", "product_key").agg(
        *_sums(), F.sum("cost_amount").cast(AMOUNT).alias("_cost")
    )
    # Read by several sums and counts, so that the facts themselves are read once.
    sold = store_once(sold, "sold", folder)
    days = sold.groupBy(*day).agg(*_again("_cost"))
    for column, name in {
        "sale_id": "_orders", "customer_key": "_customers", "product_key": "_products",
    }.items():
        days = days.join(_distinct(sold, day, column, name), day)
    return days.join(calendar, "date_key").select(
        "date_key",
        "full_date",
        "year",
        "month_num",
        "month_name",
        "day_name",
        "is_weekend",
        F.col("_orders").alias("total_orders"),
        F.col("_quantity").alias("total_quantity"),
        F.col("_total").alias("total_revenue"),
        F.col("_cost").alias("total_cost"),
        F.col("_profit").alias("total_profit"),
        ratio(F.col("_total"), F.col("_lines"), AMOUNT).alias("avg_order_value"),
        F.col("_customers").alias("unique_customers"),
        F.col("_products").alias("unique_products"),
    )


def _lifetime(facts: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """Totals per product or customer with the first and last day of sale.

    Grouping by key and sale first makes the number of orders a plain count, in one pass.
    """
    dated = facts.join(calendar.select("date_key", "full_date"), "date_key")
    orders = dated.groupBy(key, "sale_id").agg(
        *_sums(), F.min("full_date").alias("_first"), F.max("full_date").alias("_last")
    )
    return orders.groupBy(key).agg(
        *_again(),
        F.count("sale_id").alias("_orders"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )


def product_performance(
    facts: DataFrame, products: DataFrame, calendar: DataFrame, as_of: Column
) -> DataFrame:
    totals = _lifetime(facts, calendar, "product_key")
    current = products.filter("is_current").select(
        "product_key", "product_id", "title", "category", "price"
    )
    performance = current.join(totals, "product_key").select(
        "product_key",
        "product_id",
        "title",
        "category",
        "price",
        F.col("_orders").alias("total_orders"),
        F.col("_quantity").alias("total_quantity_sold"),
        F.col("_total").alias("total_revenue"),
        F.col("_profit").alias("total_profit"),
        ratio(F.col("_quantity").cast("decimal(20,2)"), F.col("_lines"), AMOUNT).alias(
            "avg_quantity_per_order"
        ),
        F.col("_first").alias("first_sale_date"),
        F.col("_last").alias("last_sale_date"),
        F.datediff(as_of, "_last").alias("days_since_last_sale"),
    )
    return rank_all(
        performance,
        {
            "revenue_rank": cents(F.col("total_revenue")),
            "quantity_rank": F.col("total_quantity_sold"),
        },
    )


def customer_summary(
    facts: DataFrame, customers: DataFrame, calendar: DataFrame, as_of: Column
) -> DataFrame:
    totals = _lifetime(facts, calendar, "customer_key")
    current = customers.filter("is_current").select(
        "customer_key", "customer_id", "full_name", "email", "city", "country", "customer_segment"
    )
    return current.join(totals, "customer_key").select(
        "customer_key",
        "customer_id",
        "full_name",
        "email",
        "city",
        "country",
        F.col("_orders").alias("total_orders"),
        F.col("_quantity").alias("total_quantity"),
        F.col("_total").alias("total_spent"),
        ratio(F.col("_total"), F.col("_lines"), AMOUNT).alias("avg_order_value"),
        F.col("_first").alias("first_purchase_date"),
        F.col("_last").alias("last_purchase_date"),
        F.datediff(as_of, "_last").alias("days_since_last_purchase"),
        F.datediff(as_of, "_first").alias("customer_tenure_days"),
        "customer_segment",
        F.lit(None).cast("string").alias("rfm_score"),
    )


def category_analysis(
    facts: DataFrame, products: DataFrame, calendar: DataFrame, folder: str | None = None
) -> DataFrame:
    """Sales per category and month. Unlike a NOT NULL column, NULL categories are kept."""
    group = ["category", "year", "month_num"]
    current = products.filter("is_current").select("product_key", "category", "price")
    months = calendar.select("date_key", "year", "month_num")
    # Stored facts have a year of their own, which names their folder.
    sold = (
        facts.drop("year", "month")
        .join(months, "date_key")
        .groupBy("product_key", "year", "month_num", "sale_id", "customer_key")
        .agg(*_sums())
        .join(current, "product_key")
    )
    # Read by several sums and counts, so that the facts themselves are read once.
    sold = store_once(sold, "sold", folder)
    sums = sold.groupBy(*group, "product_key", "price").agg(*_again())
    sums = sums.groupBy(*group).agg(
        *_again(),
        F.sum(F.col("price") * F.col("_lines")).cast(AMOUNT).alias("_prices"),
        F.countDistinct("product_key").alias("_products"),
    )
    totals = sums
    for column, name in {"sale_id": "_orders", "customer_key": "_customers"}.items():
        counts = _distinct(sold, group, column, name).select(
            *[F.col(c).alias(f"_{c}") for c in group], name
        )
        same = [totals[c].eqNullSafe(counts[f"_{c}"]) for c in group]
        totals = totals.join(counts, same).drop(*[f"_{c}" for c in group])
    unknown = F.lit(None).cast(AMOUNT)
    return totals.select(
        *group,
        F.col("_products").alias("product_count"),
        F.col("_orders").alias("total_orders"),
        F.col("_quantity").alias("total_quantity"),
        F.col("_total").alias("total_revenue"),
        F.col("_profit").alias("total_profit"),
        ratio(F.col("_prices"), F.col("_lines"), AMOUNT).alias("avg_product_price"),
        F.col("_customers").alias("unique_customers"),
        unknown.alias("revenue_mom_change"),
        unknown.alias("revenue_yoy_change"),
    )


def with_growth(categories: DataFrame) -> DataFrame:
    """Fill the growth columns the mart declares but leaves empty: change in per cent
    against the calendar month before and the same month of the year before.
    """
    month = F.col("year") * 12 + F.col("month_num")
    numbered = categories.withColumn("_month", month)
    result = numbered
    for name, distance in {"revenue_mom_change": 1, "revenue_yoy_change": 12}.items():
        earlier = numbered.select(
            F.col("category").alias("_category"),
            (F.col("_month") + distance).alias("_then"),
            F.col("total_revenue").alias("_base"),
        )
        same = F.col("category").eqNullSafe(F.col("_category")) & (
            F.col("_month") == F.col("_then")
        )
        gain = (F.col("total_revenue") - F.col("_base")) * 100
        change = F.try_divide(gain, F.col("_base")).try_cast(AMOUNT)
        result = (
            result.join(earlier, same, "left")
            .withColumn(name, change)
            .drop("_category", "_then", "_base")
        )
    return result.select(*categories.columns)


def with_rfm(customers: DataFrame) -> DataFrame:
    """Fill the score the mart declares but leaves empty: quintiles of recency, frequency
    and spend, 5 best, by rank, so equal customers score the same.
    """
    size = customers.agg(F.count(F.lit(1))).scalar()
    scored = rank_all(
        customers,
        {
            "_recency": -F.col("days_since_last_purchase").cast("bigint"),
            "_frequency": F.col("total_orders"),
            "_spend": cents(F.col("total_spent")),
        },
    )
    digits = [
        (5 - F.floor((F.col(r) - 1) * 5 / size)).cast("string")
        for r in ("_recency", "_frequency", "_spend")
    ]
    return scored.withColumn("rfm_score", F.concat(*digits)).select(*customers.columns)
