"""The given benchmark tables seen as a sales warehouse.

`star_*` present them as a loaded star schema, `raw_*` as received text with the faults
that real files have. Every row of a table is used; the faults are placed by fixed rules on
the keys, so that results can be checked against SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.calendar import calendar_of, date_key
from ledgerlake.plans.quality import with_run_measures

# The first day that made-up registrations and loads count from.
FIRST_SHIP_DAY = date(1995, 1, 1)
# Today, for reports; and for loads, so that later ship dates are in the future.
REPORT_DAY = date(2002, 1, 1)
LOAD_DAY = date(2001, 6, 30)

# Nation number k stands for the k-th country, and the state of a home customer.
COUNTRIES = [
    "USA", "US", "united states", "Canada", "Mexico", "UK", "Germany", "France", "Italy",
    "Spain", "Netherlands", "China", "Japan", "Australia", "India", "Singapore", "Brazil",
    "Argentina", "Chile", "Colombia", "Norway", "Kenya", "", "United Kingdom", "usa",
]
STATES = ["NY", "fl", "IL", "TX", "CA", "KY", "", "Hi"]


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def money(c: Column, kind: str = "decimal(12,2)") -> Column:
    return c.cast(kind)


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


# --------------------------------------------------------------- star schema


def star_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Every day from the first to the last sale."""
    return calendar_of(load(spark, folder, "lineitem"), F.to_date("l_shipdate"))


def product_cost() -> Column:
    """60 % of the price; unknown for one size in ten."""
    price = money(F.col("p_retailprice"), "decimal(10,2)")
    return F.when(
        F.col("p_size") % 10 != 0,
        (price * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(10,2)"),
    )


def star_products(spark: SparkSession, folder: str) -> DataFrame:
    """One version per part; sizes divisible by 7 are closed versions."""
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("product_key"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit("-csv")).alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        money(F.col("p_retailprice"), "decimal(10,2)").alias("price"),
        product_cost().alias("cost"),
        F.col("p_size").alias("stock_quantity"),
        F.col("p_brand").alias("supplier"),
        (F.col("p_size") % 7 != 0).alias("is_current"),
    )


def star_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their nation and region; some places unknown, some versions closed."""
    nation, area = load(spark, folder, "nation"), load(spark, folder, "region")
    place = nation.join(area, nation.n_regionkey == area.r_regionkey)
    people = load(spark, folder, "customer").join(
        place, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return people.select(
        F.col("c_custkey").alias("customer_key"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string"), F.lit("-csv")).alias(
            "customer_id"
        ),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower(F.translate("c_name", "#", "")), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(F.col("n_nationkey") % 11 != 0, F.col("n_name")).alias("country"),
        F.when(F.col("n_nationkey") % 11 != 0, F.col("r_name")).alias("region"),
        F.col("c_mktsegment").alias("customer_segment"),
        (F.col("c_custkey") % 13 != 0).alias("is_current"),
    )


def star_facts(spark: SparkSession, folder: str, customers: bool = True) -> DataFrame:
    """One fact per line item. Sale ids repeat, as after a fact load that ran twice.

    Customer and payment come from the orders; `customers=False` leaves that join out.
    """
    lines = load(spark, folder, "lineitem")
    if customers:
        orders = load(spark, folder, "orders")
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        buyer = [
            F.col("o_custkey").alias("customer_key"),
            F.col("o_orderpriority").alias("payment_method"),
        ]
    else:
        buyer = []
    day = F.col("l_shipdate").cast("date")
    quantity = F.col("l_quantity").cast("int")
    total = money(F.col("l_extendedprice"))
    return lines.select(
        F.monotonically_increasing_id().alias("sale_key"),
        date_key(day).alias("date_key"),
        F.col("l_partkey").alias("product_key"),
        *buyer,
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sale_id"),
        quantity.alias("quantity"),
        total.alias("total_amount"),
        # Cost as recorded on the sale: 55 % of the amount, unknown for returned goods.
        F.when(
            F.col("l_returnflag") != "R", (total * F.lit("0.55").cast("decimal(3,2)"))
        ).cast("decimal(12,2)").alias("cost_amount"),
    )


# ------------------------------------------------------------- received text


def _grouped(amount: Column) -> Column:
    """Amount as text, with a separator after the thousands."""
    text = amount.cast("string")
    return F.when(
        amount >= 1000,
        F.concat(F.floor(amount / 1000).cast("string"), F.lit(","), F.right(text, F.lit(6))),
    ).otherwise(text)


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as rows of a sales file, with faults of every kind."""
    lines, orders = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    key, day = F.col("l_orderkey"), F.col("l_shipdate").cast("date")
    quantity = F.col("l_quantity").cast("int")
    number = quantity.cast("string")
    in_cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    total = (in_cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(
        "decimal(12,2)"
    )
    unit_cents = F.expr(
        "(2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS INT))"
        " div (2 * CAST(l_quantity AS INT))"
    )
    unit = (unit_cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(
        "decimal(12,2)"
    )
    iso = F.date_format(day, "yyyy-MM-dd")
    dates = [
        iso,
        F.concat(iso, F.lit("T10:30:00")),
        F.concat(iso, F.lit("T23:59:59Z")),
        F.date_format(day, "MM/dd/yyyy"),
        F.concat(iso, F.lit("T10:30:00.123456Z")),
        F.concat(F.lit(" \t"), iso, F.lit("\n ")),
        F.concat_ws("-", F.year(day), F.month(day), F.dayofmonth(day)),
    ]
    sale_date = F.when(key % 107 == 0, "not-a-date").when(
        key % 109 == 0, F.concat(iso, F.lit("T00:00:00.000Z"))
    )
    for i, text in enumerate(dates):
        sale_date = sale_date.when(key % 7 == i, text)
    sale_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.when(key % 1013 == 0, "  ")
        .when(key % 3 == 0, F.concat(F.lit(" "), sale_id, F.lit("\t")))
        .otherwise(sale_id)
        .alias("sale_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.when(key % 97 == 0, "abc")
        .when(key % 101 == 0, "")
        .when(key % 103 == 0, F.concat(F.lit("-"), number))
        .when(key % 2 == 0, F.concat(number, F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), number, F.lit(" ")))
        .alias("quantity"),
        F.when(key % 113 == 0, "n/a").otherwise(_grouped(unit)).alias("unit_price"),
        F.when(key % 89 == 0, (total * 2).cast("decimal(12,2)").cast("string"))
        .otherwise(_grouped(total))
        .alias("total_amount"),
        sale_date.alias("sale_date"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def sale_order() -> Column:
    """The place of a sale in its file, which the given tables do not hold: by content."""
    return F.struct(
        "sale_date", "product_id", "total_amount", "quantity", "customer_id", "unit_price"
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as rows of a product file."""
    key = F.col("p_partkey")
    price = money(F.col("p_retailprice"), "decimal(10,2)").cast("string")
    cost = F.coalesce(product_cost().cast("string"), F.lit(""))
    return load(spark, folder, "part").select(
        F.concat(F.lit("P"), key.cast("string")).alias("product_id"),
        F.when(key % 53 == 0, " \t ").otherwise(F.concat(F.lit("  "), "p_name")).alias(
            "product_name"
        ),
        F.col("p_type").alias("category"),
        F.when(key % 59 == 0, F.concat(F.lit("-"), price))
        .when(key % 61 == 0, F.concat(F.lit("$"), price))
        .when(key % 67 == 0, "1e3")
        .otherwise(price)
        .alias("price"),
        F.when(key % 71 == 0, "-1").otherwise(cost).alias("cost"),
        F.concat("p_size", F.lit(".9")).alias("stock_quantity"),
        F.col("p_brand").alias("supplier"),
    )


def api_products(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as nested records of a JSON feed, rated by size."""
    size = F.col("p_size")
    return load(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("title"),
        money(F.col("p_retailprice"), "decimal(10,2)").cast("string").alias("price"),
        F.concat_ws(" ", F.lit("A"), "p_type", "p_name").alias("description"),
        F.lower("p_type").alias("category"),
        F.concat(F.lit("https://example.com/"), F.col("p_partkey").cast("string")).alias("image"),
        F.struct(
            F.when(size % 8 != 0, F.concat_ws(".", F.floor(size / 9), size % 10)).alias("rate"),
            (size * 3).cast("string").alias("count"),
        ).alias("rating"),
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as rows of a customer file."""
    key = F.col("c_custkey")
    number = F.split("c_name", "#")[1]
    day = F.date_add(F.lit(FIRST_SHIP_DAY), (key % 2000).cast("int"))
    return load(spark, folder, "customer").select(
        F.concat(F.lit("C"), key.cast("string")).alias("customer_id"),
        F.when(key % 17 != 0, F.concat(F.lit(" "), F.split("c_name", "#")[0])).alias("first_name"),
        F.when(key % 19 != 0, number).alias("last_name"),
        F.when(key % 23 == 0, "no address")
        .when(key % 29 == 0, "user@host")
        .otherwise(F.concat(F.lit(" User"), number, F.lit("@Example.COM")))
        .alias("email"),
        F.when(key % 31 == 0, "none")
        .when(key % 37 == 0, "ext ")
        .otherwise(F.concat(F.lit("+1 (555) "), number, F.lit(" ext.")))
        .alias("phone"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
        _pick(STATES, key % len(STATES)).alias("state"),
        _pick(COUNTRIES, F.col("c_nationkey")).alias("country"),
        F.when(key % 5 == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(key % 5 == 1, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("registration_date"),
    )


def api_users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as nested records of a JSON feed."""
    return raw_customers(spark, folder).select(
        F.substring("customer_id", 2, 18).alias("id"),
        "email",
        F.col("customer_id").alias("username"),
        F.struct(F.col("first_name").alias("firstname"), F.col("last_name").alias("lastname")).alias(
            "name"
        ),
        F.struct(
            "city",
            F.concat("city", F.lit(" Street")).alias("street"),
            F.right("customer_id", F.lit(3)).alias("zipcode"),
        ).alias("address"),
        "phone",
    )


def api_carts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as shopping carts of zero to three items, the number in `props` deciding."""
    k = F.from_json("props", "k INT")["k"]
    item = [
        F.struct(
            ((k + i * 7) % 40).cast("string").alias("productId"),
            F.when(k % 11 != i, (k % 6 + i).cast("string")).alias("quantity"),
        )
        for i in range(3)
    ]
    return load(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("userId"),
        F.when(F.col("event_id") % 9 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("date"),
        F.when(k % 4 != 0, F.slice(F.array(*item), 1, (k % 4).cast("int"))).alias("products"),
    )


# ------------------------------------------------------------------ run logs


def ingestion_log(spark: SparkSession, folder: str) -> DataFrame:
    """One run per event: what was received, and 95 % of it stored."""
    received = F.floor(F.col("value") * 10)
    rejected = received - F.floor(received * 95 / 100)
    failed = F.col("event_type") == "error"
    third = F.col("event_id") % 3 == 0
    runs = load(spark, folder, "events").select(
        F.concat(F.lit("batch-"), F.col("user_id").cast("string")).alias("batch_id"),
        F.when(third, "csv_ingestion").otherwise("api_ingestion").alias("pipeline_name"),
        F.col("event_type").alias("source_name"),
        F.when(third, "csv").otherwise("api").alias("source_type"),
        received.alias("records_received"),
        (received - F.when(third, 0).otherwise(rejected)).alias("records_stored"),
        F.when(third, 0).otherwise(rejected).alias("records_rejected"),
        F.col("ts").alias("extraction_started_at"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("value"))).alias("load_completed_at"),
        F.when(failed, "connection lost").alias("error_message"),
        F.col("ts").alias("created_at"),
    )
    return with_run_measures(runs)


def rejection_details(spark: SparkSession, folder: str) -> DataFrame:
    """One detail row per event, its reason chosen by the number in `props`."""
    k = F.from_json("props", "k INT")["k"]
    reasons = ["price must be positive", "title cannot be null or empty", "missing_key"]
    return load(spark, folder, "events").select(
        F.concat(F.lit("batch-"), F.col("user_id").cast("string")).alias("batch_id"),
        F.col("event_type").alias("source_name"),
        _pick(reasons, k % 3).alias("rejection_reason"),
        (k % 10 + 1).cast("bigint").alias("rejection_count"),
    )
