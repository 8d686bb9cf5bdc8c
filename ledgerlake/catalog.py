"""Every job and query of the warehouse, run on the given benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import cleaning as clean
from ledgerlake.functions import validation
from ledgerlake.functions.calendar import HOLIDAYS, calendar_of, date_key, dim_date
from ledgerlake.operators.keys import next_keys
from ledgerlake.operators.slices import Mine, deal, stored
from ledgerlake.plans import dimensions, facts, marts, quality, staging, views
from ledgerlake.plans.ingestion import ingest_batch
from ledgerlake.plans.pipeline import Transformation
from ledgerlake.schemas import TABLES
from ledgerlake.session import COMPACT, discard, materialize, result_table, scratch, shuffles_dropped, temporary
from ledgerlake.sources import files, raw
from ledgerlake.sources import tables as given
from ledgerlake.sources.store import Warehouse
from ledgerlake.streaming import windows
from ledgerlake.streaming.landing import forget_last_commit, stream_feed, stream_to_staging

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def load_day() -> Column:
    return F.lit(given.LOAD_DAY)


def report_day() -> Column:
    return F.lit(given.REPORT_DAY)


def now() -> Column:
    return F.lit("2001-06-30 12:00:00").cast("timestamp")


def earlier() -> Column:
    return F.lit("2001-01-01 00:00:00").cast("timestamp")


def batch() -> Column:
    return F.lit("batch-2")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ------------------------------------------------------- calendar and cleaning


def _stage(current: DataFrame, checked: staging.Checked, when: Column, batch_id: Column) -> DataFrame:
    """Staging as the job does it, with the checked records stored first."""
    stored = staging.Checked(checked.entity, result_table(checked.records, checked.entity))
    return staging.stage(current, stored, when, batch_id)


@query
def dim_date_full(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar of every day that occurs in the order and ship dates."""
    lines, orders = given.load(spark, folder, "lineitem"), given.load(spark, folder, "orders")
    days = lines.select(F.to_date("l_shipdate").alias("full_date")).union(
        orders.select(F.to_date("o_orderdate"))
    )
    calendar = calendar_of(days, F.col("full_date"))
    return calendar.join(days.distinct(), "full_date", "left_semi")


@query
def calendar_holidays(spark: SparkSession, folder: str) -> DataFrame:
    """The holidays among the days from the first to the last order or shipment."""
    lines, orders = given.load(spark, folder, "lineitem"), given.load(spark, folder, "orders")
    days = lines.select(F.to_date("l_shipdate").alias("full_date")).union(
        orders.select(F.to_date("o_orderdate"))
    )
    found = calendar_of(days, F.col("full_date"), HOLIDAYS)
    return found.where("is_holiday").select("full_date", "day_name")


@query
def latest_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw records, one batch per day: those of the last batch."""
    events = given.load(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.date_format("ts", "yyyyMMdd").alias("batch_id"),
        F.col("ts").alias("ingested_at"),
    )
    return raw.latest_batch(events).select("event_id", "event_type", "batch_id")


@query
def clean_strings(spark: SparkSession, folder: str) -> DataFrame:
    products = given.raw_products(spark, folder)
    return products.select(
        "product_id",
        clean.clean_string(F.col("product_name")).alias("title"),
        clean.clean_string(F.col("supplier")).alias("supplier"),
    )


@query
def clean_decimals(spark: SparkSession, folder: str) -> DataFrame:
    sales = given.raw_sales(spark, folder)
    return sales.select(
        clean.clean_string(F.col("sale_id")).alias("sale_id"),
        clean.clean_integer(F.col("quantity")).alias("quantity"),
        clean.clean_integer(F.col("quantity"), F.lit(1)).alias("quantity_or_one"),
        clean.clean_decimal(F.col("unit_price")).cast("decimal(12,2)").alias("unit_price"),
        clean.clean_decimal(F.col("total_amount")).cast("decimal(12,2)").alias("total_amount"),
    )


@query
def clean_dates(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("sale_date")
    return given.raw_sales(spark, folder).select(
        clean.clean_string(F.col("sale_id")).alias("sale_id"),
        clean.clean_date(text).alias("sale_date"),
        clean.clean_date(text, lenient=True).alias("lenient_date"),
        date_key(clean.clean_date(text)).alias("date_key"),
    )


@query
def clean_contacts(spark: SparkSession, folder: str) -> DataFrame:
    return given.raw_customers(spark, folder).select(
        "customer_id",
        clean.clean_email(F.col("email")).alias("email"),
        clean.clean_phone(F.col("phone")).alias("phone"),
        clean.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        clean.clean_date(F.col("registration_date")).alias("registration_date"),
    )


@query
def region_map(spark: SparkSession, folder: str) -> DataFrame:
    return given.raw_customers(spark, folder).select(
        "customer_id",
        "country",
        "state",
        clean.region(F.col("country"), F.col("state")).alias("region"),
    )


@query
def segment(spark: SparkSession, folder: str) -> DataFrame:
    """Segment of every customer by the amounts and number of their orders."""
    totals = (
        given.load(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("spent"),
            F.count(F.lit(1)).alias("orders"),
        )
    )
    # Order totals are far above the thresholds, so they are scaled down to meet them.
    scaled = F.col("spent") / 2000
    return totals.select(
        F.col("o_custkey").alias("customer_key"),
        "orders",
        clean.customer_segment(scaled, F.floor(F.col("orders") / 2)).alias("segment"),
    )


# --------------------------------------------------------- flattening and scans


@query
def flatten_products(spark: SparkSession, folder: str) -> DataFrame:
    return raw.flatten_products(given.api_products(spark, folder)).drop("raw_json")


@query
def flatten_users(spark: SparkSession, folder: str) -> DataFrame:
    """Nested user records flattened for the raw table and cleaned for staging."""
    users = staging.clean_api_users(raw.flatten_users(given.api_users(spark, folder)))
    return users.select(
        "source_customer_id",
        "source_system",
        "email",
        "first_name",
        "last_name",
        "full_name",
        "phone",
        "city",
        "country",
    )


@query
def flatten_carts(spark: SparkSession, folder: str) -> DataFrame:
    carts = raw.flatten_carts(given.api_carts(spark, folder))
    return carts.select("source_id", "user_id", "cart_date", "products_json")


@query
def explode_carts(spark: SparkSession, folder: str) -> DataFrame:
    carts = staging.clean_api_carts(raw.flatten_carts(given.api_carts(spark, folder)))
    return carts.select(
        "source_sale_id",
        "source_customer_id",
        "source_product_id",
        "quantity",
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("total_amount").cast("decimal(12,2)").alias("total_amount"),
        "sale_date",
        "payment_method",
    )


@query
def csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as CSV files, scanned back and shaped for the raw table."""
    path = temporary(spark, "csv")
    given.raw_customers(spark, folder).write.option("header", True).option("escape", '"').csv(path)
    scan = files.extract_csv(spark, path, "csv_customers")
    return raw.csv_record(scan.frame, "csv_customers").drop("file_name", "line_number")


@query
def csv_line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as CSV files, each record with its place in its file; and scanned back."""
    path = temporary(spark, "csv")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 2
    orders = given.load(spark, folder, "orders").select("o_orderkey", place.alias("place"))
    orders.write.option("header", True).csv(path)
    scan = files.extract_csv(spark, path, "orders").frame
    return scan.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        (F.col("place").cast("bigint") == F.col("_line_number")).alias("numbered_right"),
        F.col("_file_name").endswith(".csv").alias("named"),
    )


@query
def json_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Carts written as JSON lines, scanned back and shaped for the raw table."""
    path = temporary(spark, "json")
    given.api_carts(spark, folder).write.json(path)
    scan = files.extract_json(spark, path, "api_carts", lines=True)
    carts = raw.flatten_carts(scan.frame)
    return carts.select("source_id", "user_id", "cart_date", "products_json")


@query
def json_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Carts landed as one array a file, or one object where a file holds a single one."""
    path = temporary(spark, "arrays")
    # Every hundred carts are a file, but for some that are a file of their own.
    number = F.col("id").cast("bigint")
    file = F.when(number % 100 == 7, F.concat(F.lit("one-"), "id")).otherwise(
        F.concat(F.lit("many-"), F.floor(number / 100).cast("string"))
    )
    carts = given.api_carts(spark, folder).withColumn("file", file)
    texts = carts.groupBy("file").agg(F.collect_list(F.to_json(F.struct("id", "userId", "date", "products"))).alias("all"))
    text = F.when(F.size("all") == 1, F.element_at("all", 1)).otherwise(F.concat(F.lit("["), F.array_join("all", ",\n"), F.lit("]")))
    texts.select("file", text.alias("value")).write.partitionBy("file").text(path)
    scan = files.extract_json(spark, f"{path}/*", "api_carts")
    return raw.flatten_carts(scan.frame).select("source_id", "user_id", "cart_date", "products_json")


@query
def ragged_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as lines of text, some too short or too long, each line in its file by number.

    Records that do not fit the header are kept apart, one by one, or with their whole file.
    """
    path = temporary(spark, "ragged")
    key, more = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 11 == 0, ",more").otherwise("")
    status = F.when(key % 13 == 0, "").otherwise(F.concat(F.lit(","), "o_orderstatus"))
    line = F.concat(key.cast("string"), status, more)
    orders = given.load(spark, folder, "orders").select((key % 8).alias("file"), key.alias("place"), line.alias("line"))
    head = spark.range(8).select(F.col("id").alias("file"), F.lit(-1).cast("bigint").alias("place"), F.lit("key,status").alias("line"))
    rows = orders.unionByName(head).repartition(8, "file").sortWithinPartitions("file", "place")
    rows.select("file", F.col("line").alias("value")).write.partitionBy("file").text(path)
    kinds = {}
    for how in ("reject_row", "fail_file"):
        scan = files.extract_csv(spark, path, "orders", on_ragged=how)
        kinds[f"{how}_good"], kinds[f"{how}_broken"] = scan.frame, scan.broken
    parts = [
        f.select(F.lit(kind).alias("kind"), F.col("_file_path").alias("path"), F.col("key").cast("bigint").alias("key"))
        for kind, f in kinds.items()
    ]
    found = quality.union_all(parts).withColumn("file", F.regexp_extract("path", r"file=(\d+)", 1).cast("int"))
    return found.groupBy("kind", "file").agg(F.count(F.lit(1)).alias("records"), F.sum("key").alias("keys"))


@query
def landed_day(spark: SparkSession, folder: str) -> DataFrame:
    """What a day's landed files give: the three CSV files, of which one is missing, and the feeds."""
    root = temporary(spark, "day")
    tables = {"products": given.raw_products(spark, folder), "customers": given.raw_customers(spark, folder)}
    for name, frame in tables.items():
        frame.write.option("header", True).option("escape", '"').csv(f"{root}/csv/{name}.csv")
    feeds = {"api_products": given.api_products, "api_users": given.api_users, "api_carts": given.api_carts}
    for source, feed in feeds.items():
        for day in ("2001-06-29", "2001-06-30"):
            feed(spark, folder).write.json(f"{root}/raw/{source}/{day}")
    found = {
        **files.extract_all_csv(spark, f"{root}/csv"),
        **files.extract_landing(spark, f"{root}/raw", "2001-06-30", lines=True),
    }
    none = spark.createDataFrame([], "x int")
    parts = [
        (e.frame if e.success else none).agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(source).alias("source_name"), F.lit(e.source_type).alias("source_type"), "records",
            F.lit((e.error_message or "").startswith("File not found")).alias("not_found"),
        )
        for source, e in found.items()
    ]
    return quality.union_all(parts)


@query
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of all line items above those of the orders: how many, how many different, how many new."""
    known = given.load(spark, folder, "orders").select(F.col("o_orderkey").alias("sale_key"))
    lines = given.load(spark, folder, "lineitem").repartition(16)
    keyed = result_table(lines.select("l_returnflag", next_keys(known, "sale_key").alias("sale_key")), "keys")
    highest = known.agg(F.max("sale_key")).scalar()
    return keyed.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"),
        F.countDistinct("sale_key").alias("different"),
        F.count_if(F.col("sale_key") > highest).alias("new"),
    )


# ------------------------------------------------------------------- validation


@query
def validate_raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The customer rules on received text, before it is cleaned: emails and dates."""
    rules = validation.customer_rules(F.col("email"), F.col("registration_date"))
    people = given.raw_customers(spark, folder)
    return people.select("customer_id", F.array_join(validation.errors(*rules)["reason"], "; ").alias("reasons"))


def _cleaned_products(spark: SparkSession, folder: str) -> DataFrame:
    return staging.clean_csv_products(given.raw_products(spark, folder)).unionByName(
        staging.clean_api_products(raw.flatten_products(given.api_products(spark, folder)))
    )


def _products(spark: SparkSession, folder: str) -> staging.Checked:
    return staging.check(_cleaned_products(spark, folder), "products", load_day())


def _customers(spark: SparkSession, folder: str) -> staging.Checked:
    cleaned = staging.clean_csv_customers(given.raw_customers(spark, folder))
    return staging.check(cleaned, "customers", load_day())


def _sales(spark: SparkSession, folder: str) -> staging.Checked:
    cleaned = staging.clean_csv_sales(given.raw_sales(spark, folder), given.sale_order())
    return staging.check(cleaned, "sales", load_day())


def _verdicts(checked: staging.Checked) -> DataFrame:
    key = staging.KEYS[checked.entity][0]
    return checked.records.select(
        key,
        "source_system",
        (F.size("errors") == 0).alias("is_valid"),
        F.array_join("errors.message", "; ").alias("validation_errors"),
    )


@query
def validate_products(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(_products(spark, folder))


@query
def validate_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(_customers(spark, folder))


@query
def validate_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(_sales(spark, folder))


@query
def rejection_counts(spark: SparkSession, folder: str) -> DataFrame:
    return staging.reject_reasons(_sales(spark, folder))


@query
def rejected_records(spark: SparkSession, folder: str) -> DataFrame:
    """The refused sales with all their reasons; two fields are read back from the record."""
    kept = staging.rejected_records(_sales(spark, folder), now(), batch())
    record = F.from_json("record", "quantity int, sale_date date")
    return kept.select(
        "source_name",
        "record_key",
        "rejection_reasons",
        record["quantity"].alias("quantity"),
        record["sale_date"].alias("sale_date"),
    )


# ------------------------------------------------- staging, dimensions and facts


def _no_rows(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def _earlier_products(spark: SparkSession, folder: str) -> DataFrame:
    """Staging as an earlier batch left it: the CSV products, one unit cheaper."""
    part = given.star_products(spark, folder)
    return part.select(
        F.concat(F.lit("P"), F.col("product_key").cast("string")).alias("source_product_id"),
        F.lit("csv").alias("source_system"),
        F.col("title"),
        F.col("category"),
        (F.col("price") - 1).cast("decimal(10,2)").alias("price"),
        F.col("cost"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("image_url"),
        F.lit(None).cast("decimal(3,2)").alias("rating_rate"),
        F.lit(None).cast("int").alias("rating_count"),
        F.col("stock_quantity"),
        F.col("supplier"),
        F.lit(True).alias("is_valid"),
        F.lit(None).cast("string").alias("validation_errors"),
        earlier().alias("created_at"),
        earlier().alias("updated_at"),
        F.lit("batch-1").alias("batch_id"),
    )


@query
def staging_products(spark: SparkSession, folder: str) -> DataFrame:
    """Valid CSV and API products upserted into the earlier snapshot."""
    current = _earlier_products(spark, folder)
    staged = _stage(current, _products(spark, folder), now(), batch())
    return staged.select(
        "source_product_id",
        "source_system",
        "title",
        "category",
        "price",
        "cost",
        "rating_rate",
        "rating_count",
        "stock_quantity",
        F.to_date("created_at").alias("created_on"),
        F.to_date("updated_at").alias("updated_on"),
        "batch_id",
        "action",
    )


@query
def staging_customers(spark: SparkSession, folder: str) -> DataFrame:
    staged = _stage(
        _no_rows(spark, "staging.customers"), _customers(spark, folder), now(), batch()
    )
    return staged.select(
        "source_customer_id",
        "source_system",
        "email",
        "full_name",
        "phone",
        "city",
        "state",
        "country",
        "registration_date",
        "action",
    )


def _staged_sales(spark: SparkSession, folder: str) -> DataFrame:
    empty = _no_rows(spark, "staging.sales")
    return _stage(empty, _sales(spark, folder), now(), batch())


@query
def staging_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Valid sales, of which the last per key is stored."""
    return _staged_sales(spark, folder).select(
        "source_sale_id",
        "source_system",
        "source_customer_id",
        "source_product_id",
        "quantity",
        "unit_price",
        "total_amount",
        "sale_date",
        "payment_method",
        "action",
    )


@query
def staging_customers_update(spark: SparkSession, folder: str) -> DataFrame:
    """Both feeds of customers over a snapshot that has every second one from the files."""
    both = staging.clean_csv_customers(given.raw_customers(spark, folder)).unionByName(
        staging.clean_api_users(raw.flatten_users(given.api_users(spark, folder)))
    )
    columns = {c.split()[0]: c.split()[1] for c in TABLES["staging.customers"].split(", ")}
    known = {
        "source_customer_id": F.concat(F.lit("C"), "c_custkey"),
        "source_system": F.lit("csv"),
        "email": F.lit("old@example.com"),
        "full_name": F.lit("Old"),
        "is_valid": F.lit(True),
        "created_at": earlier(),
        "updated_at": earlier(),
        "batch_id": F.lit("batch-1"),
    }
    before = given.load(spark, folder, "customer").where("c_custkey % 2 = 0").select(
        *[known.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()]
    )
    staged = _stage(before, staging.check(both, "customers", load_day()), now(), batch())
    return staged.select("source_customer_id", "source_system", "email", "full_name", "batch_id", "action")


@query
def staging_sales_update(spark: SparkSession, folder: str) -> DataFrame:
    """Sales files and carts over a snapshot that has the sales of every second order."""
    # Carts are unique, so their place does not matter; it only has to be of the same type.
    kind = given.raw_sales(spark, folder).select(given.sale_order().alias("place")).dtypes[0][1]
    no_place = F.lit(None).cast(kind)
    both = staging.clean_csv_sales(given.raw_sales(spark, folder), given.sale_order()).unionByName(
        staging.clean_api_carts(raw.flatten_carts(given.api_carts(spark, folder)), no_place)
    )
    before = _sale_lines(spark, folder).where(F.split("source_sale_id", "-")[0].cast("bigint") % 2 == 0)
    staged = _stage(
        before.drop("line"), staging.check(both, "sales", load_day()), now(), batch()
    )
    return staged.select("source_sale_id", "source_system", "quantity", "batch_id", "action")


@query
def load_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per action of the product upsert."""
    staged = _stage(
        _earlier_products(spark, folder), _products(spark, folder), now(), batch()
    )
    return staged.groupBy("action").agg(F.count(F.lit(1)).alias("records"))


def _versions(frame: DataFrame) -> DataFrame:
    """Validity columns for a dimension whose versions opened on 2000-01-01."""
    return (
        frame.withColumn("effective_from", F.lit(date(2000, 1, 1)))
        .withColumn(
            "effective_to",
            F.when(F.col("is_current"), F.lit(date(9999, 12, 31))).otherwise(
                F.lit(date(2000, 6, 1))
            ),
        )
        .withColumn("created_at", earlier())
        .withColumn("updated_at", earlier())
    )


@query
def scd2_product(spark: SparkSession, folder: str) -> DataFrame:
    """Staged CSV products merged into the product dimension."""
    void = F.lit(None).cast("string")
    dim = _versions(
        given.star_products(spark, folder)
        .withColumn("description", void)
        .withColumn("image_url", void)
        .withColumn("rating_rate", F.lit(None).cast("decimal(3,2)"))
        .withColumn("rating_count", F.lit(None).cast("int"))
    )
    checked = staging.check(
        staging.clean_csv_products(given.raw_products(spark, folder)), "products", load_day()
    )
    snapshot = _stage(_no_rows(spark, "staging.products"), checked, now(), batch())
    merged = dimensions.merge_products(
        dim, dimensions.staged_products(snapshot), load_day(), now()
    )
    margin = dimensions.profit_margin(F.col("price"), F.col("cost")).cast("decimal(10,4)")
    return merged.select(
        "product_id",
        "title",
        "category",
        "price",
        "cost",
        margin.alias("profit_margin"),
        "stock_quantity",
        "supplier",
        "effective_from",
        "effective_to",
        "is_current",
        "action",
    )


def _customer_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as loaded earlier; every seventh lived elsewhere."""
    people = given.raw_customers(spark, folder)
    key = F.substring("customer_id", 2, 18).cast("bigint")
    country = clean.clean_string(F.col("country"))
    return _versions(
        people.select(
            key.alias("customer_key"),
            F.concat("customer_id", F.lit("-csv")).alias("customer_id"),
            F.lit("old@example.com").alias("email"),
            F.lit("Old").alias("first_name"),
            F.lit("Name").alias("last_name"),
            F.lit("Old Name").alias("full_name"),
            F.lit(None).cast("string").alias("phone"),
            "city",
            clean.clean_string(F.col("state")).alias("state"),
            F.when(key % 7 == 0, "Elsewhere").otherwise(country).alias("country"),
            F.lit("Old Region").alias("region"),
            F.lit(None).cast("date").alias("registration_date"),
            F.lit("Regular").alias("customer_segment"),
            (key % 13 != 0).alias("is_current"),
        )
    )


@query
def scd2_customer(spark: SparkSession, folder: str) -> DataFrame:
    """Staged customers merged into the customer dimension."""
    snapshot = _stage(
        _no_rows(spark, "staging.customers"), _customers(spark, folder), now(), batch()
    )
    merged = dimensions.merge_customers(
        _customer_dim(spark, folder), dimensions.staged_customers(snapshot), load_day(), now()
    )
    return merged.select(
        "customer_id",
        "email",
        "full_name",
        "city",
        "country",
        "region",
        "registration_date",
        "customer_segment",
        "effective_from",
        "effective_to",
        "is_current",
        "action",
    )


def _fact_load(spark: SparkSession, folder: str, work: str | None = None) -> facts.FactLoad:
    """The valid sales staged and resolved, slice by slice, and stored: in `work`, if given."""
    checked, empty = _sales(spark, folder), _no_rows(spark, "staging.sales")
    dealt = deal(checked.records.where(F.size("errors") == 0), staging.KEYS["sales"], "sales", work)
    products, customers = given.star_products(spark, folder), given.star_customers(spark, folder)
    # A calendar that ends before the last sales do.
    days = dim_date(spark, given.FIRST_SHIP_DAY, date(2000, 12, 31))

    def resolved(records: DataFrame, mine: Mine) -> DataFrame:
        staged = staging.stage(mine(empty), staging.Checked("sales", records), now(), batch())
        return facts.resolve(staged, products, customers, days).resolved.drop("product_id", "customer_id")

    return facts.FactLoad(stored((resolved(*part) for part in dealt.taken()), "resolved", work))


@query
def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Staged sales with their dimension keys and cost."""
    rows = _fact_load(spark, folder).rows(_no_rows(spark, "dw.fact_sales"), now(), batch())
    profit = facts.profit_amount(F.col("total_amount"), F.col("cost_amount"))
    return rows.withColumn("profit_amount", profit.cast("decimal(14,2)")).drop(
        "sale_key", "created_at", "batch_id"
    )


@query
def fact_skipped(spark: SparkSession, folder: str) -> DataFrame:
    skipped = _fact_load(spark, folder).skipped
    return skipped.groupBy("skip_reason").agg(F.count(F.lit(1)).alias("skipped"))


@query
def fact_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of an earlier load, half their amount, with the new load merged over them."""
    new = _fact_load(spark, folder).rows(_no_rows(spark, "dw.fact_sales"), now(), batch())
    columns = ["sale_id", "source_system", "product_key", "total_amount"]
    lines = given.load(spark, folder, "lineitem")
    old = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sale_id"),
        F.lit("csv").alias("source_system"),
        F.col("l_partkey").alias("product_key"),
        (given.money(F.col("l_extendedprice")) * F.lit("0.5").cast("decimal(2,1)"))
        .cast("decimal(12,2)")
        .alias("total_amount"),
    )
    return facts.merge_facts(old, new.select(*columns))


def _sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One staged sale per order line, whatever the table repeats."""
    lines = given.load(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("part"), F.max("l_quantity").cast("int").alias("quantity")
    )
    money = F.lit(1).cast("decimal(10,2)")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_sale_id"),
        F.lit("csv").alias("source_system"),
        F.lit("C1").alias("source_customer_id"),
        F.concat(F.lit("P"), "part").alias("source_product_id"),
        "quantity",
        money.alias("unit_price"),
        money.cast("decimal(12,2)").alias("total_amount"),
        F.lit(date(2001, 1, 2)).alias("sale_date"),
        F.lit("card").alias("payment_method"),
        F.lit(True).alias("is_valid"),
        F.lit(None).cast("string").alias("validation_errors"),
        earlier().alias("created_at"),
        earlier().alias("updated_at"),
        F.lit("batch-1").alias("batch_id"),
        F.col("l_linenumber").alias("line"),
    )


def _sold_products(spark: SparkSession, folder: str, cost: Column, key: Column) -> DataFrame:
    return given.load(spark, folder, "part").select(
        key.alias("product_key"),
        F.concat(F.lit("P"), "p_partkey", F.lit("-csv")).alias("product_id"),
        cost.cast("decimal(10,2)").alias("cost"),
        F.lit(True).alias("is_current"),
    )


def _resolved(spark: SparkSession, sales: DataFrame, products: DataFrame) -> facts.FactLoad:
    buyer = spark.createDataFrame([("C1-csv", 1, True)], "customer_id string, customer_key long, is_current boolean")
    return facts.resolve(sales, products, buyer, dim_date(spark, date(2001, 1, 1), date(2001, 1, 3)))


@query
def fact_out_of_range(spark: SparkSession, folder: str) -> DataFrame:
    """Sales whose cost no fact can hold are skipped by name, and all others load."""
    size = F.col("p_size")
    cost = F.when(size % 5 == 0, F.lit("99999999.99").cast("decimal(10,2)")).otherwise(size + 1)
    products = _sold_products(spark, folder, cost, F.col("p_partkey"))
    sales = _sale_lines(spark, folder).withColumn("quantity", F.col("quantity") * 1000)
    load = _resolved(spark, sales, products).resolved
    return load.groupBy("skip_reason").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("cost_amount").cast("decimal(28,2)").alias("cost_amount")
    )


@query
def fact_second_load(spark: SparkSession, folder: str) -> DataFrame:
    """Facts, then a change of prices, then a second load.

    First lines of an order are new, second ones arrive again as they were, third ones are
    corrected, and the rest do not arrive. Only new and corrected ones get the new version.
    """
    size, key = F.col("p_size"), F.col("p_partkey")
    dearer = F.when(size % 3 == 0, 1).otherwise(0)
    old = _sold_products(spark, folder, size + 1, key)
    new = _sold_products(spark, folder, size + 1 + dearer, key + dearer * 1_000_000_000)
    sales, line = _sale_lines(spark, folder), F.col("line")
    none = _no_rows(spark, "dw.fact_sales")
    first = _resolved(spark, sales.where(line != 1).drop("line"), old).rows(none, earlier(), F.lit("batch-1"))
    staged = (
        sales.withColumn("quantity", F.col("quantity") + F.when(line == 3, 1).otherwise(0))
        .withColumn("created_at", F.when(line == 1, now()).otherwise(earlier()))
        .withColumn("batch_id", F.when(line <= 3, batch()).otherwise(F.lit("batch-1")))
        .drop("line")
    )
    waiting = _no_rows(spark, "staging.waiting_sales")
    arrived = facts.arrived_sales(staged, first, waiting, batch(), now())
    second = _resolved(spark, arrived, new).rows(none, now(), batch())
    return facts.merge_facts(first, second).select("sale_id", "product_key", "quantity", "cost_amount")


@query
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Events landed as files of carts, streamed one file per micro-batch, then staged.

    Every micro-batch is a raw batch, and staging takes all of them; of a cart that comes
    several times the last record of the last file counts. A user's events are one cart.
    """
    root = temporary(spark, "stream")
    # All events, in the order of their ids through the files.
    events = given.load(spark, folder, "events").orderBy("event_id")
    for day, older in enumerate((2, 1, 0)):
        # The same carts three times; only the last file has the last quantity.
        item = F.struct(
            F.lit("9").alias("productId"),
            ((F.col("event_id") + older) % 7 + 1).cast("string").alias("quantity"),
        )
        carts = events.select(
            F.col("user_id").cast("string").alias("id"),
            F.lit("1").alias("userId"),
            F.lit("2001-01-01").alias("date"),
            F.array(item).alias("products"),
        )
        carts.write.json(f"{root}/landing/api_carts/day{day}")
        store = Warehouse(spark, f"{root}/warehouse")
        stream_feed(
            spark, store, f"{root}/landing", "api_carts", f"{root}/progress", lines=True
        ).awaitTermination()
    found = store.read("raw.api_carts")
    cleaned = staging.clean_api_carts(found, staging.arrival())
    checked = staging.check(cleaned, "sales", load_day())
    staged = _stage(_no_rows(spark, "staging.sales"), checked, now(), batch())
    batches = found.agg(F.countDistinct("batch_id")).scalar()
    return staged.select(
        "source_sale_id", "source_system", "quantity", "sale_date", batches.alias("n_batches")
    )


#: How long events may be late, and which of them land only when all others have.
DELAY = "12 days"


def _event_batches(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Events as they land: ten days at a time, each again with the next ten days, and at the
    end those that were held up.
    """
    events = given.load(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value"
    )
    held_up, third = F.col("event_id") % 50 == 3, F.least(F.lit(3), F.expr("(day(ts) - 1) div 10 + 1"))
    prompt = events.where(~held_up).withColumn("third", third)
    batches = [prompt.where((third == k) | (third == k - 1)).drop("third") for k in (1, 2, 3, 4)]
    return [*batches, events.where(held_up)]


def _event_stream(spark: SparkSession, folder: str, shape: Callable[[DataFrame], DataFrame]):
    """The landed events and what a stream of them has appended, batch by batch."""
    root = temporary(spark, "events")
    schema = "event_id bigint, ts timestamp, user_id bigint, value double"
    for number, arrived in enumerate(_event_batches(spark, folder)):
        arrived.write.parquet(f"{root}/landing/batch-{number}")
        stream = shape(spark.readStream.schema(schema).parquet(f"{root}/landing/*"))
        windows.append_to(stream, f"{root}/taken", f"{root}/progress").awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/landing/*"), spark.read.parquet(f"{root}/taken")


def _once(events: DataFrame) -> DataFrame:
    return windows.once_each(events, ["event_id"], "ts", DELAY)


@query
def stream_sales_once(spark: SparkSession, folder: str) -> DataFrame:
    """Events that land twice, some of them late, each taken once."""
    return _event_stream(spark, folder, _once)[1].select("event_id", "user_id", "value")


@query
def stream_late_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The events that came too late to be taken, by name."""
    return windows.late_events(*_event_stream(spark, folder, _once), ["event_id"], "ts")


@query
def stream_daily_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue of the days that the watermark has closed; copies count once."""
    days = _event_stream(spark, folder, lambda e: windows.revenue_per_window(_once(e), "ts", "value"))[1]
    return days.select(F.to_date("window_start").alias("sale_date"), "sales", "revenue")


@query
def stream_to_staging_sales(spark: SparkSession, folder: str) -> DataFrame:
    """All events as CSV sales and as JSON carts, streamed into staging one landing at a time.

    The second landing of the CSV feed corrects every fifth sale, and the last micro-batch of
    each feed is given again, as after a failure before it was noted as done.
    """
    root = temporary(spark, "feeds")
    store = Warehouse(spark, f"{root}/warehouse")
    events, key = given.load(spark, folder, "events"), F.col("event_id")

    def run(source: str, **options) -> None:
        stream_to_staging(
            spark, store, f"{root}/landing", source, f"{root}/progress/{source}", given.LOAD_DAY, **options
        ).awaitTermination()

    for landing, again in enumerate((0, 1)):
        quantity = key % 7 + 1 + again
        sales = events.where(f"{again} = 0 OR event_id % 5 = 0").select(
            key.cast("string").alias("sale_id"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.lit("9").alias("product_id"),
            quantity.cast("string").alias("quantity"),
            F.lit("2.00").alias("unit_price"),
            (quantity * 2).cast("string").alias("total_amount"),
            F.lit("2001-01-01").alias("sale_date"),
            F.lit("cash").alias("payment_method"),
        )
        sales.write.option("header", True).csv(f"{root}/landing/csv_sales/day{landing}")
        run("csv_sales")
    item = F.struct(F.lit("9").alias("productId"), (key % 7 + 1).cast("string").alias("quantity"))
    carts = events.select(
        key.cast("string").alias("id"),
        F.col("user_id").cast("string").alias("userId"),
        F.lit("2001-01-01").alias("date"),
        F.array(item).alias("products"),
    )
    carts.write.json(f"{root}/landing/api_carts/day0")
    run("api_carts", lines=True)
    before = store.read("staging.sales").select("source_sale_id", "source_system", F.col("updated_at").alias("was"))
    for source, options in {"csv_sales": {}, "api_carts": {"lines": True}}.items():
        forget_last_commit(spark, f"{root}/progress/{source}")
        run(source, **options)
    now_staged = store.read("staging.sales").join(before, ["source_sale_id", "source_system"], "left")
    return now_staged.select(
        "source_sale_id",
        "source_system",
        "source_customer_id",
        "quantity",
        "total_amount",
        "sale_date",
        (F.col("updated_at") == F.col("was")).alias("left_alone"),
    )


@query
def fact_append(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of one load added twice to the stored table, by month."""
    store = Warehouse(spark, temporary(spark, "append"))
    with scratch(spark) as work:
        rows = _fact_load(spark, folder, work).rows(_no_rows(spark, "dw.fact_sales"), now(), batch())
        for _ in range(2):
            store.add("dw.fact_sales", rows)
    return store.read("dw.fact_sales").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("total_amount").cast("decimal(22,2)").alias("revenue")
    )


@query
def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of two loads by month, as another session of the catalog sees them.

    It reads the stored view over the facts after the first load, which brings the years up to
    1996, and again after the second.
    """
    name = f"sales{uuid.uuid4().hex[:12]}"
    store = Warehouse(spark, temporary(spark, name), catalog=name)
    store.publish()
    other = spark.newSession()
    with scratch(spark) as work:
        with scratch(spark) as once:
            load = _fact_load(spark, folder, once).rows(_no_rows(spark, "dw.fact_sales"), now(), batch())
            rows = materialize(load, "facts", work, COMPACT)
        store.add("dw.fact_sales", rows.where("year <= 1996"))
        seen = other.table(f"{name}_dw.fact_sales").agg(F.count(F.lit(1)), F.max("year")).first()
        store.add("dw.fact_sales", rows.where("year > 1996"))
    other.sql(f"REFRESH TABLE {name}_dw.fact_sales")
    return other.sql(
        f"""SELECT year, month, count(*) AS sales, CAST(sum(profit_amount) AS decimal(22,2)) AS profit,
          CAST({seen[0]} AS bigint) AS seen_first, {seen[1]} AS last_year_seen_first
        FROM {name}_dw.fact_sales_shown GROUP BY year, month"""
    )


def _ingested(spark: SparkSession, folder: str) -> Warehouse:
    """A warehouse that was given a file of customers, carts as JSON lines and no sales file."""
    root = temporary(spark, "job")
    given.raw_customers(spark, folder).write.option("header", True).option("escape", '"').csv(
        f"{root}/in/customers"
    )
    given.api_carts(spark, folder).write.json(f"{root}/in/carts")
    sources = {
        "csv_customers": files.extract_csv(spark, f"{root}/in/customers", "csv_customers"),
        "api_carts": files.extract_json(spark, f"{root}/in/carts", "api_carts", lines=True, source_type="api"),
        "csv_sales": files.extract_csv(spark, f"{root}/in/sales.csv", "csv_sales"),
    }
    store = Warehouse(spark, f"{root}/warehouse")
    ingest_batch(spark, store, sources, "batch-2", now())
    return store


@query
def ingestion_job(spark: SparkSession, folder: str) -> DataFrame:
    """The log of one ingestion of three sources, of which one is missing."""
    times = ("extraction_started_at", "extraction_completed_at", "load_started_at", "load_completed_at")
    ordered = [F.col(a) <= F.col(b) for a, b in zip(times, times[1:])]
    return _ingested(spark, folder).read("quality.ingestion_log").select(
        "batch_id",
        "source_name",
        "source_type",
        "records_received",
        "records_stored",
        "records_rejected",
        "quality_score",
        "status",
        F.col("error_message").startswith("File not found").alias("not_found"),
        (ordered[0] & ordered[1] & ordered[2]).alias("times_in_order"),
    )


@query
def customer_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The step log of staging the ingested customers and loading their dimension."""
    store = _ingested(spark, folder)
    job = Transformation(spark, store, "batch-2", given.LOAD_DAY, datetime(2001, 6, 30, 12))
    job.load_customers()
    job.load_dim_customer()
    job.save_log()
    return store.read("quality.transformation_log").select(
        "step_name",
        "target_table",
        "records_input",
        "records_inserted",
        "records_updated",
        "records_rejected",
        "status",
    )


def _landed_batch(spark: SparkSession, folder: str, root: str) -> dict[str, files.Extraction]:
    """Product, customer and sales files and the two JSON feeds of one batch."""
    rows = {
        "csv_products": given.raw_products(spark, folder),
        "csv_customers": given.raw_customers(spark, folder),
        # Of records of one sale the last one counts, so they are put in their order.
        "csv_sales": given.raw_sales(spark, folder).orderBy(given.sale_order()),
    }
    feeds = {"api_products": given.api_products(spark, folder), "api_users": given.api_users(spark, folder)}
    with shuffles_dropped(spark):
        for source, frame in rows.items():
            frame.write.option("header", True).option("escape", '"').csv(f"{root}/in/{source}", compression="gzip")
        for source, frame in feeds.items():
            frame.write.json(f"{root}/in/{source}", compression="gzip")
    scans = f"{root}/scans"
    found = {source: files.extract_csv(spark, f"{root}/in/{source}", source, folder=scans) for source in rows}
    for source in feeds:
        path = f"{root}/in/{source}"
        found[source] = files.extract_json(spark, path, source, lines=True, source_type="api", folder=scans)
    return found


@query
def warehouse_run(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job: landed files to raw, staging, star schema, marts and views.

    One row per row of each mart and of a view over the stored facts, with its orders, quantity
    and revenue.
    """
    root = temporary(spark, "run")
    store = Warehouse(spark, f"{root}/warehouse")
    ingest_batch(spark, store, _landed_batch(spark, folder, root), "batch-2", now())
    # All of it is in the raw tables now.
    for part in ("in", "scans"):
        discard(spark, f"{root}/{part}")
    job = Transformation(spark, store, "batch-2", given.LOAD_DAY, datetime(2001, 6, 30, 12))
    job.load_dim_date(given.FIRST_SHIP_DAY, date(2000, 12, 31))
    job.run()

    def shown(source: str, key: Column, table: DataFrame, orders: str, quantity: str | None, revenue: str):
        amount = F.col(quantity).cast("bigint") if quantity else F.lit(None).cast("bigint")
        return table.select(
            F.lit(source).alias("source"), key.alias("key"), F.col(orders).cast("bigint").alias("orders"),
            amount.alias("quantity"), F.col(revenue).cast("decimal(22,2)").alias("revenue"),
        )

    month = F.concat_ws("-", "year", "month_num")
    stored = {name: store.read(f"mart.{name}") for name in (
        "sales_daily", "product_performance", "customer_summary", "category_analysis")}
    parts = [
        shown("daily", F.col("date_key").cast("string"), stored["sales_daily"], "total_orders", "total_quantity", "total_revenue"),
        shown("product", F.col("product_id"), stored["product_performance"], "total_orders", "total_quantity_sold", "total_revenue"),
        shown("customer", F.col("customer_id"), stored["customer_summary"], "total_orders", "total_quantity", "total_spent"),
        shown("category", F.concat_ws("-", "category", "year", "month_num"), stored["category_analysis"],
              "total_orders", "total_quantity", "total_revenue"),
        shown("month", month, store.query("SELECT * FROM vw_monthly_sales"), "orders", None, "revenue"),
    ]
    return quality.union_all(parts)


@query
def update_segments(spark: SparkSession, folder: str) -> DataFrame:
    customers = given.star_customers(spark, folder).withColumn("updated_at", earlier())
    sold = given.star_facts(spark, folder)
    updated = facts.update_segments(customers, sold, now())
    return updated.select("customer_id", "is_current", "customer_segment")


# ------------------------------------------------------------------------ marts


@query
def sales_daily(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sales_daily(given.star_facts(spark, folder), given.star_calendar(spark, folder))


@query
def product_performance(spark: SparkSession, folder: str) -> DataFrame:
    return marts.product_performance(
        given.star_facts(spark, folder, customers=False),
        given.star_products(spark, folder),
        given.star_calendar(spark, folder),
        report_day(),
    )


def _customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    return marts.customer_summary(
        given.star_facts(spark, folder),
        given.star_customers(spark, folder),
        given.star_calendar(spark, folder),
        report_day(),
    )


@query
def customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _customer_summary(spark, folder).drop("rfm_score")


@query
def customer_rfm(spark: SparkSession, folder: str) -> DataFrame:
    return marts.with_rfm(_customer_summary(spark, folder)).select("customer_id", "rfm_score")


@query
def customer_summary_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The customer mart over facts that lie in buckets by customer: they are not shuffled again."""
    name = f"sales{uuid.uuid4().hex[:12]}"
    store = Warehouse(spark, temporary(spark, name), catalog=name)
    store.publish()
    sold = store.bucket_facts(given.star_facts(spark, folder), 16)
    mart = marts.customer_summary(
        sold, given.star_customers(spark, folder), given.star_calendar(spark, folder), report_day()
    )
    return mart.drop("rfm_score")


def _category_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return marts.category_analysis(
        given.star_facts(spark, folder),
        given.star_products(spark, folder),
        given.star_calendar(spark, folder),
    )


@query
def category_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return _category_analysis(spark, folder).drop("revenue_mom_change", "revenue_yoy_change")


@query
def category_growth(spark: SparkSession, folder: str) -> DataFrame:
    return marts.with_growth(_category_analysis(spark, folder)).select(
        "category", "year", "month_num", "revenue_mom_change", "revenue_yoy_change"
    )


# ------------------------------------------------------------ views, dashboards


def _view(name: str, function: Callable[..., DataFrame], *inputs: Query, **arguments) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(*[source(spark, folder) for source in inputs], **arguments)

    run.__name__ = name
    query(run)


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    return given.star_facts(spark, folder)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Facts for queries that do not ask for customers."""
    return given.star_facts(spark, folder, customers=False)


def _calendar(spark: SparkSession, folder: str) -> DataFrame:
    return given.star_calendar(spark, folder)


_log, _details = given.ingestion_log, given.rejection_details
_parts, _people = given.star_products, given.star_customers

_view("kpi_summary", views.sales_kpi_summary, _facts)
_view("daily_trend", views.daily_sales_trend, _lines, _calendar)
_view("sales_by_category", views.sales_by_category, _lines, _parts)
_view("top_products", views.top_products, _lines, _parts)
_view("customer_segments", views.customer_segments, _facts, _people)
_view("sales_by_region", views.sales_by_region, _facts, _people)
_view("monthly_sales", views.monthly_sales, _lines, _calendar)
_view("quality_summary", views.quality_summary, _log)
_view("quality_by_source", views.quality_by_source, _log)
_view("quality_trend", views.quality_trend, _log)
_view("recent_runs", views.recent_runs, _log)
_view("rejection_analysis", views.rejection_analysis, _details)
_view("kpi_cards", views.kpi_cards, _facts)
_view("daily_series", views.daily_series, _lines, _calendar)
_view("category_shares", views.category_shares, _lines, _parts)
_view("top10_products", views.best_products, _lines, _parts)
_view("segment_counts", views.segment_counts, _facts, _people)
_view("month_by_year", views.month_by_year, _lines, _calendar)
_view("quality_cards", views.quality_cards, _log)
_view("quality_series", views.quality_series, _log)
_view("source_volumes", views.source_volumes, _log)
_view("run_table", views.run_table, _log)
_view("status_counts", views.status_counts, _log)
_view("revenue_by_date_product", views.revenue_by_date_product, _lines, _calendar, _parts)
_view("run_summary", quality.run_summary, _log)


# ---------------------------------------------------------------------- quality


@query
def ingestion_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Score, status and duration of every run."""
    return given.ingestion_log(spark, folder).select(
        F.col("created_at"),
        "source_name",
        "records_received",
        "records_stored",
        "records_rejected",
        "quality_score",
        "status",
        "duration_seconds",
    )


@query
def rule_results(spark: SparkSession, folder: str) -> DataFrame:
    """The default rules on all cleaned records, valid or not."""
    tables = {
        "staging.products": _cleaned_products(spark, folder),
        "staging.customers": staging.clean_csv_customers(given.raw_customers(spark, folder)),
        "staging.sales": staging.clean_csv_sales(given.raw_sales(spark, folder), given.sale_order()),
    }
    return quality.rule_results(tables, load_day())


@query
def daily_quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Events as runs, orders as transformations, line items as rule results."""
    transforms = given.load(spark, folder, "orders").select(
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"),
    )
    rules = given.load(spark, folder, "lineitem").select(
        F.col("l_shipdate").alias("executed_at"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("records_failed"),
    )
    return quality.daily_summary(given.ingestion_log(spark, folder), transforms, rules)
