"""Raw records to staging rows: clean, validate, split, upsert."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import validation as v
from ledgerlake.functions.cleaning import (
    WIDE_DECIMAL,
    clean_date,
    clean_decimal,
    clean_email,
    clean_integer,
    clean_phone,
    clean_string,
    full_name,
)
from ledgerlake.operators.once import evaluate_once
from ledgerlake.operators.samples import samples
from ledgerlake.operators.upsert import last_per_key, upsert
from ledgerlake.schemas import CART_ITEMS, TEXT_LIMITS

# Price of a cart line, which the feed does not carry.
CART_PRICE = "50.0"

KEYS = {
    "products": ["source_product_id", "source_system"],
    "customers": ["source_customer_id", "source_system"],
    "sales": ["source_sale_id", "source_system"],
}
# Values are validated as received and narrowed to these types when they are stored.
STORED = {
    "price": "decimal(10,2)",
    "cost": "decimal(10,2)",
    "rating_rate": "decimal(3,2)",
    "unit_price": "decimal(10,2)",
    "total_amount": "decimal(12,2)",
}
# A record's place in its batch. The last record of a key wins.
PLACE = "_place"


def arrival() -> Column:
    """Later batches come after earlier ones, then files by name, then records by number."""
    return F.struct("ingested_at", "batch_id", "file_name", "line_number")


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _unordered() -> Column:
    return F.array(F.lit(0).cast("bigint"))


def _fields(frame: DataFrame, system: str, order: Column | None, **columns: Column) -> DataFrame:
    place = _unordered() if order is None else order
    source = F.lit(system)
    return evaluate_once(frame, [], **columns, source_system=source, **{PLACE: place})


def clean_api_products(raw: DataFrame, order: Column | None = None) -> DataFrame:
    return _fields(
        raw,
        "api",
        order,
        source_product_id=F.col("source_id"),
        title=clean_string(F.col("title")),
        category=clean_string(F.col("category")),
        price=clean_decimal(F.col("price")),
        cost=_none(WIDE_DECIMAL),
        description=clean_string(F.col("description")),
        image_url=clean_string(F.col("image_url")),
        rating_rate=clean_decimal(F.col("rating_rate")),
        rating_count=clean_integer(F.col("rating_count")),
        stock_quantity=_none("int"),
        supplier=_none(),
    )


def clean_csv_products(raw: DataFrame, order: Column | None = None) -> DataFrame:
    return _fields(
        raw,
        "csv",
        order,
        source_product_id=clean_string(F.col("product_id")),
        title=clean_string(F.col("product_name")),
        category=clean_string(F.col("category")),
        price=clean_decimal(F.col("price")),
        cost=clean_decimal(F.col("cost")),
        description=_none(),
        image_url=_none(),
        rating_rate=_none(WIDE_DECIMAL),
        rating_count=_none("int"),
        stock_quantity=clean_integer(F.col("stock_quantity")),
        supplier=clean_string(F.col("supplier")),
    )


def clean_api_users(raw: DataFrame, order: Column | None = None) -> DataFrame:
    return _fields(
        raw,
        "api",
        order,
        source_customer_id=F.col("source_id"),
        email=clean_email(F.col("email")),
        first_name=clean_string(F.col("firstname")),
        last_name=clean_string(F.col("lastname")),
        full_name=full_name(F.col("firstname"), F.col("lastname")),
        phone=clean_phone(F.col("phone")),
        city=clean_string(F.col("city")),
        state=_none(),
        country=_none(),
        registration_date=_none("date"),
    )


def clean_csv_customers(
    raw: DataFrame, order: Column | None = None, lenient_dates: bool = False
) -> DataFrame:
    return _fields(
        raw,
        "csv",
        order,
        source_customer_id=clean_string(F.col("customer_id")),
        email=clean_email(F.col("email")),
        first_name=clean_string(F.col("first_name")),
        last_name=clean_string(F.col("last_name")),
        full_name=full_name(F.col("first_name"), F.col("last_name")),
        phone=clean_phone(F.col("phone")),
        city=clean_string(F.col("city")),
        state=clean_string(F.col("state")),
        country=clean_string(F.col("country")),
        registration_date=clean_date(F.col("registration_date"), lenient_dates),
    )


def clean_api_carts(
    raw: DataFrame,
    order: Column | None = None,
    prices: DataFrame | None = None,
    lenient_dates: bool = False,
) -> DataFrame:
    """One sale per cart item, numbered from 0.

    The feed has no prices, so every item costs `CART_PRICE` unless `prices`
    (source_product_id, price) knows better.
    """
    lines = raw.select(
        "source_id",
        "user_id",
        "cart_date",
        (_unordered() if order is None else order).alias("_order"),
        F.posexplode(F.from_json(F.coalesce("products_json", F.lit("[]")), CART_ITEMS)).alias(
            "idx", "item"
        ),
    ).withColumn("product", F.col("item.productId"))
    unit_price = F.lit(CART_PRICE).cast(WIDE_DECIMAL)
    if prices is not None:
        known = prices.select(F.col("source_product_id").alias("product"), F.col("price"))
        lines = lines.join(known, "product", "left")
        unit_price = F.coalesce(F.col("price").cast(WIDE_DECIMAL), unit_price)
    quantity = clean_integer(F.col("item.quantity"), F.lit(1))
    return _fields(
        lines,
        "api",
        F.col("_order"),
        source_sale_id=F.concat("source_id", F.lit("-"), F.col("idx").cast("string")),
        source_customer_id=F.col("user_id"),
        source_product_id=F.col("product"),
        quantity=quantity,
        unit_price=unit_price,
        total_amount=F.when(quantity != 0, unit_price * quantity).cast(WIDE_DECIMAL),
        sale_date=clean_date(F.col("cart_date"), lenient_dates),
        payment_method=F.lit("api_cart"),
    )


def clean_csv_sales(
    raw: DataFrame, order: Column | None = None, lenient_dates: bool = False
) -> DataFrame:
    return _fields(
        raw,
        "csv",
        order,
        source_sale_id=clean_string(F.col("sale_id")),
        source_customer_id=clean_string(F.col("customer_id")),
        source_product_id=clean_string(F.col("product_id")),
        quantity=clean_integer(F.col("quantity")),
        unit_price=clean_decimal(F.col("unit_price")),
        total_amount=clean_decimal(F.col("total_amount")),
        sale_date=clean_date(F.col("sale_date"), lenient_dates),
        payment_method=clean_string(F.col("payment_method")),
    )


@dataclass(frozen=True)
class Checked:
    """Cleaned records with an `errors` column, and the two halves it splits them into."""

    entity: str
    records: DataFrame

    @property
    def valid(self) -> DataFrame:
        return self.records.filter(F.size("errors") == 0).drop("errors")

    @property
    def rejects(self) -> DataFrame:
        return self.records.filter(F.size("errors") > 0)


def _rules(entity: str, as_of: Column) -> list[Column]:
    c = F.col
    if entity == "products":
        return v.product_rules(c("title"), c("price"), c("cost"), c("rating_rate"))
    if entity == "customers":
        return v.customer_rules(c("email"))
    return v.sale_rules(
        c("quantity"), c("unit_price"), c("total_amount"), c("sale_date"), as_of
    )


def check(cleaned: DataFrame, entity: str, as_of: Column) -> Checked:
    """Apply the entity's rules, and reject what its staging table could not hold."""
    storable = [v.missing_key(F.col(KEYS[entity][0]))]
    storable += [
        v.too_long(F.col(name), name, limit)
        for name, limit in TEXT_LIMITS.items()
        if name in cleaned.columns
    ]
    storable += [
        v.too_large(F.col(name), name, kind)
        for name, kind in STORED.items()
        if name in cleaned.columns
    ]
    errors = v.errors(*_rules(entity, as_of), *storable)
    return Checked(entity, evaluate_once(cleaned, ["*"], errors=errors))


def last_valid(checked: Checked) -> DataFrame:
    """The last valid record of each key, in stored types."""
    valid = last_per_key(checked.valid, KEYS[checked.entity], [PLACE]).drop(PLACE)
    return valid.select(
        *[
            F.col(name).cast(STORED[name]).alias(name) if name in STORED else F.col(name)
            for name in valid.columns
        ]
    )


def stage(current: DataFrame, checked: Checked, now: Column, batch_id: Column) -> DataFrame:
    """The new staging snapshot, with an `action` column."""
    incoming = last_valid(checked)
    keys = KEYS[checked.entity]
    values = [c for c in incoming.columns if c not in keys]
    return upsert(current, incoming, keys, values, now, batch_id)


def reject_reasons(checked: Checked) -> DataFrame:
    """Rejected records per source system and reason, with a bounded sample of keys."""
    key, by = KEYS[checked.entity][0], ["source_system", "rejection_reason"]
    reasons = checked.rejects.select(
        "source_system", key, F.explode("errors.reason").alias("rejection_reason")
    )
    counts = reasons.groupBy(*by).agg(F.count(F.lit(1)).alias("rejection_count"))
    sampled = samples(reasons, by, F.col(key), "sample_values")
    return counts.join(sampled, by, "left").withColumn(
        "sample_values", F.coalesce("sample_values", F.lit("[]"))
    )


def rejected_records(checked: Checked, now: Column, batch_id: Column) -> DataFrame:
    """The refused records as `quality.rejected_records`, whole, with their reasons."""
    values = [c for c in checked.records.columns if c not in ("errors", PLACE)]
    return checked.rejects.select(
        batch_id.alias("batch_id"),
        F.concat("source_system", F.lit(f"_{checked.entity}")).alias("source_name"),
        F.col(KEYS[checked.entity][0]).alias("record_key"),
        F.array_join("errors.reason", "; ").alias("rejection_reasons"),
        F.to_json(F.struct(*values)).alias("record"),
        now.alias("created_at"),
    )
