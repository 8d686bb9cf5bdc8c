"""Received records to raw tables, and the latest batch back out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLACE = {"file_name": "_file_name", "line_number": "_line_number"}
_FILE = {"raw_line": "_raw_line", **_PLACE}

# Raw columns of the CSV sources, named as in the files.
CSV_COLUMNS = {
    "csv_products": [
        "product_id", "product_name", "category", "price", "cost", "stock_quantity", "supplier",
    ],
    "csv_customers": [
        "customer_id", "first_name", "last_name", "email", "phone", "city", "state", "country",
        "registration_date",
    ],
    "csv_sales": [
        "sale_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
        "sale_date", "payment_method",
    ],
}


def _picked(frame: DataFrame, columns: dict[str, str]) -> list[Column]:
    """Columns under new names; one that the frame lacks is NULL."""
    present = set(frame.columns)
    kinds = {"line_number": "bigint"}
    return [
        (F.col(given) if given in present else F.lit(None).cast(kinds.get(name, "string"))).alias(name)
        for name, given in columns.items()
    ]


def _record(frame: DataFrame) -> Column:
    """The record as JSON text, without what this library or the parser added."""
    return F.to_json(F.struct(*[c for c in frame.columns if not c.startswith("_")]))


def flatten_products(frame: DataFrame) -> DataFrame:
    return frame.select(
        F.col("id").alias("source_id"),
        "title",
        "price",
        "description",
        "category",
        F.col("image").alias("image_url"),
        F.col("rating.rate").alias("rating_rate"),
        F.col("rating.count").alias("rating_count"),
        _record(frame).alias("raw_json"),
        *_picked(frame, _PLACE),
    )


def flatten_users(frame: DataFrame) -> DataFrame:
    return frame.select(
        F.col("id").alias("source_id"),
        "email",
        "username",
        "name.firstname",
        "name.lastname",
        "address.city",
        "address.street",
        "address.zipcode",
        "phone",
        _record(frame).alias("raw_json"),
        *_picked(frame, _PLACE),
    )


def flatten_carts(frame: DataFrame) -> DataFrame:
    items = F.to_json(F.col("products"))
    return frame.select(
        F.col("id").alias("source_id"),
        F.col("userId").alias("user_id"),
        F.col("date").alias("cart_date"),
        F.coalesce(items, F.lit("[]")).alias("products_json"),
        _record(frame).alias("raw_json"),
        *_picked(frame, _PLACE),
    )


def csv_record(frame: DataFrame, source: str) -> DataFrame:
    """The raw columns of a CSV source; a column the file lacks is NULL."""
    names = {name: name for name in CSV_COLUMNS[source]}
    return frame.select(*_picked(frame, {**names, **_FILE}))


FLATTENERS = {
    "api_products": flatten_products,
    "api_users": flatten_users,
    "api_carts": flatten_carts,
}


def to_raw(frame: DataFrame, source: str, batch_id: str, ingested_at: Column) -> DataFrame:
    """Shape extracted records for `raw.<source>` and stamp them."""
    shaped = FLATTENERS[source](frame) if source in FLATTENERS else csv_record(frame, source)
    return shaped.select(
        "*",
        ingested_at.alias("ingested_at"),
        F.lit(source).alias("source_name"),
        F.lit(batch_id).alias("batch_id"),
    )


def latest_batch(frame: DataFrame) -> DataFrame:
    """Rows of the batch that was ingested last.

    The batch is found by an aggregate and compared as a scalar, so on a table that is
    partitioned by `batch_id` only that partition is read.
    """
    newest = frame.agg(F.max_by("batch_id", F.struct("ingested_at", "batch_id"))).scalar()
    return frame.filter(F.col("batch_id") == newest)
