"""What the operators share: reading tables, row keys, word patterns.

Tables may have any further columns. Only names that begin with `_ll_` are the operators' own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def named(frame: DataFrame, name: str) -> Column:
    """A column by its whole name, even if that has dots in it."""
    return frame["`" + name.replace("`", "``") + "`"]


def text_digest(text: Column) -> Column:
    """128 bits of a text; a null text differs from an empty one.

    With the id it names a row: rows that agree in both are repeated rows.
    """
    return F.coalesce(F.unhex(F.md5(text)), F.lit(b""))
