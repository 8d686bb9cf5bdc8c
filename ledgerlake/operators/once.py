"""Columns that are evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(frame: DataFrame, kept: list[str], **columns: Column) -> DataFrame:
    """`kept` columns of `frame` and new ones that later steps see as plain columns.

    Catalyst copies the definition of a column into every filter it moves below it. For
    rules over cleaned text that means parsing a value dozens of times. A one-row inline
    is not moved across, and stays in generated code.
    """
    fields = [c.alias(name) for name, c in columns.items()]
    return frame.select(*kept, F.inline(F.array(F.struct(*fields))))
