"""Measures shared by the marts, views and quality reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def profit(total: Column, cost: Column) -> Column:
    """Summed sales less summed cost; unknown cost counts as nothing."""
    return F.sum(total) - F.coalesce(F.sum(cost), F.lit(0))


def ratio(total: Column, n: Column, result: str) -> Column:
    """`total / n` rounded half up once, from 18 exact decimals; NULL when n is 0."""
    return F.try_divide(total, n.cast("decimal(20,0)")).cast(result)


def percentage(part: Column, whole: Column) -> Column:
    """Share in per cent as decimal(5,2); 100 when there is nothing to measure."""
    share = F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)"))
    return F.when(whole == 0, F.lit(100)).otherwise(share).cast("decimal(5,2)")


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed between two timestamps."""

    def second(moment: Column) -> Column:
        return F.unix_timestamp(F.date_trunc("second", moment.cast("timestamp")))

    return second(end) - second(start)
