"""Calendar attributes as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The range of the calendar unless a job asks for another one.
FIRST_DAY = date(2020, 1, 1)
LAST_DAY = date(2030, 12, 31)


@dataclass(frozen=True)
class Holiday:
    """A day that recurs every year: a fixed one, the nth weekday of a month (1 is Sunday, and a
    negative n counts from the end), or so many days from Easter Sunday.
    """

    name: str
    month: int | None = None
    day: int | None = None
    weekday: int | None = None
    nth: int | None = None
    from_easter: int | None = None

    def falls_on(self, day: Column) -> Column:
        if self.from_easter is not None:
            return F.date_diff(day, easter(F.year(day))) == self.from_easter
        same_month = F.month(day) == self.month
        if self.day is not None:
            return same_month & (F.dayofmonth(day) == self.day)
        place = F.dayofmonth(day) if self.nth > 0 else F.date_diff(F.last_day(day), day) + 1
        return same_month & (F.dayofweek(day) == self.weekday) & (F.ceil(place / 7) == abs(self.nth))


# Public holidays of the United States, and two of Easter.
HOLIDAYS = (
    Holiday("New Year's Day", month=1, day=1),
    Holiday("Martin Luther King Day", month=1, weekday=2, nth=3),
    Holiday("Presidents' Day", month=2, weekday=2, nth=3),
    Holiday("Good Friday", from_easter=-2),
    Holiday("Easter Monday", from_easter=1),
    Holiday("Memorial Day", month=5, weekday=2, nth=-1),
    Holiday("Independence Day", month=7, day=4),
    Holiday("Labor Day", month=9, weekday=2, nth=1),
    Holiday("Columbus Day", month=10, weekday=2, nth=2),
    Holiday("Veterans Day", month=11, day=11),
    Holiday("Thanksgiving", month=11, weekday=5, nth=4),
    Holiday("Christmas Day", month=12, day=25),
)


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year, by the anonymous computus."""
    golden, century, rest = year % 19, F.floor(year / 100), year % 100
    leap, correction = F.floor(century / 4), F.floor((century + 8) / 25)
    moon = F.pmod(19 * golden + century - leap - F.floor((century - correction + 1) / 3) + 15, F.lit(30))
    weekday = F.pmod(32 + 2 * (century % 4) + 2 * F.floor(rest / 4) - moon - rest % 4, F.lit(7))
    shift = F.floor((golden + 11 * moon + 22 * weekday) / 451)
    days = moon + weekday - 7 * shift + 114
    return F.make_date(year, F.floor(days / 31).cast("int"), (days % 31 + 1).cast("int"))


def is_holiday(day: Column, holidays: Sequence[Holiday]) -> Column:
    return reduce(Column.__or__, [h.falls_on(day) for h in holidays], F.lit(False))


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def week_of_year(day: Column) -> Column:
    """Week number where week 1 holds 1 January and weeks start on Sunday (not ISO)."""
    first = F.dayofweek(F.trunc(day, "YEAR"))
    return F.floor((F.dayofyear(day) + first - 2) / 7).cast("int") + 1


def dim_date(
    spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY, holidays: Sequence[Holiday] = ()
) -> DataFrame:
    """One row per day. Its size is fixed by the two dates, so Spark can plan on it.

    No day is a holiday unless `holidays` says so.
    """
    days = spark.range((last - first).days + 1, numPartitions=1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date")
    )
    return _described(days, holidays)


def calendar_of(days: DataFrame, day: Column, holidays: Sequence[Holiday] = ()) -> DataFrame:
    """One row per day from the first to the last one that `days` has."""
    bounds = days.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    every = F.sequence("first", "last", F.expr("interval 1 day"))
    return _described(bounds.where("first IS NOT NULL").select(F.explode(every).alias("full_date")), holidays)


def _described(days: DataFrame, holidays: Sequence[Holiday]) -> DataFrame:
    day = F.col("full_date")
    month = F.month(day)
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        week_of_year(day).alias("week_of_year"),
        month.alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_name"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        is_holiday(day, holidays).alias("is_holiday"),
        (F.year(day) + (month >= 7).cast("int")).alias("fiscal_year"),
        (F.pmod(F.quarter(day) + 1, F.lit(4)) + 1).alias("fiscal_quarter"),
    )
