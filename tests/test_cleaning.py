from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import cleaning as c
from ledgerlake.functions.calendar import date_key, dim_date

V = "v"


def test_strings_are_stripped_of_all_white_space(evaluate):
    given = ["  a b ", "\t\nx\r  ", "", " \t ", None, "123"]
    assert evaluate(c.clean_string(F.col(V)), given) == ["a b", "x", None, None, None, "123"]


def test_numbers_become_text(evaluate):
    assert evaluate(c.clean_string(F.col(V)), [123], "int") == ["123"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("99.99", "99.99"),
        ("100", "100"),
        (" 1,234.56 ", "1234.56"),
        ("1,2,3", "123"),
        ("1e3", "1000"),
        ("-5", "-5"),
        ("+.5", "0.5"),
        ("abc", None),
        ("$5", None),
        ("99.9d", None),
        ("", None),
        (None, None),
        ("NaN", None),
        ("Infinity", None),
    ],
)
def test_decimals(evaluate, text, expected):
    [found] = evaluate(c.clean_decimal(F.col(V)), [text])
    assert found == (None if expected is None else Decimal(expected))


def test_decimal_default(evaluate):
    found = evaluate(c.clean_decimal(F.col(V), F.lit("0")), ["abc", None, "2"])
    assert found == [Decimal(0), Decimal(0), Decimal(2)]


def test_integers_are_cut_towards_zero(evaluate):
    given = ["100", "1,000", "99.9", "-1.9", "1e2", "abc", None, "99.9d", "inf", "3000000000"]
    expected = [100, 1000, 99, -1, 100, None, None, None, None, None]
    assert evaluate(c.clean_integer(F.col(V)), given) == expected
    assert evaluate(c.clean_integer(F.col(V), F.lit(1)), ["x", "2"]) == [1, 2]


DATES = {
    "2024-01-15": date(2024, 1, 15),
    "2024-1-5": date(2024, 1, 5),
    " 2024-01-15\n": date(2024, 1, 15),
    "2024-01-15T10:30:00": date(2024, 1, 15),
    "2024-01-15T10:30:00Z": date(2024, 1, 15),
    "2024-01-15T10:30:00.123456": date(2024, 1, 15),
    "2024-01-15T10:30:00.123456Z": date(2024, 1, 15),
    "2024-01-15T10:30:00.123456789Z": date(2024, 1, 15),
    "2020-03-02T00:00:00.000Z": None,
    "2024-01-15T10:30:00+00:00": None,
    "2024-01-15 10:30:00": None,
    "20240115": None,
    "03/04/2024": date(2024, 3, 4),
    "25/12/2024": date(2024, 12, 25),
    "2024-13-01": None,
    "2024-02-30": None,
    "2024-01-15T25:00:00": None,
    "not-a-date": None,
    "": None,
    None: None,
}


def test_dates(evaluate):
    assert evaluate(c.clean_date(F.col(V)), list(DATES)) == list(DATES.values())


def test_lenient_dates_accept_a_zone_after_a_fraction(evaluate):
    given = ["2020-03-02T00:00:00.000Z", "2024-02-30T00:00:00.000Z", "x"]
    assert evaluate(c.clean_date(F.col(V), lenient=True), given) == [date(2020, 3, 2), None, None]


def test_date_values_pass_through(evaluate):
    assert evaluate(c.clean_date(F.col(V)), [date(2024, 1, 15)], "date") == [date(2024, 1, 15)]


def test_emails(evaluate):
    given = [" Someone@Example.COM ", "no at sign", None]
    assert evaluate(c.clean_email(F.col(V)), given) == ["someone@example.com", None, None]


def test_phones(evaluate):
    given = ["+1-555-0101", "(555) 123 4567 ext", "none", "a b", None]
    expected = ["+1-555-0101", "(555) 123 4567", None, "", None]
    assert evaluate(c.clean_phone(F.col(V)), given) == expected


def test_full_names(spark):
    rows = [("Ann", "Lee"), ("Ann", None), (" ", "Lee"), (None, "")]
    frame = spark.createDataFrame(rows, "a string, b string")
    found = [r[0] for r in frame.select(c.full_name(F.col("a"), F.col("b"))).collect()]
    assert found == ["Ann Lee", "Ann", "Lee", None]


def test_regions(spark):
    expected = {
        ("USA", "NY"): "Northeast",
        ("us", "fl"): "Southeast",
        ("United States", "IL"): "Midwest",
        ("USA", "TX"): "Southwest",
        ("USA", "ca"): "West",
        ("USA", "KY"): "USA",
        ("USA", None): "USA",
        ("USA", ""): "USA",
        ("Canada", "NY"): "North America",
        ("Germany", None): "Europe",
        ("Japan", None): "Asia Pacific",
        ("Brazil", None): "Latin America",
        (" Germany", None): "International",
        ("Atlantis", None): "International",
        ("", "NY"): None,
        (None, "NY"): None,
    }
    frame = spark.createDataFrame(list(expected), "country string, state string")
    found = frame.select(c.region(F.col("country"), F.col("state"))).collect()
    assert [r[0] for r in found] == list(expected.values())


def test_segments(spark):
    expected = {
        (1000, 5): "Premium",
        (500, 10): "Premium",
        (500, 3): "Regular",
        (300, 5): "Regular",
        (100, 1): "Occasional",
        (50, 2): "Occasional",
        (150, 1): "Occasional",
        (50, 1): "New",
        (0, 0): "New",
    }
    frame = spark.createDataFrame(list(expected), "spent int, orders int")
    found = frame.select(c.customer_segment(F.col("spent"), F.col("orders"))).collect()
    assert [r[0] for r in found] == list(expected.values())


def test_date_keys(evaluate):
    assert evaluate(date_key(F.col(V)), [date(2024, 1, 15), None], "date") == [20240115, None]


def test_calendar_covers_its_default_range(spark):
    days = dim_date(spark)
    assert days.count() == 4018
    first = days.filter("date_key = 20240107").first().asDict()
    # A Sunday: the second week by the calendar that starts weeks on Sunday.
    assert (first["day_of_week"], first["week_of_year"], first["is_weekend"]) == (1, 2, True)
    july = days.filter("date_key = 20240701").first()
    assert (july["fiscal_year"], july["fiscal_quarter"], july["quarter_name"]) == (2025, 1, "Q3")
    june = days.filter("date_key = 20240630").first()
    assert (june["fiscal_year"], june["fiscal_quarter"], june["month_short"]) == (2024, 4, "Jun")
