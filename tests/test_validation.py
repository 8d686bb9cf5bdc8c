from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import validation as v

TODAY = date(2024, 3, 1)
SALE = "quantity int, unit_price decimal(28,10), total_amount decimal(28,10), sale_date date"


def messages(frame, rules):
    return [r[0] for r in frame.select(v.errors(*rules)["message"]).collect()]


def sale_errors(spark, *row):
    frame = spark.createDataFrame([row], SALE)
    columns = [F.col(n) for n in ("quantity", "unit_price", "total_amount", "sale_date")]
    [found] = messages(frame, v.sale_rules(*columns, F.lit(TODAY)))
    return found


def test_a_good_sale_passes(spark):
    assert sale_errors(spark, 2, D("50"), D("100"), date(2024, 1, 1)) == []


def test_total_may_be_off_by_one_per_cent(spark):
    assert sale_errors(spark, 2, D("50"), D("101"), date(2024, 1, 1)) == []
    found = sale_errors(spark, 2, D("50"), D("101.01"), date(2024, 1, 1))
    assert found == ["total_amount (101.01) doesn't match quantity * unit_price (100)"]


def test_missing_values_do_not_hide_other_errors(spark):
    assert sale_errors(spark, None, D("50"), D("0"), None) == [
        "quantity cannot be null or empty",
        "total_amount must be positive, got 0",
        "sale_date cannot be null or empty",
    ]


def test_negative_sales_never_match(spark):
    found = sale_errors(spark, -2, D("50"), D("-100"), date(2024, 1, 1))
    assert found[0] == "quantity must be positive, got -2"
    assert found[-1].startswith("total_amount (-100) doesn't match")


def test_future_sales(spark):
    assert sale_errors(spark, 1, D("5"), D("5"), TODAY) == []
    found = sale_errors(spark, 1, D("5"), D("5"), date(2024, 3, 2))
    assert found == ["sale_date cannot be in the future: 2024-03-02"]


PRODUCT = "title string, price decimal(28,10), cost decimal(28,10), rating_rate decimal(28,10)"


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        (("Cup", D("5.50"), D("2"), D("4.5")), []),
        (("Cup", D("0.001"), None, None), []),
        ((None, D("5"), None, None), ["title cannot be null or empty"]),
        (("Cup", None, None, None), ["price cannot be null or empty"]),
        (("Cup", D("-10"), None, None), ["price must be positive, got -10"]),
        (("Cup", D("5"), D("-0.5"), None), ["cost cannot be negative, got -0.5"]),
        (("Cup", D("5"), None, D("6")), ["rating_rate must be between 0 and 5, got 6"]),
        (("Cup", D("5"), None, D("5")), []),
    ],
)
def test_products(spark, row, expected):
    columns = [F.col(n) for n in ("title", "price", "cost", "rating_rate")]
    frame = spark.createDataFrame([row], PRODUCT)
    assert messages(frame, v.product_rules(*columns)) == [expected]


def test_a_broken_email_rejects_a_customer(spark):
    frame = spark.createDataFrame(
        [("a@b.co",), ("a.b+c@x-y.org",), ("user@host",), (None,)], "email string"
    )
    found = messages(frame, v.customer_rules(F.col("email")))
    assert found == [[], [], ["email is not a valid email: user@host"], []]


def test_rules_on_text(evaluate):
    head = v.valid_date(F.col("v"), "day")["reason"]
    given = ["2024-01-15", "2024-01-15T99", "2024-13-01", "soon", None]
    bad = "day is not a valid date"
    assert evaluate(head, given) == [None, None, bad, bad, None]
    blank = v.not_blank(F.col("v"), "x")["reason"].isNotNull()
    assert evaluate(blank, ["a", " ", "", None]) == [False, True, True, True]
    number = v.is_number(F.col("v"), "x")["reason"].isNotNull()
    assert evaluate(number, ["1", "x", None]) == [False, True, True]


def test_values_the_tables_cannot_hold(spark):
    frame = spark.createDataFrame([("x" * 51, D("100000000"))], "k string, price decimal(28,10)")
    rules = [
        v.too_long(F.col("k"), "k", 50),
        v.too_large(F.col("price"), "price", "decimal(10,2)"),
        v.missing_key(F.lit(None).cast("string")),
    ]
    assert messages(frame, rules) == [["k out_of_range", "price out_of_range", "missing_key"]]
