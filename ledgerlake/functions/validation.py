"""Validation rules as column expressions.

A rule is one column holding NULL (passed) or a struct of a short reason, which has few
distinct values and is safe to group by, and a message that quotes the rejected value.
Rules take cleaned, typed columns unless they say that they take text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.cleaning import WIDE_DECIMAL, strip

# The accepted form of an e-mail address and the tolerated total mismatch.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
TOTAL_TOLERANCE = "0.01"


def _error(reason: str, value: Column | None = None, joint: str = ": ") -> Column:
    message = F.lit(reason)
    if value is not None:
        message = F.concat(message, F.lit(joint), F.coalesce(value, F.lit("NULL")))
    return F.struct(F.lit(reason).alias("reason"), message.alias("message"))


def shown(value: Column) -> Column:
    """A number as text without padding zeros."""
    cut = F.regexp_replace(value.cast("string"), r"(\.\d*?)0+$", "$1")
    return F.regexp_replace(cut, r"\.$", "")


def not_null(value: Column, name: str) -> Column:
    return F.when(value.isNull(), _error(f"{name} cannot be null or empty"))


def not_blank(text: Column, name: str) -> Column:
    return F.when(
        text.isNull() | (strip(text) == ""), _error(f"{name} cannot be null or empty")
    )


def is_number(text: Column, name: str) -> Column:
    """For text that was not cleaned; a cleaned number is one or NULL."""
    broken = text.try_cast(WIDE_DECIMAL).isNull()
    return F.when(broken, _error(f"{name} is not a valid number", text))


def positive(number: Column, name: str) -> Column:
    return F.when(number <= 0, _error(f"{name} must be positive", shown(number), ", got "))


def non_negative(number: Column, name: str) -> Column:
    return F.when(number < 0, _error(f"{name} cannot be negative", shown(number), ", got "))


def in_range(number: Column, name: str, low: int, high: int) -> Column:
    reason = f"{name} must be between {low} and {high}"
    return F.when(~number.between(low, high), _error(reason, shown(number), ", got "))


def valid_email(value: Column, name: str) -> Column:
    return F.when(~value.rlike(EMAIL_PATTERN), _error(f"{name} is not a valid email", value))


def as_date(text: Column) -> Column:
    """The date in the first ten characters, or NULL."""
    head = F.substring(text, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), head.try_cast("date"))


def valid_date(text: Column, name: str) -> Column:
    """For text that was not cleaned; a cleaned date is one or NULL."""
    broken = text.isNotNull() & as_date(text).isNull()
    return F.when(broken, _error(f"{name} is not a valid date", text))


def not_future(day: Column, name: str, as_of: Column) -> Column:
    return F.when(
        day > as_of, _error(f"{name} cannot be in the future", day.cast("string"))
    )


def total_matches(quantity: Column, unit_price: Column, total: Column) -> Column:
    """Total within one per cent of quantity times price. A negative product never is."""
    expected = quantity * unit_price
    off = F.abs(total - expected) > expected * F.lit(TOTAL_TOLERANCE).cast("decimal(3,2)")
    message = F.concat(
        F.lit("total_amount ("),
        shown(total),
        F.lit(") doesn't match quantity * unit_price ("),
        shown(expected),
        F.lit(")"),
    )
    return F.when(
        off,
        F.struct(
            F.lit("total_amount doesn't match quantity * unit_price").alias("reason"),
            message.alias("message"),
        ),
    )


def missing_key(*keys: Column) -> Column:
    """A record without its natural key cannot be stored."""
    blank = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    return F.when(blank, _error("missing_key"))


def too_long(value: Column, name: str, limit: int) -> Column:
    return F.when(F.length(value) > limit, _error(f"{name} out_of_range"))


def too_large(value: Column, name: str, stored: str) -> Column:
    over = value.isNotNull() & value.try_cast(stored).isNull()
    return F.when(over, _error(f"{name} out_of_range"))


def first_of(*rules: Column) -> Column:
    """The first broken rule of several on one field."""
    return F.coalesce(*rules)


def errors(*rules: Column) -> Column:
    """All broken rules of a record, in order."""
    return F.array_compact(F.array(*rules))


def product_rules(title, price, cost, rating_rate) -> list[Column]:
    return [
        not_null(title, "title"),
        first_of(not_null(price, "price"), positive(price, "price")),
        non_negative(cost, "cost"),
        in_range(rating_rate, "rating_rate", 0, 5),
    ]


def customer_rules(email, registration_date=None) -> list[Column]:
    """An email that is not empty has to be one, and so has a registration date that is given as
    text. Cleaned dates need no rule: cleaning leaves a date or NULL, and both pass.
    """
    rules = [F.when(email != "", valid_email(email, "email"))]
    if registration_date is not None:
        name = "registration_date"
        rules.append(F.when(registration_date != "", valid_date(registration_date, name)))
    return rules


def sale_rules(quantity, unit_price, total, sale_date, as_of) -> list[Column]:
    amounts = {"quantity": quantity, "unit_price": unit_price, "total_amount": total}
    return [first_of(not_null(c, n), positive(c, n)) for n, c in amounts.items()] + [
        first_of(not_null(sale_date, "sale_date"), not_future(sale_date, "sale_date", as_of)),
        total_matches(quantity, unit_price, total),
    ]
