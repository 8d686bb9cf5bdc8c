"""Cleaning of received text, as native column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Unicode counts as white space.
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# Amounts are parsed and validated on this wide type and narrowed when stored.
WIDE_DECIMAL = "decimal(28,10)"

_TIME = r"([01]?\d|2[0-3]):[0-5]?\d:([0-5]?\d|6[01])"
_ISO = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}(T{_TIME}(Z|\.\d{{1,6}})?)?$"
_ISO_MILLIS_ZONE = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}T{_TIME}\.\d{{1,9}}Z$"
_SLASHED = r"^\d{1,2}/\d{1,2}/\d{4}$"


def strip(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def clean_string(c: Column) -> Column:
    """Stripped text; nothing left means NULL."""
    return F.nullif(strip(c), F.lit(""))


def clean_decimal(c: Column, default: Column | None = None) -> Column:
    """Number from text with thousands separators; anything else is `default`."""
    parsed = F.translate(strip(c), ",", "").try_cast(WIDE_DECIMAL)
    return parsed if default is None else F.coalesce(parsed, default.cast(WIDE_DECIMAL))


def clean_integer(c: Column, default: Column | None = None) -> Column:
    """Whole part of a number, cut towards zero; NULL beyond 32 bits."""
    parsed = clean_decimal(c).try_cast("int")
    return parsed if default is None else F.coalesce(parsed, default.cast("int"))


def clean_date(c: Column, lenient: bool = False) -> Column:
    """Date from ISO dates and times, month/day/year, or day/month/year.

    Only the first 25 characters count, so a zone mark after six fraction digits is cut
    off and the value passes, while one after fewer digits makes it NULL. `lenient`
    accepts that form too.
    """
    full = strip(c)
    text = F.substring(full, 1, 25)
    parsed = F.when(text.rlike(_ISO), text.try_cast("date")).when(
        text.rlike(_SLASHED),
        F.coalesce(F.try_to_date(text, "M/d/yyyy"), F.try_to_date(text, "d/M/yyyy")),
    )
    if lenient:
        zoned = F.when(full.rlike(_ISO_MILLIS_ZONE), full.try_cast("date"))
        parsed = F.coalesce(parsed, zoned)
    return parsed


def clean_email(c: Column) -> Column:
    text = F.lower(strip(c))
    return F.when(F.contains(text, F.lit("@")), text)


def clean_phone(c: Column) -> Column:
    """Digits, plus, minus, brackets and white space; NULL when none of them occur."""
    kept = F.regexp_replace(c.cast("string"), r"(?U)[^\d+\-\s()]", "")
    return F.when(kept != "", strip(kept))


def full_name(first: Column, last: Column) -> Column:
    return F.nullif(F.concat_ws(" ", clean_string(first), clean_string(last)), F.lit(""))


# Spellings of the home country, and the region of each state and country.
HOME_COUNTRY = ("usa", "us", "united states")
HOME_REGION = "USA"
STATE_REGIONS = {
    "Northeast": ("ny", "nj", "pa", "ct", "ma", "ri", "vt", "nh", "me"),
    "Southeast": ("fl", "ga", "nc", "sc", "va", "wv", "md", "de", "dc"),
    "Midwest": ("il", "oh", "mi", "in", "wi", "mn", "ia", "mo", "nd", "sd", "ne", "ks"),
    "Southwest": ("tx", "ok", "nm", "az"),
    "West": ("ca", "wa", "or", "nv", "ut", "co", "wy", "mt", "id", "ak", "hi"),
}
COUNTRY_REGIONS = {
    "North America": ("canada", "mexico"),
    "Europe": ("uk", "united kingdom", "germany", "france", "italy", "spain", "netherlands"),
    "Asia Pacific": ("china", "japan", "australia", "india", "singapore"),
    "Latin America": ("brazil", "argentina", "chile", "colombia"),
}
OTHER_REGION = "International"


def region(country: Column, state: Column) -> Column:
    """Sales region; NULL without a country. States count only for the home country."""
    nation, province = F.lower(country), F.lower(state)

    def pick(value: Column, groups: dict[str, tuple[str, ...]], otherwise: str) -> Column:
        chosen = F.lit(otherwise)
        for name, members in groups.items():
            chosen = F.when(value.isin(*members), name).otherwise(chosen)
        return chosen

    return F.when(
        country != "",
        F.when(nation.isin(*HOME_COUNTRY), pick(province, STATE_REGIONS, HOME_REGION)).otherwise(
            pick(nation, COUNTRY_REGIONS, OTHER_REGION)
        ),
    )


# Lowest spend and lowest order count of each customer segment.
SEGMENTS = (("Premium", 1000, 10), ("Regular", 500, 5), ("Occasional", 100, 2))
NEW_SEGMENT = "New"


def customer_segment(spent: Column, orders: Column) -> Column:
    label = F.lit(NEW_SEGMENT)
    for name, least_spent, least_orders in reversed(SEGMENTS):
        label = F.when((spent >= least_spent) | (orders >= least_orders), name).otherwise(label)
    return label
