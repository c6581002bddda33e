"""Prices, counts and numbers in text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_PLAIN_DIGITS = r"^([0-9]+[.]?[0-9]*|[.][0-9]+)$"


def without(c: Column, *parts: str) -> Column:
    for part in parts:
        c = F.replace(c, F.lit(part), F.lit(""))
    return c


def clean_price(c: Column, *symbols: str) -> Column:
    """Drops the currency marks (all known ones by default) and thousands commas."""
    return strip(without(c, *(symbols or ("৳", "Tk")), ","))


def cut_prefix(c: Column, n: int = 3) -> Column:
    return F.substring(c, n + 1, 2147483647)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def mrp_or_sale(mrp: Column, sale: Column) -> Column:
    """Digits of the list price, or the sale price when it has none."""
    return F.coalesce(F.nullif(digits_only(mrp), F.lit("")), sale)


def to_number(c: Column) -> Column:
    """Double, NULL for anything that is not a plain decimal or exponent number."""
    return F.when(F.rlike(c, F.lit(_NUMBER)), strip(c).try_cast("double"))


def fill_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def is_invalid_price(c: Column) -> Column:
    """Present, but not digits with at most one point. NULL counts as valid."""
    return c.isNotNull() & ~F.rlike(c, F.lit(_PLAIN_DIGITS))


def first_int(c: Column) -> Column:
    """First run of digits as a number, 0 when there is none."""
    return F.coalesce(
        F.nullif(F.regexp_extract(c, "([0-9]+)", 1), F.lit("")).try_cast("bigint"), F.lit(0))


def first_int_text(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, "([0-9]+)", 1), F.lit("")), F.lit("0"))


def cast_count(c: Column) -> Column:
    """Whole number of a count cell (``12``, ``12.0``, a boolean); 0 if it is none."""
    return F.coalesce(c.try_cast("double").try_cast("bigint"), F.lit(0))


def _at(prices: Column, k: int) -> Column:
    return F.coalesce(F.get(prices, F.lit(k)), F.lit(""))


# Each pair rule returns (current, original) from the price texts of a page.

def pair_second(prices: Column) -> tuple[Column, Column]:
    """Second entry is current; a single price leaves current blank."""
    return _at(prices, 1), _at(prices, 0)


def pair_fallback(prices: Column) -> tuple[Column, Column]:
    """As ``pair_second``, but a single price is both."""
    current = F.when(F.size(prices) >= 2, _at(prices, 1)).otherwise(_at(prices, 0))
    return current, _at(prices, 0)


def pair_reversed(prices: Column) -> tuple[Column, Column]:
    """First entry is current; a single price is both."""
    original = F.when(F.size(prices) >= 2, _at(prices, 1)).otherwise(_at(prices, 0))
    return _at(prices, 0), original


def triple(prices: Column) -> tuple[Column, Column]:
    """Third entry is current; exactly two leave it blank, a single price is both."""
    current = F.when(F.size(prices) >= 2, _at(prices, 2)).otherwise(_at(prices, 0))
    return current, _at(prices, 0)
