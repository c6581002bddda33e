"""Strings: whitespace, slugs, tokens and the change-comparison form."""

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that counts as white space for stripping and word splitting
# (29 of them; SQL trim alone only knows U+0020).
WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())
SPACE_CLASS = "".join(f"\\x{{{ord(ch):x}}}" for ch in WHITESPACE)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def lower_hyphen(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def slug_basic(c: Column) -> Column:
    """Lower case with a hyphen per space."""
    return lower_hyphen(c)


def slug_trim(c: Column) -> Column:
    """As ``slug_basic`` on the stripped text; NULL gives ``''``."""
    return F.coalesce(lower_hyphen(strip(c)), F.lit(""))


def slug_alnum(c: Column) -> Column:
    """Letters, digits and white space only, then hyphens and lower case."""
    kept = F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}{SPACE_CLASS}]", "")
    return lower_hyphen(kept)


def slug_amp(c: Column) -> Column:
    return F.replace(lower_hyphen(c), F.lit("&"), F.lit("and"))


def normalize_value(c: Column) -> Column:
    """The form in which two observations of a field are compared."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def strip_lines(c: Column) -> Column:
    return strip(F.replace(c, F.lit("\n"), F.lit(" ")))


def first_word(c: Column) -> Column:
    """First run of non-space characters; NULL when there is none."""
    return F.nullif(F.regexp_extract(c, rf"([^{SPACE_CLASS}]+)", 1), F.lit(""))


def nth_token(c: Column, sep: str, k: int) -> Column:
    """Token ``k`` (0-based) after splitting on ``sep``; the whole text if there is none."""
    return F.coalesce(F.get(F.split(c, f"\\Q{sep}\\E"), F.lit(k)), c)


def drop_all_prefix(c: Column) -> Column:
    """Cuts a leading ``All`` (also out of ``Allergy``, as the category rule asks)."""
    return F.when(F.startswith(c, F.lit("All")), strip(F.substring(c, 4, 2147483647))).otherwise(c)


def long_category_to_accessories(c: Column, longest: int = 18) -> Column:
    return F.when(F.length(c) > longest, F.lit("Accessories")).otherwise(c)


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""
