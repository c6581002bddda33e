"""Stock and activity flags."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def stock_flag(c: Column, marker: str, ignore_case: bool = False) -> Column:
    """``Yes`` when the text carries the marker, else ``No``."""
    text = F.coalesce(c, F.lit(""))
    if ignore_case:
        text, marker = F.lower(text), marker.lower()
    return F.when(F.contains(text, F.lit(marker)), F.lit("Yes")).otherwise(F.lit("No"))


def stock_unless(c: Column, marker: str) -> Column:
    """``No`` when the text carries the marker, in any case, else ``Yes``."""
    found = F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(marker.lower()))
    return F.when(found, F.lit("No")).otherwise(F.lit("Yes"))


def active_flag(in_stock: Column) -> Column:
    return F.when(F.lower(in_stock) == "yes", F.lit("1")).otherwise(F.lit("0"))


def zero_price_out_of_stock(current: Column, original: Column, in_stock: Column) -> Column:
    return F.when((current == 0) | (original == 0), F.lit("NO")).otherwise(in_stock)
