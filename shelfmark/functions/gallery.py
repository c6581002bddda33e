"""Image lists and first-non-blank attributes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def gallery_clean(images: Column) -> Column:
    """Without inline placeholders and thumbnails, first occurrence kept, order kept."""
    kept = F.filter(
        F.transform(images, strip),
        lambda i: ~F.startswith(i, F.lit("data:")) & ~F.contains(i, F.lit("-150x150")))
    return F.array_distinct(kept)


def gallery_primary(images: Column) -> Column:
    return F.coalesce(F.get(images, F.lit(0)), F.lit(""))


def gallery_join(images: Column, sep: str = ";", distinct: bool = False) -> Column:
    kept = F.filter(F.transform(images, strip), lambda i: i != "")
    return F.array_join(F.array_distinct(kept) if distinct else kept, sep)


def first_non_empty(*candidates: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))
