"""Fields that follow from other fields."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import active_flag
from ..functions.text import blank, slug_trim


def derived_fields(field) -> dict[str, Column]:
    """Slugs and status, filled only where blank. ``field`` gives the column of a name."""
    def slug_of(slug: str, name: str) -> Column:
        return F.when(blank(field(slug)) & ~blank(field(name)), slug_trim(field(name))
                      ).otherwise(field(slug))

    product_slug = slug_of("product_slug", "product_name")
    variant = ~blank(field("variation_type")) & blank(field("parent_product_slug"))
    return {
        "product_slug": product_slug,
        "brand_slug": slug_of("brand_slug", "brand_name"),
        "category_slug": slug_of("category_slug", "category_name"),
        "seller_slug": slug_of("seller_slug", "seller_name"),
        "parent_product_slug": F.when(variant, F.coalesce(product_slug, F.lit(""))
                                      ).otherwise(field("parent_product_slug")),
        "is_active": F.when(blank(field("is_active")) & ~blank(field("in_stock")),
                            active_flag(field("in_stock"))).otherwise(field("is_active")),
    }


def auto_derive(df: DataFrame) -> DataFrame:
    return df.withColumns(derived_fields(F.col))
