"""Column contracts of the tables that pass between the stages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The product columns, in file order.
PRODUCT_COLUMNS = [
    "category_slug", "product_name", "product_slug", "seller_slug", "current_price",
    "seller_product_url", "brand_slug", "brand_name", "product_description", "model",
    "sku", "primary_image_url", "image_urls", "specifications", "attributes",
    "variation_type", "parent_product_slug", "original_price", "currency", "in_stock",
    "stock_quantity", "seller_rating", "review_count", "shipping_cost", "free_shipping",
    "estimated_delivery_days", "seller_sku", "seller_product_name", "category_path",
    "category_name", "category_description", "seller_name", "base_url",
    "seller_country_code", "is_active",
]

# The only columns whose template default is not blank.
PRODUCT_DEFAULTS = {"currency": "BDT", "seller_country_code": "BD"}

# The vendor feed columns, in file order.
FEED_COLUMNS = [
    "title", "sale_price", "link", "price", "primary_image_url", "image_urls", "stock",
    "brand", "description", "rating", "reviews",
]


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_PRODUCT = strings(PRODUCT_COLUMNS)
RAW_FEED = strings(FEED_COLUMNS)
ENTRYPOINTS = strings(["url"])
LINK_PAIRS = strings(["source_url", "product_url"])
PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
SNAPSHOT_COLUMNS = (
    ["seller_product_url"]
    + [c for c in PRODUCT_COLUMNS if c != "seller_product_url"]
    + ["last_updated"]
)


def fill_missing_columns(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the product columns, in order; absent ones become NULL.

    ``extra`` names bookkeeping columns (``seq`` and the like) kept in front.
    """
    present = set(df.columns)
    return df.select(
        *[F.col(c) for c in extra if c in present],
        *[F.col(c) if c in present else F.lit(None).cast("string").alias(c)
          for c in PRODUCT_COLUMNS],
    )


def project_fields(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Drops every column that is not a product column; absent ones stay absent."""
    present = set(df.columns)
    return df.select(*[c for c in extra if c in present],
                     *[c for c in PRODUCT_COLUMNS if c in present])


def template_row(fields: dict[str, Column]) -> list[Column]:
    """One product row from extracted fields, the template default elsewhere."""
    unknown = set(fields) - set(PRODUCT_COLUMNS)
    if unknown:
        raise ValueError(f"not product columns: {sorted(unknown)}")
    defaults = {v: F.lit(v) for v in ("", *PRODUCT_DEFAULTS.values())}
    row = []
    for c in PRODUCT_COLUMNS:
        default = defaults[PRODUCT_DEFAULTS.get(c, "")]
        row.append((F.coalesce(fields[c], default) if c in fields else default).alias(c))
    return row


def template_defaults(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """All product columns, NULL replaced by the template default."""
    present = set(df.columns)
    return df.select(
        *[c for c in extra if c in present],
        *template_row({c: F.col(c) for c in PRODUCT_COLUMNS if c in present}),
    )
