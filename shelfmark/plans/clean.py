"""Cleaning chains. Each is lazy: one deduplication shuffle, everything else narrow."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import brands, flags, prices, text, urls
from ..operators.dedup import dedup_keep_first, dedup_keep_last, patch_merge
from ..operators.profiling import StageCounts
from ..schema import fill_missing_columns


def _no_watch(df: DataFrame, stage: str) -> DataFrame:
    return df


def _numeric_prices(df: DataFrame) -> DataFrame:
    return df.withColumns({
        c: prices.to_number(prices.clean_price(F.col(c)))
        for c in ("current_price", "original_price")})


def clean_startech(products: DataFrame, patch: DataFrame, seller_slug: str = "star-tech",
                   counts: StageCounts | None = None) -> DataFrame:
    """First row per URL, named rows only, overridden by the patch, then standardised.

    The patch is cleaned like the base. ``(src, seq)`` orders the result.
    """
    watch = counts.watch if counts else _no_watch
    base = watch(dedup_keep_first(products), "dedup")
    base = watch(base.filter(F.col("product_name").isNotNull()), "named")
    merged = watch(patch_merge(_numeric_prices(base), _numeric_prices(patch)), "patched")
    brand = brands.first_word_brand(F.col("product_name"))
    category = text.long_category_to_accessories(F.col("category_name"))
    return merged.withColumns({
        "current_price": prices.fill_zero(F.col("current_price")),
        "original_price": prices.fill_zero(F.col("original_price")),
        "base_url": urls.strip_last_path(F.col("base_url")),
        "seller_slug": F.lit(seller_slug),
        "category_name": category,
        "category_slug": text.slug_amp(category),
        "product_slug": urls.url_last_segment(F.col("seller_product_url")),
        "brand_name": brand,
        "brand_slug": F.lower(brand),
        "review_count": prices.first_int(F.col("review_count")),
    })


def clean_ryans(products: DataFrame, seller_slug: str = "ryans",
                counts: StageCounts | None = None) -> DataFrame:
    """Last row per URL, categories, prices with stock, brands. Serves sellers alike."""
    watch = counts.watch if counts else _no_watch
    rows = watch(_numeric_prices(dedup_keep_last(products)), "dedup")
    category = text.drop_all_prefix(F.col("category_name"))
    current = prices.fill_zero(F.col("current_price"))
    original = prices.fill_zero(F.col("original_price"))
    brand = brands.brand_from_denylist(F.col("brand_name"), F.col("product_name"))
    return rows.withColumns({
        "category_name": F.coalesce(category, F.lit("Uncategorized")),
        "category_slug": F.coalesce(text.slug_alnum(category), F.lit("uncategorized")),
        "seller_slug": F.lit(seller_slug),
        "current_price": current,
        "original_price": original,
        "in_stock": flags.zero_price_out_of_stock(current, original, F.col("in_stock")),
        "brand_name": brand,
        "brand_slug": text.slug_alnum(brand),
    })


def conform_feed(feed: DataFrame, seller_name: str) -> DataFrame:
    """The 11 feed columns as product rows; ``seq`` is kept in front."""
    def filled(c: str):
        return F.coalesce(F.col(c), F.lit(""))

    # A number, or true and false as 1 and 0.
    stock = F.col("stock").cast("string")
    stock = F.coalesce(prices.to_number(stock), stock.try_cast("boolean").cast("double"), F.lit(0.0))
    on_sale = stock > 0
    rows = feed.select(
        "seq",
        F.col("title").alias("product_name"),
        text.slug_alnum(filled("title")).alias("product_slug"),
        text.strip_lines(filled("description")).alias("product_description"),
        F.col("title").alias("seller_product_name"),
        F.col("sale_price").alias("current_price"),
        F.col("price").alias("original_price"),
        F.col("link").alias("seller_product_url"),
        filled("brand").alias("brand_name"),
        F.lit("Uncategorized").alias("category_name"),
        F.lit("uncategorized").alias("category_slug"),
        filled("primary_image_url").alias("primary_image_url"),
        text.strip_lines(filled("image_urls")).alias("image_urls"),
        prices.cast_count(F.col("reviews")).alias("review_count"),
        prices.cast_count(stock).alias("stock_quantity"),
        on_sale.alias("in_stock"),
        on_sale.alias("is_active"),
        F.lit(seller_name).alias("seller_name"),
        F.col("rating").alias("seller_rating"),
        text.slug_alnum(F.lit(seller_name)).alias("seller_slug"),
        urls.base_url(F.col("link")).alias("base_url"),
        F.lit("BDT").alias("currency"),
        F.lit("BD").alias("seller_country_code"),
    )
    return fill_missing_columns(rows, ("seq",))


def clean_feed(feed: DataFrame, seller_name: str = "Arogga") -> DataFrame:
    """Conformed feed with repaired brands. Rows are not deduplicated."""
    rows = conform_feed(feed, seller_name)
    brand = brands.fix_brand_name(F.col("brand_name"), F.col("seller_product_name"))
    return rows.withColumns({"brand_name": brand, "brand_slug": text.slug_alnum(brand)})
