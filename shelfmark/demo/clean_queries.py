"""Cleaning chains and deduplication."""

from pyspark.sql import functions as F

from ..functions.brands import BRAND_DENYLIST, CORPORATE_WORDS, TITLE_WORDS
from ..functions import brands
from ..operators import dedup
from ..plans.clean import clean_feed, clean_ryans, clean_startech, conform_feed
from ..schema import PRODUCT_COLUMNS
from .catalog import query
from .views import view


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def price_sql(c: str) -> str:
    cleaned = f"trim(replace(replace(replace({c}, '৳', ''), 'Tk', ''), ',', ''))"
    return f"case when regexp_matches({cleaned}, '{NUMBER}') then try_cast({cleaned} as double) end"


def slug_sql(c: str) -> str:
    return rf"lower(replace(regexp_replace({c}, '[^\p{{L}}\p{{N}}\s]', '', 'g'), ' ', '-'))"


def first_word_sql(c: str) -> str:
    return f"nullif(regexp_extract({c}, '([^\\s]+)', 1), '')"


def denylist_brand_sql(brand: str, name: str) -> str:
    return (f"case when {brand} is null or {brand} in ({quoted(BRAND_DENYLIST)})"
            f" then coalesce({first_word_sql(name)}, {brand}) else {brand} end")


def fixed_brand_sql(brand: str, name: str) -> str:
    corporate = "|".join(CORPORATE_WORDS)
    title = f"regexp_replace(trim({name}), '^Buy\\s+[0-9]+\\s+', '', 'i')"
    words = f"regexp_extract_all({title}, '[^\\s]+')"
    first = f"regexp_replace({words}[1], '[,:-]$', '')"
    second = f"regexp_replace({words}[2], '[,:-]$', '')"
    return f"""case when lower(trim(coalesce({brand}, ''))) in ('nan', 'no brand', '', ',')
        or regexp_matches(lower(coalesce({brand}, '')), '\\b(?:{corporate})\\b')
      then case when coalesce(trim({title}), '') = '' then 'Unknown'
                when lower({first}) in ({quoted(TITLE_WORDS)}) and {words}[2] is not null
                then {first} || ' ' || {second} else {first} end
      else trim({brand}) end"""


@query("clean_ryans", ("raw_products",), f"""
, last_rows as (
  select * from raw_products
  qualify row_number() over (partition by seller_product_url order by seq desc) = 1),
named as (
  select *, case when starts_with(category_name, 'All') then trim(substr(category_name, 4))
                 else category_name end as category,
    coalesce({price_sql('current_price')}, 0) as cp, coalesce({price_sql('original_price')}, 0) as op,
    {denylist_brand_sql('brand_name', 'product_name')} as brand
  from last_rows)
select seq, seller_product_url, product_name, review_count, base_url, variation_type,
  coalesce(category, 'Uncategorized') as category_name,
  coalesce({slug_sql('category')}, 'uncategorized') as category_slug, 'ryans' as seller_slug,
  cp as current_price, op as original_price,
  case when cp = 0 or op = 0 then 'NO' else in_stock end as in_stock,
  brand as brand_name, {slug_sql('brand')} as brand_slug
from named""")
def _clean_ryans(spark, sf_dir):
    return clean_ryans(view(spark, sf_dir, "raw_products"))


@query("clean_startech", ("raw_products", "price_patch"), f"""
, base as (
  select * from raw_products
  qualify row_number() over (partition by seller_product_url order by seq) = 1),
both_crawls as (
  select 0 as src, * replace ({price_sql('current_price')} as current_price,
                              {price_sql('original_price')} as original_price)
  from base where product_name is not null
  union all by name
  select 1 as src, * replace ({price_sql('current_price')} as current_price,
                              {price_sql('original_price')} as original_price)
  from price_patch),
merged as (
  select *, case when length(category_name) > 18 then 'Accessories' else category_name end as category,
    {first_word_sql('product_name')} as brand
  from both_crawls
  qualify row_number() over (partition by seller_product_url order by src desc, seq desc) = 1)
select src, seq, seller_product_url, product_name, in_stock, variation_type,
  brand as brand_name, lower(brand) as brand_slug, category as category_name,
  replace(replace(lower(category), ' ', '-'), '&', 'and') as category_slug,
  coalesce(current_price, 0) as current_price, coalesce(original_price, 0) as original_price,
  coalesce(cast(nullif(regexp_extract(review_count, '([0-9]+)', 1), '') as bigint), 0) as review_count,
  regexp_replace(base_url, '/[^/]*$', '') as base_url, 'star-tech' as seller_slug,
  split_part(split_part(seller_product_url, '/', -1), '?', 1) as product_slug
from merged""")
def _clean_startech(spark, sf_dir):
    return clean_startech(view(spark, sf_dir, "raw_products"), view(spark, sf_dir, "price_patch"))


_STOCK = (f"(case when regexp_matches(stock, '{NUMBER}') then try_cast(trim(stock) as double)"
          " when lower(trim(stock)) = 'true' then 1.0 else 0.0 end)")
_CONFORMED = {
    "product_name": "title", "product_slug": slug_sql("coalesce(title, '')"),
    "product_description": "trim(replace(coalesce(description, ''), chr(10), ' '))",
    "seller_product_name": "title", "current_price": "sale_price", "original_price": "price",
    "seller_product_url": "link", "brand_name": "coalesce(brand, '')",
    "category_name": "'Uncategorized'", "category_slug": "'uncategorized'",
    "primary_image_url": "coalesce(primary_image_url, '')",
    "image_urls": "trim(replace(coalesce(image_urls, ''), chr(10), ' '))",
    "review_count": "cast(coalesce(reviews, 0) as bigint)",
    "stock_quantity": f"cast({_STOCK} as bigint)",
    "in_stock": f"{_STOCK} > 0", "is_active": f"{_STOCK} > 0",
    "seller_name": "'Arogga'", "seller_rating": "rating", "seller_slug": "'arogga'",
    "base_url": "regexp_extract(link, '^([a-z]+):', 1) || '://' "
                "|| regexp_extract(link, '^[a-z]+://([^/?#]*)', 1) || '/'",
    "currency": "'BDT'", "seller_country_code": "'BD'",
}


def _conformed_sql(**replaced: str) -> str:
    columns = {**_CONFORMED, **replaced}
    listed = ", ".join(f"{columns.get(c, 'cast(null as varchar)')} as {c}" for c in PRODUCT_COLUMNS)
    return f"select seq, {listed} from vendor_feed"


@query("conform_feed", ("vendor_feed",), _conformed_sql())
def _conform_feed(spark, sf_dir):
    return conform_feed(view(spark, sf_dir, "vendor_feed"), "Arogga")


@query("clean_feed", ("vendor_feed",), _conformed_sql(
    brand_name=fixed_brand_sql("brand", "title"),
    brand_slug=slug_sql("(" + fixed_brand_sql("brand", "title") + ")")))
def _clean_feed(spark, sf_dir):
    return clean_feed(view(spark, sf_dir, "vendor_feed"))


@query("dedup_first", ("raw_products",), """
select * from raw_products
qualify row_number() over (partition by seller_product_url order by seq) = 1""")
def _dedup_first(spark, sf_dir):
    return dedup.dedup_keep_first(view(spark, sf_dir, "raw_products"))


@query("dedup_last", ("raw_products",), """
select * from raw_products
qualify row_number() over (partition by seller_product_url order by seq desc) = 1""")
def _dedup_last(spark, sf_dir):
    return dedup.dedup_keep_last(view(spark, sf_dir, "raw_products"))


@query("patch_merge", ("raw_products", "price_patch"), """
select * from (select 0 as src, * from raw_products union all by name select 1 as src, * from price_patch)
qualify row_number() over (partition by seller_product_url order by src desc, seq desc) = 1""")
def _patch_merge(spark, sf_dir):
    return dedup.patch_merge(view(spark, sf_dir, "raw_products"), view(spark, sf_dir, "price_patch"))


@query("brand_fix", ("vendor_feed",),
       f"select seq, {fixed_brand_sql('brand', 'title')} as fixed from vendor_feed")
def _brand_fix(spark, sf_dir):
    return view(spark, sf_dir, "vendor_feed").select(
        "seq", brands.fix_brand_name(F.col("brand"), F.col("title")).alias("fixed"))


@query("brand_denylist", ("raw_products",), f"""
select seq, brand_name, {denylist_brand_sql('brand_name', 'product_name')} as repaired
from raw_products""")
def _brand_denylist(spark, sf_dir):
    return view(spark, sf_dir, "raw_products").select(
        "seq", "brand_name", brands.brand_from_denylist(
            F.col("brand_name"), F.col("product_name")).alias("repaired"))
