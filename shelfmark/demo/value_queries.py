"""Scalar rules over whole tables."""

from pyspark.sql import functions as F

from ..functions import flags, gallery, prices, text, urls
from ..operators.derive import auto_derive
from ..schema import project_fields, template_defaults
from .catalog import query
from .clean_queries import price_sql, slug_sql
from .views import product_pages, table, view


@query("slug_variants", ("raw_products",), f"""
select seq, replace(lower(product_name), ' ', '-') as basic,
  coalesce(replace(trim(lower(product_name)), ' ', '-'), '') as trimmed,
  {slug_sql('product_name')} as alnum,
  replace(replace(lower(category_name), ' ', '-'), '&', 'and') as amp,
  case when starts_with(category_name, 'All') then trim(substr(category_name, 4)) else category_name end as without_all,
  case when length(category_name) > 18 then 'Accessories' else category_name end as short_category
from raw_products""")
def _slugs(spark, sf_dir):
    name, category = F.col("product_name"), F.col("category_name")
    return view(spark, sf_dir, "raw_products").select(
        "seq", text.slug_basic(name).alias("basic"), text.slug_trim(name).alias("trimmed"),
        text.slug_alnum(name).alias("alnum"), text.slug_amp(category).alias("amp"),
        text.drop_all_prefix(category).alias("without_all"),
        text.long_category_to_accessories(category).alias("short_category"))


@query("url_functions", (), r"""
select page_id, split_part(split_part(url, '/', -1), '?', 1) as last_segment,
  split_part(url, '/', -1) as last_with_query,
  regexp_replace(url, '/[^/]*$', '') as parent,
  regexp_extract(url, '^([a-z]+):', 1) || '://' || regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || '/' as base,
  regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host,
  regexp_extract(url, '^[^?#]*') as canonical,
  regexp_extract(url, 'ref=([^&]+)', 1) as ref,
  case when contains(url, 'page=') then split_part(url, 'page=', -1) end as after_page,
  case when regexp_matches(split_part(url, '#', 1), '[?&]page=')
       then regexp_replace(split_part(url, '#', 1), '([?&])page=[^&]*', '\1page=' || (page_id + 1))
       else split_part(url, '#', 1) || case when contains(split_part(url, '#', 1), '?') then '&' else '?' end
            || 'page=' || (page_id + 1) end || regexp_extract(url, '#.*') as next_page
from pages""")
def _urls(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.url_last_segment(u).alias("last_segment"),
        urls.url_last_segment(u, cut_query=False).alias("last_with_query"),
        urls.strip_last_path(u).alias("parent"), urls.base_url(u).alias("base"),
        urls.host(u).alias("host"), urls.canonical_url(u).alias("canonical"),
        urls.query_param(u, "ref").alias("ref"), urls.after_token(u, "page=").alias("after_page"),
        urls.next_page_url(u, F.col("page_id")).alias("next_page"))


_ENTRIES = "list_filter(string_split(prices, '|'), lambda p: trim(p) <> '')"
_CLEAN = f"list_transform({_ENTRIES}, lambda p: trim(replace(replace(p, '৳', ''), ',', '')))"


@query("price_rules", ("price_cells",), f"""
, cells as (select *, {_CLEAN} as p from price_cells)
select seq, coalesce(p[2], '') as second_current, coalesce(p[1], '') as second_original,
  case when len(p) >= 2 then p[2] else coalesce(p[1], '') end as fallback_current,
  coalesce(p[1], '') as fallback_original,
  coalesce(p[1], '') as reversed_current,
  case when len(p) >= 2 then p[2] else coalesce(p[1], '') end as reversed_original,
  case when len(p) >= 2 then coalesce(p[3], '') else coalesce(p[1], '') end as triple_current,
  coalesce(p[1], '') as triple_original,
  substr(trim(replace(replace(prefixed_price, 'Tk', ''), ',', '')), 4) as cut_current,
  substr(prefixed_price, 4) as cut_original,
  coalesce(nullif(regexp_replace(mrp_text, '[^0-9]', '', 'g'), ''), sale_price) as mrp
from cells""")
def _prices(spark, sf_dir):
    entries = F.filter(F.split("prices", "[|]"), lambda p: F.trim(p) != "")
    cells = view(spark, sf_dir, "price_cells").withColumn(
        "p", F.transform(entries, lambda c: prices.clean_price(c, "৳")))
    p = F.col("p")
    columns = []
    for name, rule in (("second", prices.pair_second), ("fallback", prices.pair_fallback),
                       ("reversed", prices.pair_reversed), ("triple", prices.triple)):
        current, original = rule(p)
        columns += [current.alias(f"{name}_current"), original.alias(f"{name}_original")]
    return cells.select(
        "seq", *columns,
        prices.cut_prefix(prices.clean_price(F.col("prefixed_price"), "Tk")).alias("cut_current"),
        prices.cut_prefix(F.col("prefixed_price")).alias("cut_original"),
        prices.mrp_or_sale(F.col("mrp_text"), F.col("sale_price")).alias("mrp"))


@query("price_numbers", ("raw_products",), f"""
select seq, {price_sql('current_price')} as current_number,
  coalesce({price_sql('original_price')}, 0) as original_or_zero,
  current_price is not null and not regexp_matches(current_price, '^([0-9]+[.]?[0-9]*|[.][0-9]+)$') as invalid,
  case when coalesce({price_sql('current_price')}, 0) = 0 or coalesce({price_sql('original_price')}, 0) = 0
       then 'NO' else in_stock end as stock
from raw_products""")
def _numbers(spark, sf_dir):
    current = prices.to_number(prices.clean_price(F.col("current_price")))
    original = prices.fill_zero(prices.to_number(prices.clean_price(F.col("original_price"))))
    return view(spark, sf_dir, "raw_products").select(
        "seq", current.alias("current_number"), original.alias("original_or_zero"),
        prices.is_invalid_price(F.col("current_price")).alias("invalid"),
        flags.zero_price_out_of_stock(
            prices.fill_zero(current), original, F.col("in_stock")).alias("stock"))


@query("review_rules", ("raw_products",), """
select seq, coalesce(cast(nullif(regexp_extract(review_count, '([0-9]+)', 1), '') as bigint), 0) as first_number,
  coalesce(nullif(regexp_extract(review_count, '([0-9]+)', 1), ''), '0') as first_text,
  regexp_replace(current_price, '[^0-9]', '', 'g') as joined,
  coalesce(string_split(product_name, ' ')[3], product_name) as third_token,
  nullif(regexp_extract(product_name, '([^\\s]+)', 1), '') as first_word
from raw_products""")
def _reviews(spark, sf_dir):
    review = F.col("review_count")
    return view(spark, sf_dir, "raw_products").select(
        "seq", prices.first_int(review).alias("first_number"),
        prices.first_int_text(review).alias("first_text"),
        prices.digits_only(F.col("current_price")).alias("joined"),
        text.nth_token(F.col("product_name"), " ", 2).alias("third_token"),
        text.first_word(F.col("product_name")).alias("first_word"))


def _flag_sql(test: str) -> str:
    return f"case when {test} then 'Yes' else 'No' end"


@query("stock_flags", ("product_pages",), f"""
select page_id, {_flag_sql("contains(html, 'InStock')")} as schema_link,
  {_flag_sql("contains(html, 'In Stock')")} as cell,
  {_flag_sql("contains(html, 'In stock')")} as paragraph,
  {_flag_sql("contains(html, 'Add to Cart')")} as button,
  {_flag_sql("contains(lower(html), 'in stock')")} as any_case,
  {_flag_sql("not contains(lower(html), 'out of stock')")} as unless_sold_out,
  case when contains(lower(html), 'out of stock') then '0' else '1' end as active
from product_pages""")
def _stock(spark, sf_dir):
    html = F.col("html")
    unless = flags.stock_unless(html, "out of stock")
    return product_pages(spark, sf_dir).select(
        "page_id", flags.stock_flag(html, "InStock").alias("schema_link"),
        flags.stock_flag(html, "In Stock").alias("cell"),
        flags.stock_flag(html, "In stock").alias("paragraph"),
        flags.stock_flag(html, "Add to Cart").alias("button"),
        flags.stock_flag(html, "in stock", ignore_case=True).alias("any_case"),
        unless.alias("unless_sold_out"), flags.active_flag(unless).alias("active"))


_SLUG = "replace(trim(lower({0})), ' ', '-')"


@query("auto_derive", ("raw_products",), f"""
select seq, coalesce(product_name, '') as product_name,
  coalesce({_SLUG.format('product_name')}, '') as product_slug,
  coalesce({_SLUG.format('brand_name')}, '') as brand_slug,
  coalesce({_SLUG.format('category_name')}, '') as category_slug,
  'my-shop' as seller_slug,
  case when variation_type <> '' then coalesce({_SLUG.format('product_name')}, '') else '' end as parent_product_slug,
  case when lower(in_stock) = 'yes' then '1' else '0' end as is_active,
  'BDT' as currency, 'BD' as seller_country_code, '' as sku
from raw_products""")
def _derive(spark, sf_dir):
    rows = view(spark, sf_dir, "raw_products").withColumn("seller_name", F.lit("My Shop"))
    return auto_derive(template_defaults(rows, ("seq",))).select(
        "seq", "product_name", "product_slug", "brand_slug", "category_slug", "seller_slug",
        "parent_product_slug", "is_active", "currency", "seller_country_code", "sku")


@query("project_fields", ("crawl_items",),
       "select seq, product_name, current_price, seller_product_url, in_stock, seller_name from crawl_items")
def _project(spark, sf_dir):
    """The crawl time is not a product column and goes."""
    return project_fields(view(spark, sf_dir, "crawl_items"), ("seq",))


@query("normalized_values", ("crawl_items",), """
select seq, coalesce(trim(product_name), '') as product_name, coalesce(trim(current_price), '') as current_price
from crawl_items""")
def _normalized(spark, sf_dir):
    return view(spark, sf_dir, "crawl_items").select(
        "seq", *[text.normalize_value(F.col(c)).alias(c) for c in ("product_name", "current_price")])


_IMAGES = "list_transform(string_split(imgs, '|'), lambda i: trim(i))"
_KEPT = (f"list_filter({_IMAGES}, lambda i: not starts_with(i, 'data:') and not contains(i, '-150x150'))")


@query("gallery", ("gallery_cells",), f"""
, kept as (select seq, imgs, {_KEPT} as k, list_filter({_IMAGES}, lambda i: i <> '') as all_images from gallery_cells),
firsts as (select *, list_filter(k, lambda x, i: list_position(k, x) = i) as d,
  list_filter(all_images, lambda x, i: list_position(all_images, x) = i) as da from kept)
select seq, array_to_string(d, ';') as cleaned, coalesce(d[1], '') as main,
  array_to_string(all_images, ';') as joined, array_to_string(da, chr(10)) as distinct_lines,
  trim(split_part(imgs, '|', 3)) as first_given
from firsts""")
def _gallery(spark, sf_dir):
    images = F.split("imgs", "[|]")
    cleaned = gallery.gallery_clean(images)
    return view(spark, sf_dir, "gallery_cells").select(
        "seq", F.array_join(cleaned, ";").alias("cleaned"),
        gallery.gallery_primary(cleaned).alias("main"),
        gallery.gallery_join(images).alias("joined"),
        gallery.gallery_join(images, "\n", distinct=True).alias("distinct_lines"),
        gallery.first_non_empty(F.lit(""), F.lit(None).cast("string"),
                                text.strip(images[2])).alias("first_given"))
