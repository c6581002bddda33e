"""Extraction from product pages. The checks state what each page was built from."""

from pyspark.sql import functions as F

from ..operators.extract import (
    dispatch, extract, extract_feed, extract_products, failures_of, judge, rejected,
    zero_link_pages,
)
from ..functions.urls import host
from ..plans.crawl import crawl_round
from ..schema import PRODUCT_COLUMNS, PRODUCT_DEFAULTS
from .catalog import query
from .link_queries import _expected
from .views import SHOPS, product_pages

_ID = "cast(page_id as varchar)"
_SIZE3 = "lpad(cast(p_size as varchar), 3, '0')"
_NAME_SLUG = "replace(lower(p_name), ' ', '-')"
_BRAND_SLUG = "replace(lower(p_brand), ' ', '-')"


def _stock(test: str) -> dict[str, str]:
    return {"in_stock": f"case when {test} then 'Yes' else 'No' end",
            "is_active": f"case when {test} then '1' else '0' end"}


_NAMED = {"product_name": "p_name", "seller_product_name": "p_name", "product_slug": _NAME_SLUG}
_BRANDED = {"brand_name": "p_brand", "brand_slug": _BRAND_SLUG}
_ALWAYS = {"in_stock": "'Yes'", "is_active": "'1'"}

# Shop name in the view -> product columns a page was built from.
EXPECTED: dict[str, dict[str, str]] = {
    "ryans": {
        **_NAMED, **_BRANDED, "seller_sku": f"'33.01.' || {_ID}",
        "current_price": f"'1' || {_SIZE3}", "original_price": f"'2' || {_SIZE3}",
        "primary_image_url": f"'https://cdn.example.com/' || {_ID} || '.jpg'",
        "category_name": "'All ' || p_type", "category_slug": "'all-' || lower(p_type)",
        "product_description": "'AlphaBeta'", "review_count": "cast(p_size % 3 as varchar)",
        **_stock("p_size > 10"),
    },
    "startech": {
        "product_name": "p_name", "seller_product_name": "p_name",
        "primary_image_url": f"'https://cdn.example.com/s' || {_ID} || '.jpg'",
        "current_price": f"'1' || {_SIZE3}", "original_price": "'2000'", "category_name": "p_type",
        "review_count": "'Reviews (' || p_size || ')'", "seller_sku": _ID, **_stock("p_size > 10"),
    },
    "lira": {
        "product_name": "p_name || ' & Co'", "seller_product_name": "p_name || ' & Co'",
        "product_slug": f"{_NAME_SLUG} || '-&-co'", **_BRANDED, **_ALWAYS,
        "primary_image_url": "'https://c.example.com/l.jpg'",
        "current_price": f"case when p_size > 10 then '1' || {_SIZE3} else '' end",
        "original_price": "'2000'", "category_name": "p_type", "review_count": "'0'",
        "seller_sku": f"'L' || {_ID}", "product_description": "'OneTwo'",
    },
    "herlan": {
        **_NAMED, **_BRANDED, "primary_image_url": "'https://c.example.com/' || p_size || '.jpg'",
        "image_urls": "'https://c.example.com/' || p_size || '.jpg'",
        "current_price": "case when p_size > 10 then '1500' else '' end", "original_price": "'2000'",
        "category_name": "p_type", "review_count": "'0'", "product_description": "'Infotext'",
        **_stock("p_size % 2 = 0"),
    },
    "kireibd": {
        **_NAMED, "product_slug": f"'item-' || {_ID}", "current_price": f"'1' || {_SIZE3}",
        "original_price": "'2000'",
        "primary_image_url": f"'https://cdn.kireibd.com/storage/all/' || {_ID} || '.png'",
        "brand_name": "p_brand", "brand_slug": "replace(lower(p_brand), '#', '-')",
        "seller_sku": f"'880' || {_ID}", "category_name": "p_type", "category_slug": "lower(p_type)",
        "review_count": "cast(p_size as varchar)", "product_description": "'One Two'",
        **_stock("p_size <= 40"),
    },
    "banglashoppers": {
        **_NAMED, **_BRANDED, **_ALWAYS, "primary_image_url": "'https://c.example.com/1.jpg'",
        "image_urls": "'https://c.example.com/1.jpg;https://c.example.com/2.jpg'",
        "current_price": f"'1' || {_SIZE3}", "original_price": "'2,000'", "category_name": "p_type",
        "review_count": f"'1' || {_SIZE3}", "seller_sku": _ID, "product_description": "'One'",
    },
    "ohsogo": {
        **_NAMED, **_ALWAYS, "current_price": f"'1' || {_SIZE3}",
        "original_price": f"case when p_size > 10 then '2000' else '1' || {_SIZE3} end",
        "primary_image_url": "'https://c.example.com/a.jpg'",
        "image_urls": "'https://c.example.com/a.jpg;https://c.example.com/b.jpg'",
        "seller_rating": "'4.5'", "review_count": "cast(p_size as varchar)",
        "product_description": "'Soft text'", "seller_slug": "'ohsogo'",
    },
    "themallbd": {
        **_NAMED, **_BRANDED,
        "current_price": "case when p_size > 20 then '1800' when p_size > 10 then '' else '2000' end",
        "original_price": "'2000'", "primary_image_url": "'https://c.example.com/7.jpg'",
        "image_urls": "'https://c.example.com/7.jpg;https://c.example.com/8.jpg'",
        "product_description": "'Short'", "seller_slug": "'themallbd'", **_stock("p_size % 2 = 0"),
    },
}

# Other rules over the same markup.
_HERLAN_BROWSER = {
    **_NAMED, **_BRANDED, "current_price": "case when p_size > 10 then '1500' else '2000' end",
    "original_price": "'2000'", "primary_image_url": "'data:image/gif;base64,R0'",
    "image_urls": "'data:image/gif;base64,R0;https://c.example.com/' || p_size "
                  "|| '-150x150.jpg;https://c.example.com/' || p_size || '.jpg'",
    "category_name": "p_type", "category_slug": "lower(p_type)", "product_description": "'Info text'",
    "seller_slug": "'herlan_browser'", **_stock("p_size % 2 = 0"),
}


def product_sql(shop: str, fields: dict[str, str], seller: str | None = None) -> str:
    seller = seller or shop
    fields = {"seller_product_url": "url", "seller_name": f"'{seller}'",
              "base_url": f"'https://{shop}.example.com'", **fields}
    listed = ", ".join(f"{fields.get(c, repr(PRODUCT_DEFAULTS.get(c, '')))} as {c}"
                       for c in PRODUCT_COLUMNS)
    number = {name: n for n, name in SHOPS.items()}[shop]
    return f"select page_id, {listed} from product_pages where shop = {number}"


def pages_of(spark, sf_dir, shop: str):
    return product_pages(spark, sf_dir).filter(host(F.col("url")) == f"{shop}.example.com")


def _register(name: str, shop: str, profile: str, fields: dict[str, str]) -> None:
    @query(name, ("product_pages",), product_sql(shop, fields, profile))
    def run(spark, sf_dir):
        return extract(pages_of(spark, sf_dir, shop), profile, profile, f"https://{shop}.example.com")


for _shop, _fields in EXPECTED.items():
    _register(f"extract_{_shop}", _shop, _shop, _fields)
_register("extract_herlan_browser", "herlan", "herlan_browser", _HERLAN_BROWSER)
_register("extract_herlan_browser_reviews", "herlan", "herlan_browser_reviews", {
    **_HERLAN_BROWSER, "review_count": "'0'", "seller_slug": "'herlan_browser_reviews'"})


@query("extract_feed", ("product_pages",), """
select p_name as title, cast(p_size * 10 as varchar) as sale_price, url as link,
  case when p_size > 10 then '1500' else cast(p_size * 10 as varchar) end as price,
  'https://c.example.com/1.jpg' as primary_image_url, 'https://c.example.com/1.jpg' as image_urls,
  p_size % 2 = 0 as stock, p_brand as brand, 'Desc' as description, '4.2' as rating,
  cast(p_size as varchar) as reviews
from product_pages where shop = 8""")
def _feed(spark, sf_dir):
    """Title, sale price and link come from the listing, the rest from the page."""
    pages = pages_of(spark, sf_dir, "feedshop")
    return extract_feed(pages.select(
        "url", "html", F.col("p_name").alias("title"),
        (F.col("p_size") * 10).cast("string").alias("sale_price")))


@query("catalogue", ("product_pages",),
       "\nunion all\n".join(product_sql(shop, fields) for shop, fields in EXPECTED.items()))
def _catalogue(spark, sf_dir):
    """Products of all shops in one pass over the pages."""
    return extract_products(dispatch(product_pages(spark, sf_dir)))


# The listing shop is mapped to a profile here, the feed shop to none.
_DOMAINS = {f"{name}.example.com": name for name in EXPECTED} | {"listing.example.com": "ryans"}


@query("profile_dispatch", ("product_pages",), """
select page_id, case when shop = 9 then 'ryans' when shop = 8 then null
    else regexp_extract(url, '^https://([^.]*)', 1) end as profile,
  case when shop = 9 then 'Parser returned None' when shop = 8 then 'No parser found' end as reason
from product_pages""")
def _dispatch(spark, sf_dir):
    mapped = dispatch(product_pages(spark, sf_dir), _DOMAINS)
    return judge(mapped).drop("url")


@query("page_failures", ("product_pages",), """
select url, 'No parser found' as reason from product_pages where shop >= 8""")
def _failures(spark, sf_dir):
    return failures_of(judge(dispatch(product_pages(spark, sf_dir))))


@query("rejected_pages", ("product_pages",), """
select url, 'Parser returned None' as reason from product_pages where shop <> 0""")
def _rejected(spark, sf_dir):
    """Every page of all shops, judged by one shop's rule."""
    return rejected(product_pages(spark, sf_dir), "ryans")


@query("zero_link_pages", ("product_pages",), """
select page_id, url, length(html) as size from product_pages
where shop <> 4 and not (shop = 9 and page_id % 40 <> 39)""")
def _zero_links(spark, sf_dir):
    return zero_link_pages(product_pages(spark, sf_dir), "kireibd").select(
        "page_id", "url", F.length("html").cast("bigint").alias("size"))


@query("crawl_round", ("product_pages",), f"""
, targets as ({_expected(resolve=True)})
select 'next' as part, target as url from (select distinct target from targets where profile = 'ryans')
where target not in (select url from product_pages)
union all select 'product', url from product_pages where shop < 8
union all select 'failure', url from product_pages where shop >= 8""")
def _round(spark, sf_dir):
    pages = product_pages(spark, sf_dir)
    done = crawl_round(pages, pages, "example.com", _DOMAINS)
    return (done.next_urls.select(F.lit("next").alias("part"), "url")
            .union(done.products.select(F.lit("product"), "seller_product_url"))
            .union(done.failures.select(F.lit("failure"), "url")))
