"""Queries whose result went through files: written by a sink, read back by a reader."""

from pyspark.sql import functions as F

from ..operators import changes, profiling
from ..operators.extract import zero_link_pages
from ..plans.clean import clean_ryans, conform_feed
from ..schema import FEED_COLUMNS
from ..session import new_folder
from ..sources import readers, sinks
from .catalog import query
from .change_queries import KINDS, LATEST
from .link_queries import _ANCHORS, _anchors
from ..operators.links import absolute_links
from .views import product_pages, view

_PRODUCT_COLUMNS = ["seller_product_url", "product_name", "brand_name", "category_name",
                    "current_price", "original_price", "review_count", "in_stock", "base_url"]


@query("products_csv", ("raw_products",),
       f"select {', '.join(_PRODUCT_COLUMNS)} from raw_products where seller_product_url is not null")
def _products(spark, sf_dir):
    """Export and re-import; a nameless column made by a trailing comma goes."""
    path = new_folder(spark, "products")
    rows = view(spark, sf_dir, "raw_products").select(*_PRODUCT_COLUMNS)
    sinks.export_csv(rows.filter("seller_product_url is not null").withColumn(" ", F.lit("")), path)
    found = readers.read_products(spark, path)
    return found.select(*_PRODUCT_COLUMNS)


@query("swapped_columns_csv", ("raw_products", "price_patch"), """
select 'products' as reader, product_name, current_price, in_stock from raw_products where seller_product_url is not null
union all select 'products', product_name, current_price, null from price_patch
union all select 'patch', product_name, current_price, null from price_patch""")
def _swapped(spark, sf_dir):
    """Files of one folder with other columns in another order come together by name."""
    path, patch = new_folder(spark, "swapped"), new_folder(spark, "patch")
    rows = view(spark, sf_dir, "raw_products").filter("seller_product_url is not null")
    sinks.export_csv(rows.select("product_name", "current_price", "in_stock"), f"{path}/a")
    late = view(spark, sf_dir, "price_patch").select("current_price", "product_name")
    sinks.export_csv(late, f"{path}/b")
    sinks.export_csv(late, patch)
    columns = ["product_name", "current_price"]
    both = readers.read_products(spark, [f"{path}/a", f"{path}/b"])
    return both.select(F.lit("products").alias("reader"), *columns, "in_stock").union(
        readers.read_fixed_patch(spark, patch).select(F.lit("patch"), *columns, F.lit(None)))


@query("file_order", ("crawl_items",),
       "select row_number() over (order by seq) - 1 as position, seq from crawl_items")
def _file_order(spark, sf_dir):
    """Positions of rows in the files of a folder follow the order they were written in."""
    path = new_folder(spark, "ordered")
    rows = view(spark, sf_dir, "crawl_items").select(F.col("seq").cast("string").alias("sku"))
    rows.orderBy(F.col("sku").cast("bigint")).write.option("header", "true").csv(path)
    return readers.read_products(spark, path).select(
        F.col("seq").cast("bigint").alias("position"), F.col("sku").cast("bigint").alias("seq"))


@query("feed_csv", ("vendor_feed",), """
select title, sale_price, link, price, primary_image_url, image_urls, cast(stock as varchar) as stock, brand,
  description, rating, cast(reviews as varchar) as reviews from vendor_feed""")
def _feed(spark, sf_dir):
    """The vendor feed as a file, cells with line breaks included."""
    path = new_folder(spark, "feed")
    feed = view(spark, sf_dir, "vendor_feed").select(
        *[F.col(c).cast("string").alias(c) for c in FEED_COLUMNS])
    # Blanks at the ends of a cell belong to it.
    feed.write.options(header="true", escape='"', ignoreLeadingWhiteSpace="false",
                       ignoreTrailingWhiteSpace="false").csv(path)
    return readers.read_feed(spark, path, multi_line=True).select(*FEED_COLUMNS)


@query("change_log_replay", ("crawl_items",), KINDS + """
select seller_product_url, seq, product_name, current_price, in_stock from kinds where kind <> 'duplicate'
qualify row_number() over (partition by seller_product_url order by seq desc) = 1""")
def _replay(spark, sf_dir):
    """Written versions appended to a log; on reload the last one per URL counts."""
    path = new_folder(spark, "log")
    sinks.append_change_log(changes.classify_change(view(spark, sf_dir, "crawl_items")), path)
    return changes.latest_per_url(spark.read.parquet(path)).select(
        "seller_product_url", "seq", "product_name", "current_price", "in_stock")


@query("snapshot_csv", ("crawl_items",), f"""
select seller_product_url, trim(product_name) as product_name, nullif(current_price, '') as current_price from ({LATEST})""")
def _snapshot(spark, sf_dir):
    path = new_folder(spark, "snapshot-csv")
    latest = changes.latest_per_url(view(spark, sf_dir, "crawl_items"))
    sinks.export_csv(changes.as_snapshot(latest), path)
    return readers.read_products(spark, path).select(
        "seller_product_url", F.trim("product_name").alias("product_name"),
        F.nullif("current_price", F.lit("")).alias("current_price"))


@query("url_list_csv", (), f"with {_ANCHORS} select distinct url from absolute")
def _url_list(spark, sf_dir):
    path = new_folder(spark, "urls")
    sinks.write_url_list(absolute_links(_anchors(spark, sf_dir)), path)
    return readers.read_url_list(spark, path)


@query("link_pairs_csv", (), f"""with {_ANCHORS}
select distinct source_url, url as product_url from absolute""")
def _link_pairs(spark, sf_dir):
    path = new_folder(spark, "pairs")
    found = absolute_links(_anchors(spark, sf_dir))
    sinks.write_link_pairs(found.withColumnRenamed("url", "product_url"), path)
    return spark.read.option("header", "true").csv(path)


@query("entrypoints_csv", ("url_list",), """
select 'named' as reader, url from url_list where trim(url) <> ''
union all select 'headerless', url from url_list where trim(url) <> '' and lower(url) <> 'url'
union all select 'listed', url from url_list where trim(url) <> ''""")
def _entrypoints(spark, sf_dir):
    path = new_folder(spark, "entrypoints")
    sinks.export_csv(view(spark, sf_dir, "url_list").select("url", F.lit("x").alias("note")), path)
    start = "https://start.example.com/"
    named = readers.read_entrypoints(spark, path, start).filter(F.trim("url") != "")
    plain = readers.read_entrypoints_headerless(spark, path)
    listed = readers.read_url_list(spark, path)
    return (named.select(F.lit("named").alias("reader"), "url")
            .union(plain.select(F.lit("headerless"), "url"))
            .union(listed.select(F.lit("listed"), "url")))


@query("cleaned_csv", ("raw_products",), """
, kept as (select * from raw_products
  qualify row_number() over (partition by seller_product_url order by seq desc) = 1)
select coalesce(regexp_extract(seller_product_url, 'https://([^.]*)', 1), 'none') as seller_name,
  seq, seller_product_url from kept""")
def _cleaned(spark, sf_dir):
    """One folder per seller; the seller is read back from the folder names."""
    path = new_folder(spark, "cleaned")
    seller = F.coalesce(F.regexp_extract("seller_product_url", "https://([^.]*)", 1), F.lit("none"))
    sinks.write_cleaned(clean_ryans(view(spark, sf_dir, "raw_products")).withColumn(
        "seller_name", seller), path)
    return spark.read.options(header="true", escape='"', multiLine="true").csv(path).select(
        "seller_name", F.col("seq").cast("bigint").alias("seq"), "seller_product_url")


@query("chunk_files", ("raw_products",), """
, numbered as (select seq, row_number() over (order by seq) as i from raw_products
  qualify row_number() over (partition by seller_product_url order by seq desc) = 1)
select (i - 1) // 2500 + 1 as part, count(*) as n, min(seq) as first_seq, max(seq) as last_seq
from (select seq, row_number() over (order by seq) as i from numbered) group by all""")
def _chunk_files(spark, sf_dir):
    path = new_folder(spark, "chunks")
    sinks.write_chunks(clean_ryans(view(spark, sf_dir, "raw_products")), path)
    rows = spark.read.options(header="true", escape='"', multiLine="true").csv(path)
    seq = F.col("seq").cast("bigint")
    return rows.groupBy(F.col("part").cast("bigint").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))


@query("brand_review_csv", ("vendor_feed",), """
select brand as brand_name, title as seller_product_name, link as seller_product_url from vendor_feed
qualify row_number() over (partition by coalesce(brand, '') order by seq) <= 2""")
def _brand_review(spark, sf_dir):
    path = new_folder(spark, "brand-review")
    sample = profiling.brand_sample(conform_feed(view(spark, sf_dir, "vendor_feed"), "Arogga"))
    sinks.write_brand_review(sample, path)
    return spark.read.options(header="true", escape='"', ignoreLeadingWhiteSpace="false",
                              ignoreTrailingWhiteSpace="false").csv(path).select(
        F.nullif("brand_name", F.lit("")).alias("brand_name"), "seller_product_name", "seller_product_url")


@query("failures_log", ("failure_lines",), r"""
select strptime(regexp_extract(line, '^\[([^\]]*)\]', 1), '%Y-%m-%d %H:%M:%S') as ts,
  regexp_extract(line, '\]\s+(\S+)', 1) as url,
  trim(regexp_extract(line, '\|\s+(.*)$', 1)) || coalesce(chr(10) || more, '') || chr(10) || 'stack trace' as reason
from (
  select min_by(line, seq) as line,
    string_agg(case when not starts_with(line, '[') then line end, chr(10) order by seq) as more
  from (select *, sum(case when starts_with(line, '[') then 1 else 0 end) over (order by seq) as entry from failure_lines)
  where entry > 0 group by entry)""")
def _failures(spark, sf_dir):
    """Reasons over two lines come back whole."""
    path = new_folder(spark, "failures")
    failures = readers.parse_failures(view(spark, sf_dir, "failure_lines"))
    sinks.append_failures(failures.withColumn(
        "reason", F.concat("reason", F.lit("\nstack trace"))), path)
    return readers.read_failures(spark, path)


@query("quarantine", ("product_pages",), """
select page_id, url from product_pages where shop <> 4 and not (shop = 9 and page_id % 40 <> 39)""")
def _quarantine(spark, sf_dir):
    path = new_folder(spark, "quarantine")
    sinks.quarantine_pages(zero_link_pages(product_pages(spark, sf_dir), "kireibd"), path)
    return spark.read.parquet(path).select("page_id", "url")
