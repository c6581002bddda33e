"""Counts, profiles and audits."""

from pyspark.sql import functions as F

from ..functions.brands import BRAND_DENYLIST
from ..operators import profiling
from ..operators.dedup import dedup_keep_last
from ..operators.profiling import StageCounts
from ..plans.clean import clean_startech, conform_feed
from ..session import new_folder
from ..sources import sinks
from ..sources.readers import parse_failures
from ..sources.sinks import with_chunk
from .catalog import query
from .clean_queries import quoted
from .views import table, view


@query("value_counts", ("raw_products",), """
select 'category_name' as col, category_name as value, count(*) as n from raw_products where category_name is not null group by all
union all select 'brand_name', brand_name, count(*) from raw_products where brand_name is not null group by all
union all select 'in_stock', in_stock, count(*) from raw_products where in_stock is not null group by all""")
def _value_counts(spark, sf_dir):
    rows = view(spark, sf_dir, "raw_products")
    out = None
    for c in ("category_name", "brand_name", "in_stock"):
        counts = profiling.value_counts(rows, c).select(F.lit(c).alias("col"), "value", "n")
        out = counts if out is None else out.union(counts)
    return out


@query("nunique", ("raw_products",), """
select count(distinct seller_product_url) as seller_product_url, count(distinct category_name) as category_name,
  count(distinct base_url) as base_url from raw_products""")
def _nunique(spark, sf_dir):
    return profiling.nunique(view(spark, sf_dir, "raw_products"),
                             ["seller_product_url", "category_name", "base_url"])


@query("nunique_approximate", ("raw_products",), """
select count(distinct seller_product_url) as exact_urls, count(distinct category_name) as exact_categories,
  true as urls_close, true as categories_close from raw_products""")
def _approximate(spark, sf_dir):
    """A sketch, compared with the exact number: within three standard errors of 5 %."""
    rows, columns = view(spark, sf_dir, "raw_products"), ["seller_product_url", "category_name"]
    exact, rough = (profiling.nunique(rows, columns, approximate=a) for a in (False, True))
    both = exact.toDF("exact_urls", "exact_categories").join(F.broadcast(rough.toDF("u", "c")))

    def close(a: str, b: str):
        return F.abs(F.col(a) - F.col(b)) <= 0.15 * F.col(b)

    return both.withColumns({"urls_close": close("u", "exact_urls"),
                             "categories_close": close("c", "exact_categories")}).drop("u", "c")


@query("nunique_sketches", ("raw_products",), """
select count(distinct seller_product_url) as exact_urls, count(distinct category_name) as exact_categories,
  true as urls_close, true as categories_close from raw_products""")
def _sketches(spark, sf_dir):
    """Sketches of four batches, one of them repeated, united and compared with the exact number:
    within three standard errors of 1.6 %."""
    rows, columns = view(spark, sf_dir, "raw_products"), ["seller_product_url", "category_name"]
    folder = new_folder(spark, "sketches")
    for batch in (0, 1, 2, 3, 2):
        part = rows.filter(F.floor(F.col("seq") / 10) % 4 == batch)
        sinks.write_sketches(profiling.distinct_sketches(part, columns), folder, batch)
    rough = profiling.united_nunique(spark.read.parquet(folder), columns).toDF("u", "c")
    exact = profiling.nunique(rows, columns).toDF("exact_urls", "exact_categories")

    def close(a: str, b: str):
        return F.abs(F.col(a) - F.col(b)) <= 0.05 * F.col(b)

    return exact.join(F.broadcast(rough)).withColumns({
        "urls_close": close("u", "exact_urls"), "categories_close": close("c", "exact_categories")}).drop("u", "c")


_PROFILED = ["seq", "seller_product_url", "product_name", "brand_name", "category_name",
             "current_price", "original_price", "review_count", "in_stock", "base_url", "variation_type"]


@query("column_profile", ("raw_products",), "\nunion all\n".join(
    f"select '{c}' as column_name, '{'bigint' if c == 'seq' else 'string'}' as data_type, "
    f"count({c}) as non_null, count(*) as total_rows from raw_products" for c in _PROFILED))
def _column_profile(spark, sf_dir):
    return profiling.column_profile(view(spark, sf_dir, "raw_products"))


@query("stage_counts", ("raw_products", "price_patch"), """
, base as (select * from raw_products
  qualify row_number() over (partition by seller_product_url order by seq) = 1),
named as (select * from base where product_name is not null)
select 'dedup' as stage, count(*) as n from base
union all select 'named', count(*) from named
union all select 'patched', count(distinct u) from (
  select coalesce(seller_product_url, '-') as u from named
  union all select coalesce(seller_product_url, '-') from price_patch)""")
def _stage_counts(spark, sf_dir):
    """Counts taken while the cleaning chain runs, without jobs of their own."""
    counts = StageCounts()
    cleaned = clean_startech(view(spark, sf_dir, "raw_products"),
                             view(spark, sf_dir, "price_patch"), counts=counts)
    cleaned.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(counts.values().items()), "stage string, n bigint")


@query("run_summary", ("url_list", "crawl_items"), """
, done as (select distinct seller_product_url as url from crawl_items),
marked as (select case when trim(url) = '' or url = 'URL' then 'failed' when done.url is not null then 'skipped' else 'scraped' end as outcome,
  coalesce(nullif(regexp_extract(u.url, '^https://([^./]+)', 1), ''), 'none') as seller_name
  from url_list u left join done using (url))
select seller_name, outcome, count(*) as n from marked group by all""")
def _run_summary(spark, sf_dir):
    done = (view(spark, sf_dir, "crawl_items").select(F.col("seller_product_url").alias("url"))
            .distinct().withColumn("done", F.lit(True)))
    listed = view(spark, sf_dir, "url_list").join(done, "url", "left")
    outcome = (F.when((F.trim("url") == "") | (F.col("url") == "URL"), "failed")
               .when(F.col("done"), "skipped").otherwise("scraped"))
    seller = F.regexp_extract("url", "^https://([^./]+)", 1)
    return profiling.run_summary(listed.select(
        F.when(seller == "", "none").otherwise(seller).alias("seller_name"),
        outcome.alias("outcome")))


_FAILURES = r"""
, failures as (
  select strptime(regexp_extract(line, '^\[([^\]]*)\]', 1), '%Y-%m-%d %H:%M:%S') as ts,
    regexp_extract(line, '\]\s+(\S+)', 1) as url,
    trim(trim(regexp_extract(line, '\|\s+(.*)$', 1)) || coalesce(chr(10) || more, '')) as reason
  from (
    select min_by(line, seq) as line,
      string_agg(case when not starts_with(line, '[') then line end, chr(10) order by seq) as more
    from (select *, sum(case when starts_with(line, '[') then 1 else 0 end) over (order by seq) as entry from failure_lines)
    where entry > 0 group by entry))"""


def _failures(spark, sf_dir):
    return parse_failures(view(spark, sf_dir, "failure_lines"))


@query("parse_failures", ("failure_lines",), _FAILURES + " select ts, url, reason from failures")
def _parse(spark, sf_dir):
    return _failures(spark, sf_dir)


@query("failure_reasons", ("failure_lines",), _FAILURES + r"""
select regexp_extract(reason, '^(\w+)', 1) as reason_type, count(*) as n from failures group by all""")
def _reasons(spark, sf_dir):
    return profiling.failure_reasons(_failures(spark, sf_dir))


@query("failed_audit", ("failure_lines", "url_list"), _FAILURES + """
select url, 'recovered' as status from (select distinct url from failures) where url in (select url from url_list)
union all
select url, 'never scraped' from (select distinct url from failures) where url not in (select url from url_list)""")
def _audit(spark, sf_dir):
    """The listed URLs stand for the scraped ones here."""
    failures, done = _failures(spark, sf_dir), view(spark, sf_dir, "url_list")
    return (profiling.recovered(failures, done, "url").withColumn("status", F.lit("recovered"))
            .union(profiling.never_scraped(failures, done, "url")
                   .withColumn("status", F.lit("never scraped"))))


@query("invalid_price_rows", ("raw_products",), """
, last_rows as (select * from raw_products
  qualify row_number() over (partition by seller_product_url order by seq desc) = 1)
select seq, 'current_price' as col, current_price as value from last_rows
where current_price is not null and not regexp_matches(current_price, '^([0-9]+[.]?[0-9]*|[.][0-9]+)$')
union all
select seq, 'original_price', original_price from last_rows
where original_price is not null and not regexp_matches(original_price, '^([0-9]+[.]?[0-9]*|[.][0-9]+)$')""")
def _invalid(spark, sf_dir):
    rows = dedup_keep_last(view(spark, sf_dir, "raw_products"))
    parts = [profiling.invalid_price_rows(rows, c).select("seq", F.lit(c).alias("col"), F.col(c).alias("value"))
             for c in ("current_price", "original_price")]
    return parts[0].union(parts[1])


@query("null_audit", ("raw_products",), """
select product_name, seller_product_url, category_name, current_price from raw_products
where category_name is null or current_price is null""")
def _null_audit(spark, sf_dir):
    return profiling.null_rows(
        view(spark, sf_dir, "raw_products"), ["category_name", "current_price"],
        ["product_name", "seller_product_url", "category_name", "current_price"])


@query("denylisted_brands", ("raw_products",),
       f"select seq, brand_name from raw_products where brand_name in ({quoted(BRAND_DENYLIST)})")
def _denylisted(spark, sf_dir):
    return profiling.denylisted(view(spark, sf_dir, "raw_products"), BRAND_DENYLIST).select(
        "seq", "brand_name")


@query("brand_sample", ("vendor_feed",), """
, named as (select seq, coalesce(brand, '') as brand_name, title as seller_product_name, link as seller_product_url from vendor_feed)
select *, min(seq) over (partition by brand_name) as brand_seq from named
qualify row_number() over (partition by brand_name order by seq) <= 2""")
def _sample(spark, sf_dir):
    rows = conform_feed(view(spark, sf_dir, "vendor_feed"), "Arogga")
    return profiling.brand_sample(rows.select(
        "seq", "brand_name", "seller_product_name", "seller_product_url")).orderBy("brand_seq", "seq")


@query("chunk_assignment", ("raw_products",), """
, kept as (select * from raw_products
  qualify row_number() over (partition by seller_product_url order by seq desc) = 1),
numbered as (select seq, row_number() over (order by seq) as i from kept)
select seq, i as row_index, (i - 1) // 2500 + 1 as part from numbered""")
def _chunks(spark, sf_dir):
    kept = dedup_keep_last(view(spark, sf_dir, "raw_products").select("seq", "seller_product_url"))
    return with_chunk(kept).select("seq", F.col("_index").alias("row_index"), "part")


@query("chunk_assignment_all_events", (), """
select event_id as seq, (row_number() over (order by event_id) - 1) // 2500 + 1 as part from events""")
def _event_chunks(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"))
    return with_chunk(events).select("seq", "part")
