"""Links, frontier and pagination."""

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import links
from ..operators.extract import all_anchors, followed_urls, page_links
from ..session import new_folder
from ..sources.readers import entrypoints_or_default, listed_urls, without_headings
from ..sources.visited import VisitedUrls
from .catalog import query
from .views import product_pages, table, view

# Every page's anchors, absolute; the pages only have root-relative links.
_ANCHORS = """anchors as (
  select distinct url as source_url, unnest(regexp_extract_all(html, '<a href="([^"]*)', 1)) as href from pages),
absolute as (
  select *, regexp_extract(source_url, '^[a-z]+://[^/?#]*') || href as url from anchors where starts_with(href, '/'))"""

_IGNORED = "/account|/cart|/checkout|/login|javascript:|tel:|mailto:|question|review"
_HOST = "regexp_extract({0}, '^[a-z]+://([^/?#]*)', 1)"


def _anchors(spark, sf_dir):
    return all_anchors(table(spark, sf_dir, "pages"))


@query("make_absolute_links", (), f"with {_ANCHORS} select source_url, href, url from absolute")
def _absolute(spark, sf_dir):
    return links.absolute_links(_anchors(spark, sf_dir))


@query("joined_links", (), f"with {_ANCHORS} select source_url, href, url from absolute")
def _joined(spark, sf_dir):
    return followed_urls(_anchors(spark, sf_dir))


_PAGE_ID = "page_id % 2 = 0"


_FRONTIER = f"""with {_ANCHORS},
visited as (select distinct url from absolute join pages on source_url = pages.url where {_PAGE_ID}),
wanted as (select distinct url from absolute where not regexp_matches(lower(href), '{_IGNORED}')
  and ({_HOST.format('url')} = 'example.com' or ends_with({_HOST.format('url')}, '.example.com')))
select url from wanted where url not in (select url from visited)""".replace(
    "absolute join pages on source_url = pages.url", "absolute join (select url as page_url, page_id from pages) on source_url = page_url")


@query("frontier_step", (), _FRONTIER)
def _frontier(spark, sf_dir):
    """What even pages link to counts as visited; all pages are searched for links."""
    pages = table(spark, sf_dir, "pages")
    found = all_anchors(pages)
    visited = links.absolute_links(all_anchors(pages.filter(_PAGE_ID)))
    return links.frontier_step(found, visited, "example.com")


def _visited_table(spark, name: str) -> VisitedUrls:
    """A new table of the catalogue, its files in the shared folder."""
    folder = new_folder(spark, name)
    return VisitedUrls(spark, folder.rsplit("/", 1)[-1].replace("-", "_"), folder, buckets=8)


@query("frontier_table", (), _FRONTIER)
def _frontier_table(spark, sf_dir):
    """The same against a table of visited URLs that grew over two rounds, one of them repeated."""
    pages = table(spark, sf_dir, "pages")
    visited = _visited_table(spark, "visited")
    done = links.absolute_links(all_anchors(pages.filter(_PAGE_ID))).withColumn("half", F.xxhash64("url") % 2 == 0)
    for round_id, half in ((0, True), (1, False), (1, False)):
        visited.add(done.filter(F.col("half") == half), round_id)
    found = links.keep_domain(links.absolute_links(links.drop_ignored(all_anchors(pages))), "example.com")
    return visited.unvisited(found)


@query("sorted_urls", (), f"with {_ANCHORS} select distinct url from absolute order by url")
def _sorted(spark, sf_dir):
    found = links.absolute_links(_anchors(spark, sf_dir))
    return found.select("url").distinct().orderBy("url")


@query("link_pairs", (), f"""with {_ANCHORS}
select distinct regexp_extract(source_url, '^[a-z]+://[^/?#]*') as source_url, url as product_url from absolute""")
def _pairs(spark, sf_dir):
    found = links.absolute_links(_anchors(spark, sf_dir))
    return links.link_pairs(found.select(
        F.regexp_extract("source_url", "^[a-z]+://[^/?#]*", 0).alias("source_url"),
        F.col("url").alias("product_url")))


@query("entrypoint_yield", (), f"""with {_ANCHORS},
found as (select distinct length({_HOST.format('source_url')}) as entry, href as url from absolute),
firsts as (select url, min(entry) as entry from found group by url),
new_here as (select entry, count(*) as new from firsts group by entry)
select entry, count(*) as found, coalesce(any_value(new), 0) as new,
  count(*) - coalesce(any_value(new), 0) as duplicates
from found left join new_here using (entry) group by entry""")
def _yield(spark, sf_dir):
    """Entry points are numbered by the length of their host name here."""
    found = links.absolute_links(_anchors(spark, sf_dir)).select(
        F.length(urls.host(F.col("source_url"))).cast("bigint").alias("entry"),
        F.col("href").alias("url"))
    return links.entrypoint_yield(found)


@query("union_links", (), f"""with {_ANCHORS}
select distinct href as url from absolute union select distinct url from pages""")
def _union(spark, sf_dir):
    found = _anchors(spark, sf_dir).select(F.col("href").alias("url"))
    return links.union_links(found, table(spark, sf_dir, "pages"))


@query("difference_links", (), f"""with {_ANCHORS}
select distinct href as url from absolute join (select url as page_url, page_id from pages) on source_url = page_url
where page_id % 2 = 1
except select href from absolute join (select url as page_url, page_id from pages) on source_url = page_url
where page_id % 2 = 0""")
def _difference(spark, sf_dir):
    """New links of odd pages, given those of even pages."""
    pages = table(spark, sf_dir, "pages")
    odd, even = (all_anchors(pages.filter(c)).select(F.col("href").alias("url"))
                 for c in ("page_id % 2 = 1", "page_id % 2 = 0"))
    return links.difference(odd, even)


@query("pending_urls", ("url_list", "crawl_items"), """
, done as (select distinct seller_product_url as url from crawl_items)
select seq, url from url_list where url not in (select url from done)""")
def _pending(spark, sf_dir):
    return links.pending_urls(
        view(spark, sf_dir, "url_list"), view(spark, sf_dir, "crawl_items")).select("seq", "url")


@query("pending_table", ("url_list", "crawl_items"), """
, done as (select distinct seller_product_url as url from crawl_items)
select seq, url from url_list where url not in (select url from done)""")
def _pending_table(spark, sf_dir):
    """The same against a table of scraped URLs."""
    scraped = _visited_table(spark, "scraped")
    scraped.add(view(spark, sf_dir, "crawl_items").select(F.col("seller_product_url").alias("url")), 0)
    return scraped.pending(view(spark, sf_dir, "url_list")).select("seq", "url")


@query("shuffled_pending", ("url_list", "crawl_items"), """
, done as (select distinct seller_product_url as url from crawl_items)
select url from url_list where url not in (select url from done)""")
def _shuffled(spark, sf_dir):
    """In random order; the check compares the rows, whatever their order."""
    pending = links.pending_urls(
        view(spark, sf_dir, "url_list"), view(spark, sf_dir, "crawl_items"))
    return links.shuffled(pending.select("url"), 42)


@query("pagination_cutoff", ("listing_pages",), """
, firsts as (select source_url, product_url, min(page_num) as page_num from listing_pages group by all),
ends as (
  select source_url, min(page_num) as last_page from (
    select distinct source_url, page_num from listing_pages where page_num > 1
    except select source_url, page_num from firsts) group by source_url)
select source_url, product_url, page_num as found_on_page
from firsts left join ends using (source_url) where last_page is null or page_num < last_page""")
def _cutoff(spark, sf_dir):
    return links.pagination_cutoff(view(spark, sf_dir, "listing_pages"))


@query("take_while_valid", ("vendor_feed",), """
select seq, link from vendor_feed
where seq < coalesce((select min(seq) from vendor_feed where not starts_with(trim(link), 'http')), 9223372036854775807)""")
def _take_while(spark, sf_dir):
    from ..functions.text import strip
    from ..operators.ordered import take_while
    feed = view(spark, sf_dir, "vendor_feed").select("seq", "link")
    return take_while(feed, F.startswith(strip(F.col("link")), F.lit("http")))


@query("entrypoint_scan", ("url_list",), """
, cells as (select trim(url) as url from url_list)
select 'listed' as reader, url from cells where url <> ''
union all select 'headerless', url from cells where lower(url) not in ('url', 'link', 'entrypoint', '')
union all select 'entrypoints', url from url_list where url <> ''
union all select 'default', 'https://start.example.com/'
union all select 'matching', url from cells where regexp_matches(url, '/product/item-[0-9]*4$')""")
def _entrypoints(spark, sf_dir):
    cells = view(spark, sf_dir, "url_list").select("url")
    start = "https://start.example.com/"
    parts = {
        "listed": listed_urls(cells),
        "headerless": without_headings(cells),
        "entrypoints": entrypoints_or_default(cells, start),
        "default": entrypoints_or_default(cells.filter("url is null"), start),
        "matching": links.keep_matching(listed_urls(cells), r"/product/item-[0-9]*4$"),
    }
    out = None
    for reader, rows in parts.items():
        rows = rows.select(F.lit(reader).alias("reader"), "url")
        out = rows if out is None else out.union(rows)
    return out


_LISTING = "shop = 9 and p_partkey % 40 <> 39"
_ID = "cast(page_id as varchar)"
# The links each profile must find on a listing page, and where a browser crawl looks.
_EXPECTED = {
    "ryans": ["'/product/item-' || (page_id - 9) || '?x=1#top'",
              "'//shop9.example.com/product/item-' || (page_id % 100)",
              "'?category=' || lower(p_type) || '&page=' || (p_size + 1)"],
    "startech": [f"'/st-' || {_ID}", "'/st?page=2'"],
    "lira": [f"'/li-' || {_ID}", "'/li/page/2'"],
    "herlan": [f"'/he-' || {_ID}", "'/he?page=2'"],
    "kireibd": ["'/product/item-' || (page_id - 9) || '?x=1#top'",
                "'//shop9.example.com/product/item-' || (page_id % 100)",
                "'http://other.example.org/product/1'",
                "'?category=' || lower(p_type) || '&page=' || (p_size + 1)"],
    "banglashoppers": [f"'/ba-' || {_ID}", "'/ba?p=2'"],
    "herlan_browser": [f"'/he-' || {_ID}"],
    "ohsogo": [f"'/oh-' || {_ID}"],
    "themallbd": [f"'/tm-' || {_ID}"],
}


def _expected(resolve: bool) -> str:
    base = "regexp_extract(url, '^https://[^/]*')"
    parts = []
    for profile, hrefs in _EXPECTED.items():
        for href in hrefs:
            url = (f", case when starts_with({href}, '//') then 'https:' || {href} "
                   f"when starts_with({href}, 'http') then {href} "
                   f"when starts_with({href}, '?') then regexp_extract(url, '^[^?]*') || {href} "
                   f"else {base} || {href} end as target" if resolve else "")
            parts.append(f"select '{profile}' as profile, url as source_url, {href} as href{url} "
                         f"from product_pages where {_LISTING}")
    return "\nunion all\n".join(parts)


@query("profile_links", ("product_pages",), _expected(resolve=False))
def _profile_links(spark, sf_dir):
    """Links each profile follows from all pages."""
    return page_links(product_pages(spark, sf_dir), list(_EXPECTED))


@query("followed_urls", ("product_pages",),
       f"select * from ({_expected(resolve=True)}) where profile in ('ryans', 'kireibd')")
def _followed(spark, sf_dir):
    """Links resolved against their page; these two shops ignore the recurse option."""
    found = page_links(product_pages(spark, sf_dir), ["ryans", "kireibd", "lira"], recurse=False)
    return followed_urls(found).withColumnRenamed("url", "target")
