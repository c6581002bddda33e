"""From landed pages to product rows, failures and links."""

from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lower_hyphen
from ..functions.urls import host, is_ignored_link, url_join
from ..profiles import Found, Page, Profile, get_profile, profile_names
from ..profiles.browser import feed_readings, feed_row
from . import html as H
from .links import explode_links

NOT_A_PRODUCT = "Parser returned None"
NO_PROFILE = "No parser found"


def _readable(pages: DataFrame) -> DataFrame:
    """One clean copy of the page text, shared by all rules."""
    return (pages.withColumn("_page", H.without_scripts(F.col("html")))
            .withColumn("_page", H.plain_values(F.col("_page"))))


def _only(pages: DataFrame, condition: Column) -> DataFrame:
    """The rows that satisfy a condition on the page's text.

    A filter would move below the projection of that text, which is then computed for the
    filter's every test and once more for the rows it leaves. A generator stays where it is.
    """
    kept = pages.withColumn("_kept", F.explode(F.when(condition, F.array(F.lit(True)))))
    return kept.drop("_kept")


def _page() -> Page:
    """The columns every rule reads."""
    return Page(F.col("url"), F.col("_page"), F.col("_seller"), F.col("_base"))


@dataclass(frozen=True)
class _Compiled:
    """Rules of some profiles as columns, one per layer."""

    is_product: Column
    blocks: Column
    found: Column
    product: Column


@lru_cache(maxsize=64)
def _compile(application: str, profiles: tuple[Profile, ...], dispatched: bool) -> _Compiled:
    """Rules become columns once per application, not once per query.

    With ``dispatched`` a row takes the rules of its ``profile``, else those of the only one.
    """
    page = _page()

    def choose(columns: list[Column]) -> Column:
        return _by_profile(profiles, columns) if dispatched else columns[0]

    read = [p.read(page, F.col("_blocks")) for p in profiles]
    found = [Found(list(r), F.col("_found")) for r in read]
    return _Compiled(
        is_product=choose([F.coalesce(p.is_product(page), F.lit(False)) for p in profiles]),
        blocks=F.transform(choose([p.rest_of_blocks(page) for p in profiles]),
                           lambda rest: H.inner_of_rest(rest)),
        found=F.transform(choose([F.array(*r.values()) for r in read]), lambda s: H.clean(s)),
        product=choose([p.product(page, f) for p, f in zip(profiles, found)]))


def _by_profile(profiles, columns: list[Column]) -> Column:
    return F.coalesce(*[F.when(F.col("profile") == p.name, c)
                        for p, c in zip(profiles, columns)])


def _rules_of(df: DataFrame, profile: Profile | str) -> _Compiled:
    """Rules of one profile, for all rows."""
    return _compile(df.sparkSession.sparkContext.applicationId, (_resolve(profile),), False)


def _rules_by_row(df: DataFrame, names: list[str] | None) -> _Compiled:
    """Rules of the profile each row was dispatched to."""
    profiles = tuple(get_profile(n) for n in names or profile_names())
    return _compile(df.sparkSession.sparkContext.applicationId, profiles, True)


def _with_product(pages: DataFrame, rules: _Compiled) -> DataFrame:
    """Adds ``product``, one projection per layer."""
    return (pages.withColumn("_blocks", rules.blocks)
            .withColumn("_found", rules.found)
            .withColumn("product", rules.product))


def _resolve(profile: Profile | str) -> Profile:
    return get_profile(profile) if isinstance(profile, str) else profile


def extract(pages: DataFrame, profile: Profile | str, seller_name: str, base_url: str,
            keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Product rows of one seller's pages; other pages are left out."""
    kept = [c for c in keep if c in pages.columns]
    rules = _rules_of(pages, profile)
    found = _only(_readable(pages.select(
        *kept, "url", "html", F.lit(seller_name).alias("_seller"), F.lit(base_url).alias("_base"))
    ), rules.is_product)
    return _with_product(found, rules).select(*kept, "product.*")


def extract_feed(pages: DataFrame) -> DataFrame:
    """Vendor feed rows from detail pages; ``pages`` also has the listing's columns
    ``title`` and ``sale_price``."""
    names = list(feed_readings(F.lit("")))
    read = F.array(*feed_readings(F.col("_page")).values())
    found = _readable(pages).withColumn("_found", F.transform(read, lambda s: H.clean(s)))
    return found.select(*feed_row(F.col("title"), F.col("sale_price"), F.col("url"),
                                  Found(names, F.col("_found"))))


def rejected(pages: DataFrame, profile: Profile | str) -> DataFrame:
    """Failures of one seller: pages that are not product pages."""
    rules = _rules_of(pages, profile)
    return (_only(_readable(pages), ~rules.is_product)
            .select("url", F.lit(NOT_A_PRODUCT).alias("reason")))


def profile_table(spark: SparkSession, domains: dict[str, str]) -> DataFrame:
    """``(domain, profile)`` for a mapping of shop domain to profile name."""
    unknown = set(domains.values()) - set(profile_names())
    if unknown:
        raise KeyError(f"no such profiles: {sorted(unknown)}")
    # An Arrow table stays a local one whose size the planner knows; a list would not.
    names, profiles = zip(*sorted(domains.items())) if domains else ((), ())
    return spark.createDataFrame(pa.table({
        "domain": pa.array(names, pa.string()), "profile": pa.array(profiles, pa.string())}))


def profile_of_host(h: Column) -> Column:
    """Default dispatch: the first label of the host names the profile.

    A ``www.`` host therefore has no profile unless ``profile_table`` maps it.
    """
    name = lower_hyphen(F.substring_index(h, ".", 1))
    return F.when(name.isin(profile_names()), name)


def dispatch(pages: DataFrame, domains: dict[str, str] | None = None) -> DataFrame:
    """Adds ``domain`` and ``profile``; the latter is NULL for unknown shops.

    ``domains`` maps shop domains to profile names: a local table of known size, so the planner
    decides how to join it.
    """
    located = pages.withColumn("domain", host(F.col("url")))
    if domains is None:
        return located.withColumn("profile", profile_of_host(F.col("domain")))
    return located.join(profile_table(pages.sparkSession, domains), "domain", "left")


def _with_seller(dispatched: DataFrame, kept: list[str]) -> DataFrame:
    return dispatched.select(
        *kept, "url", "html", "profile", F.coalesce("profile", F.lit("")).alias("_seller"),
        F.concat(F.lit("https://"), F.col("domain")).alias("_base"))


def judge(dispatched: DataFrame, names: list[str] | None = None,
          keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``(url, profile, reason)`` of every page; the reason is NULL for products."""
    kept = [c for c in keep if c in dispatched.columns]
    rules = _rules_by_row(dispatched, names)
    return _readable(_with_seller(dispatched, kept)).select(
        *kept, "url", "profile", _reason(rules.is_product).alias("reason"))


def _reason(is_product: Column) -> Column:
    return (F.when(is_product.isNull(), F.lit(NO_PROFILE))
            .when(~is_product, F.lit(NOT_A_PRODUCT)))


def _followers(names: list[str] | None, recurse: bool) -> list[Profile]:
    """Profiles that follow links; without ``recurse`` only those that do not heed it."""
    return [p for p in map(get_profile, names or profile_names())
            if p.links and (recurse or not p.honours_recurse)]


def extract_all(dispatched: DataFrame, names: list[str] | None = None,
                keep: tuple[str, ...] = ("page_id",), recurse: bool | None = None) -> DataFrame:
    """Outcome of every page in one scan: ``product`` (a struct) or a failure ``reason``.

    Each row runs the rules of its own profile only. If ``recurse`` is given, the raw ``hrefs``
    that the profile follows are read in the same pass; ``outcome_links`` makes links of them.
    """
    kept = [c for c in keep if c in dispatched.columns]
    rules = _rules_by_row(dispatched, names)
    judged = _readable(_with_seller(dispatched, kept)).withColumn("_is_product", rules.is_product)
    if recurse is not None:
        asked = _followers(names, recurse)
        judged = judged.withColumn("hrefs", F.coalesce(
            _by_profile(asked, [_hrefs_of(p) for p in asked]), _no_hrefs()))
        kept = [*kept, "hrefs"]
    # Pages that are no products have no text to read.
    judged = judged.withColumn("_page", F.when(F.col("_is_product"), F.col("_page")))
    return _with_product(judged, rules).select(
        *kept, "url", "profile",
        F.when(F.col("_is_product"), F.col("product")).alias("product"),
        _reason(F.col("_is_product")).alias("reason"))


def extract_products(dispatched: DataFrame, names: list[str] | None = None,
                     keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Products only. Other pages are dropped before any field is read."""
    kept = [c for c in keep if c in dispatched.columns]
    rules = _rules_by_row(dispatched, names)
    found = _only(_readable(_with_seller(dispatched, kept)), rules.is_product)
    return _with_product(found, rules).select(*kept, "product.*")


def products_of(outcomes: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    kept = [c for c in keep if c in outcomes.columns]
    return outcomes.filter(F.col("product").isNotNull()).select(*kept, "product.*")


def failures_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("reason").isNotNull()).select("url", "reason")


def page_links(pages: DataFrame, profiles: list[Profile | str] | Profile | str,
               recurse: bool = True) -> DataFrame:
    """``(profile, source_url, href)``: what each profile follows from these pages, in one scan.

    Without ``recurse`` only the profiles that do not heed that option follow links.
    """
    several = [_resolve(p) for p in (profiles if isinstance(profiles, list) else [profiles])]
    asked = [p for p in several if p.links and (recurse or not p.honours_recurse)]
    hrefs = F.array(_no_hrefs(), *[_hrefs_of(p) for p in asked])
    names = F.array(F.lit(""), *[F.lit(p.name) for p in asked])
    per_profile = _readable(pages).select(
        F.col("url").alias("source_url"),
        F.explode(F.arrays_zip(names.alias("profile"), hrefs.alias("hrefs"))).alias("f"))
    return _followed(per_profile.select("f.profile", "source_url", "f.hrefs"), asked)


def dispatched_links(dispatched: DataFrame, names: list[str] | None = None,
                     recurse: bool = True) -> DataFrame:
    """As ``page_links``, each page by the rules of its own profile."""
    asked = _followers(names, recurse)
    found = _readable(dispatched).select(
        "profile", F.col("url").alias("source_url"),
        F.coalesce(_by_profile(asked, [_hrefs_of(p) for p in asked]), _no_hrefs()).alias("hrefs"))
    return _followed(found, asked)


def outcome_links(outcomes: DataFrame, names: list[str] | None = None,
                  recurse: bool = True) -> DataFrame:
    """As ``dispatched_links``, from the ``hrefs`` of ``extract_all``."""
    found = outcomes.select("profile", F.col("url").alias("source_url"), "hrefs")
    return _followed(found, _followers(names, recurse))


def _no_hrefs() -> Column:
    return F.array().cast("array<string>")


def _hrefs_of(profile: Profile) -> Column:
    """Raw hrefs a profile follows from a page; none if it is no listing."""
    page = _page()
    return F.when(F.coalesce(profile.is_listing(page), F.lit(False)), profile.links(page)
                  ).otherwise(_no_hrefs())


def _followed(found: DataFrame, asked: list[Profile]) -> DataFrame:
    links = found.select("profile", "source_url",
                         F.explode(F.array_distinct(H.clean(F.col("hrefs")))).alias("href"))
    keeps = [p.name for p in asked if not p.drops_ignored_links]
    return links.filter(F.col("profile").isin(keeps) | ~is_ignored_link(F.col("href")))


def followed_urls(links: DataFrame) -> DataFrame:
    """Adds ``url``: the link resolved against its page."""
    return links.withColumn("url", url_join(F.col("source_url"), F.col("href")))


def _anchors() -> Column:
    return H.attrs(F.col("_page"), H.tag("a", read="href"))


def all_anchors(pages: DataFrame) -> DataFrame:
    """``(source_url, href)`` of every anchor, each href once per page."""
    return explode_links(_readable(pages), H.clean(_anchors()))


def zero_link_pages(pages: DataFrame, profile: Profile | str) -> DataFrame:
    """Pages that are no products and have no product link, for inspection.

    A row-local test; no join with the links is needed.
    """
    rules = _rules_of(pages, profile)
    hrefs = F.filter(_anchors(), lambda h: F.contains(h, F.lit("/product/")))
    return _only(_readable(pages), ~rules.is_product & (F.size(hrefs) == 0)).drop("_page")
