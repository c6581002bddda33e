"""Shops whose pages were rendered by a browser before landing."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import flags, gallery, prices, text
from ..operators import html as H
from ..operators.html import tag
from . import Columns, Found, Page, Profile, register_profile
from .sellers import GRID_LINK, PRODUCT_TAG, TITLE, bdi_prices, crumbs, taka


def is_product_url(page: Page) -> Column:
    return F.contains(page.url, F.lit("/product/")) & ~F.contains(
        page.url, F.lit("/product-category/"))


# ── herlan ───────────────────────────────────────────────────────────────────


_DETAILS = {"details": tag("div", class_="cg-accordion-item")}


def _stock_text(html: Column) -> Column:
    """The first paragraph that is marked as stock or whose own text says so."""
    paragraphs = H.flats(html, tag("p"), "p", whole=True)
    marked = F.filter(paragraphs, lambda p: F.rlike(p, F.lit(tag("p", class_="*stock")))
                      | F.exists(H.own_nodes(p), lambda t: F.contains(t, F.lit("In stock"))))
    return H.plain(H.nth(marked, 1))


def _herlan_readings(page: Page, block: Columns) -> Columns:
    html = page.html
    photo = rf"{tag('li', itemprop='associatedMedia')}\s*{tag('img', read='src')}"
    return {
        "name": H.shown(html, TITLE, "h1"),
        "prices": bdi_prices(page),
        "photos": H.attrs(html, photo),
        "crumbs": crumbs(page),
        "brand": H.shown(html, PRODUCT_TAG, "a"),
        "stock": _stock_text(html),
        "details": H.plain(block["details"]),
    }


def _herlan(page: Page, found: Found) -> Columns:
    current, original = prices.pair_fallback(found.all("prices"))
    photos = found.filled("photos")
    return {
        "product_name": H.one_line(found.one("name")),
        "current_price": taka(current),
        "original_price": taka(original),
        "primary_image_url": H.nth(photos, 1),
        "image_urls": F.array_join(photos, ";"),
        "category_name": H.nth(found.all("crumbs"), -1),
        "brand_name": H.one_line(found.one("brand")),
        "in_stock": flags.stock_flag(
            H.one_line(found.one("stock")), "in stock", ignore_case=True),
        "product_description": H.one_line(found.one("details")),
    }


register_profile(Profile(
    "herlan_browser", is_product=is_product_url, blocks=_DETAILS,
    readings=_herlan_readings, rules=_herlan, derives=True, drops_ignored_links=False,
    links=lambda page: H.attrs(page.html, GRID_LINK),
))


def _reviews_readings(page: Page, block: Columns) -> Columns:
    return {**_herlan_readings(page, block), "nodes": H.nodes(block["details"]),
            "reviews": H.shown(page.html, tag("span", cls="count"), "span")}


def _herlan_with_reviews(page: Page, found: Found) -> Columns:
    """The older rules: also a review count, and text nodes joined by a space."""
    return {
        **_herlan(page, found),
        "product_description": H.joined(found.all("nodes"), " "),
        "review_count": gallery.first_non_empty(found.one("reviews"), F.lit("0")),
    }


register_profile(Profile(
    "herlan_browser_reviews", is_product=is_product_url, blocks=_DETAILS,
    readings=_reviews_readings, rules=_herlan_with_reviews, derives=True,
    drops_ignored_links=False,
))

# ── ohsogo ───────────────────────────────────────────────────────────────────

_SUMMARY = tag(
    "div", class_="jdgm-rev-widg__summary-text jdgm-all-reviews__summary-text--verified")
_ACCORDION = rf"(?={tag('div', cls='rte')}){tag('div', cls='accordion__content')}"


def _ohsogo_readings(page: Page, block: Columns) -> Columns:
    html = page.html
    boxes = H.flat_all(html, tag("price-money"), "price-money")
    thumbs = H.flat(html, tag("thumbnail-slider"), "thumbnail-slider")
    return {
        "name": H.shown(html, tag("h1", class_="product__heading h2"), "h1"),
        "prices": H.texts(boxes, tag("bdi")),
        "thumbs": H.attrs(thumbs, tag("img", read="src")),
        "rating": H.shown(html, tag("span", class_="jdgm-rev-widg__summary-average"), "span"),
        "summary": H.plain(H.inner(html, _SUMMARY)),
        "details": H.plain(block["details"]),
    }


def _ohsogo(page: Page, found: Found) -> Columns:
    current, original = prices.pair_reversed(found.filled("prices"))
    summary = gallery.first_non_empty(H.one_line(found.one("summary")), F.lit("0"))
    return {
        "product_name": H.one_line(found.one("name")),
        "current_price": prices.without(current, "৳", ","),
        "original_price": prices.without(original, "৳", ","),
        "primary_image_url": H.nth(found.filled("thumbs"), 1),
        "image_urls": H.joined(found.all("thumbs"), ";"),
        "in_stock": F.lit("Yes"),
        "seller_rating": text.nth_token(H.one_line(found.one("rating")), " ", 0),
        "review_count": text.nth_token(summary, " ", 2),
        "product_description": H.one_line(found.one("details")),
    }


register_profile(Profile(
    "ohsogo", is_product=lambda page: F.lit(True), blocks={"details": _ACCORDION},
    readings=_ohsogo_readings, rules=_ohsogo, derives=True, drops_ignored_links=False,
    links=lambda page: H.attrs(
        page.html, rf"{tag('div', class_='card-product_title line-clamp')}\s*{tag('a', read='href')}"),
))

# ── themallbd ────────────────────────────────────────────────────────────────

_SLIDE = r"<(?i:div)(?=[\s>/])(?=[^<>]*\sdata-swiper-slide-index)[^<>]*+>"
_CARD = rf"{tag('a', read='href')}(?=\s*{tag('div', class_='image-container text-center')})"


def _themallbd_readings(page: Page, block: Columns) -> Columns:
    html = page.html
    return {
        "name": H.plain(block["name"]),
        "prices": H.texts(html, tag("span", class_="*fw-semibold")),
        "brand": H.shown(html, rf"{tag('div', class_='title fw-bold fs-5')}\s*{tag('a')}", "a"),
        "label": H.shown(html, tag("span", class_="ms-1 m-fs-6 fs-6"), "span"),
        "details": H.plain(H.flat(html, tag("ul", id="shortDesc"), "ul")),
        "shown": H.tags(block["shown"], tag("img")),
        "slides": H.tags(H.flat_all(html, _SLIDE, "div"), tag("img")),
    }


def _image_sources(images: Column) -> Column:
    """Address per image tag: the loaded one, or the one a lazy loader would take."""
    return F.transform(images, lambda img: gallery.first_non_empty(
        *[H.attr_of(img, a) for a in ("src", "data-src", "data-lazy")]))


def _themallbd(page: Page, found: Found) -> Columns:
    current, original = prices.triple(found.all("prices"))
    return {
        "product_name": H.one_line(found.one("name")),
        "current_price": taka(current),
        "original_price": taka(original),
        "brand_name": H.one_line(found.one("brand")),
        "in_stock": flags.stock_flag(H.one_line(found.one("label")), "Add to Cart"),
        "product_description": H.one_line(found.one("details")),
        "primary_image_url": H.nth(_image_sources(found.all("shown")), 1),
        "image_urls": gallery.gallery_join(
            _image_sources(found.all("slides")), ";", distinct=True),
    }


register_profile(Profile(
    "themallbd", is_product=lambda page: F.lit(True),
    blocks={"name": tag("div", class_="mt-2 title-full fs-6"),
            "shown": tag("div", cls="swiper-slide-visible")},
    readings=_themallbd_readings,
    rules=_themallbd, derives=True, drops_ignored_links=False,
    links=lambda page: H.attrs(page.html, _CARD),
))

# ── vendor feed detail pages ─────────────────────────────────────────────────

_MRP = tag("div", class_="text-sm whitespace-nowrap text-gray-500 line-through "
                         "product_single_mrp_generate")


def feed_readings(html: Column) -> Columns:
    return {
        "mrp": H.plain(H.inner(html, _MRP)),
        "images": H.attrs(html, tag("img", alt="*Image", read="src")),
        "cart": F.array(F.exists(
            H.flats(html, tag("span"), "span"),
            lambda s: F.contains(F.get(H.plain(s), F.lit(0)), F.lit("Add To Cart"))).cast("string")),
        "brand": H.shown(html, tag("span", class_="text-sm text-brand"), "span"),
        "details": H.plain(H.inner(html, tag("div", class_="mt-4"))),
        "rating": H.shown(html, tag("span", class_="text-gray-700"), "span"),
        "reviews": H.plain(H.inner(html, tag("div", class_="text-sm text-gray-500"))),
    }


def feed_row(title: Column, sale_price: Column, link: Column, found: Found) -> list[Column]:
    """The 11 feed columns: three from the listing, the rest from the page."""
    images = found.filled("images")
    return [
        title.alias("title"),
        sale_price.alias("sale_price"),
        link.alias("link"),
        prices.mrp_or_sale(found.one("mrp"), sale_price).alias("price"),
        H.nth(images, 1).alias("primary_image_url"),
        F.array_join(F.array_distinct(images), "\n").alias("image_urls"),
        found.one("cart").cast("boolean").alias("stock"),
        H.one_line(found.one("brand")).alias("brand"),
        H.one_line(found.one("details")).alias("description"),
        text.nth_token(H.one_line(found.one("rating")), "/", 0).alias("rating"),
        F.coalesce(text.first_word(found.one("reviews")), F.lit("")).alias("reviews"),
    ]
