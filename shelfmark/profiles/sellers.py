"""Shops whose pages arrive as plain HTTP responses."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import flags, gallery, prices, urls
from ..functions.text import strip
from ..operators import html as H
from ..operators.html import tag
from . import Columns, Found, Page, Profile, register_profile

TITLE = tag("h1", class_="product_title entry-title")


def taka(c: Column) -> Column:
    return prices.clean_price(c, "৳")


def bdi_prices(page: Page) -> Column:
    """Price texts in all price paragraphs."""
    return H.texts(H.flat_all(page.html, tag("p", class_="price"), "p"), tag("bdi"))


def crumbs(page: Page) -> Column:
    trail = H.flat(page.html, tag("nav", class_="woocommerce-breadcrumb"), "nav")
    return H.texts(trail, tag("a"))


def _hrefs(fragment: Column) -> Column:
    return H.attrs(fragment, tag("a", read="href"))


def _both(*hrefs: Column) -> Column:
    return F.array_distinct(F.concat(*hrefs))


# ── ryans ────────────────────────────────────────────────────────────────────

_RYANS_NAME = tag("h1", itemprop="name")


def _ryans_readings(page: Page, block: Columns) -> Columns:
    html = page.html
    points = H.flat_all(block["overview"], tag("ul", cls="category-info"), "ul")
    numbered = F.filter(H.flats(html, tag("p"), "p"),
                        lambda p: F.contains(p, F.lit("Product Id")))
    return {
        "name": H.text(html, _RYANS_NAME),
        "sku": H.text(H.nth(numbered, 1), tag("span")),
        "current": H.text(html, tag("span", cls="new-sp-text")),
        "original": H.text(html, tag("span", cls="new-reg-text")),
        "image": H.attr(html, tag("img", cls="slideshow-items", read="src")),
        "crumbs": H.texts(block["trail"], tag("a", itemtype="http://schema.org/Thing")),
        "points": H.own_nodes(H.flat_all(points, tag("li"), "li")),
        "reviews": F.array(H.count(html, tag("div", cls="qna-body")).cast("string")),
        "availability": H.attr(html, tag("link", itemprop="availability", read="href")),
    }


def _ryans(page: Page, found: Found) -> Columns:
    trail = found.all("crumbs")
    return {
        "product_name": found.one("name"),
        "seller_sku": found.one("sku"),
        "current_price": prices.clean_price(found.one("current"), "Tk"),
        "original_price": prices.clean_price(found.one("original"), "Tk"),
        "primary_image_url": found.one("image"),
        "category_name": F.when(F.size(trail) > 1, H.nth(trail, 2)).otherwise(""),
        "brand_name": F.when(F.size(trail) > 2, H.nth(trail, -2)).otherwise(""),
        "product_description": H.joined(found.all("points")),
        "review_count": found.one("reviews"),
        "in_stock": flags.stock_flag(found.one("availability"), "InStock"),
    }


def _ryans_links(page: Page) -> Column:
    products = _hrefs(H.flat_all(page.html, tag("h4", cls="product-name"), "h4"))
    pager = H.flat_all(page.html, tag("li", cls="page-item"), "li")
    return _both(products, F.slice(H.attrs(pager, tag("a", rel="next", read="href")), 1, 1))


register_profile(Profile(
    "ryans",
    is_product=lambda page: page.has(_RYANS_NAME) | page.has(tag("button", cls="details-cart-btn")),
    blocks={"trail": rf"{tag('div', cls='card-body')}[\s\S]*?{tag('div', cls='d-flex')}",
            "overview": tag("div", cls="overview")},
    readings=_ryans_readings,
    rules=_ryans,
    slugs=("product", "category", "brand"),
    links=_ryans_links,
    is_listing=lambda page: page.has(tag("div", cls="category-single-product")),
    drops_ignored_links=False,
    honours_recurse=False,
))

# ── startech ─────────────────────────────────────────────────────────────────

# Where the photo and the category list stand, from the body down.
_PHOTO_PATH = [("div", 5), ("div", 1), ("div", 1), ("div", 2), ("div", 1), ("div", 1), ("div", 1)]
_CATEGORY_PATH = [("section", 1), ("div", 1), ("ul", 1)]


def _startech_readings(page: Page, block: Columns) -> Columns:
    html = page.html
    body = H.following(html, tag("body"))
    crumbs = H.flats(H.piece_at(body, _CATEGORY_PATH), tag("li"), "li")
    price = H.flat(html, tag("td", cls="product-price"), "td")
    return {
        "name": H.text(html, tag("h1", cls="product-name")),
        "image": H.attr(H.piece_at(body, _PHOTO_PATH), rf"{tag('a')}\s*{tag('img', read='src')}"),
        "price": H.own_nodes(price),
        "reduced": H.text(price, tag("ins")),
        "original": H.text(html, tag("td", cls="product-regular-price")),
        "category": H.text(H.nth(crumbs, 2), rf"{tag('a')}[^<]*{tag('span')}"),
        "reviews": H.text(H.following(html, tag("*", id="write-review")), tag("h2")),
        "code": H.text(html, tag("*", cls="product-code")),
        "status": H.text(html, tag("*", cls="product-status")),
    }


def _startech(page: Page, found: Found) -> Columns:
    return {
        "product_name": found.one("name"),
        "primary_image_url": found.one("image"),
        "current_price": taka(gallery.first_non_empty(H.nth(found.filled("price"), 1), found.one("reduced"))),
        "original_price": taka(found.one("original")),
        "category_name": found.one("category"),
        "review_count": found.one("reviews"),
        "seller_sku": found.one("code"),
        "in_stock": flags.stock_flag(found.one("status"), "In Stock"),
    }


register_profile(Profile(
    "startech",
    is_product=lambda page: F.contains(page.url, F.lit("product"))
    | page.has(tag("div", class_="*product-details")),
    readings=_startech_readings,
    rules=_startech,
    links=lambda page: _both(
        _hrefs(H.flat_all(page.html, tag("h4", cls="p-item-name"), "h4")),
        _hrefs(H.flat_all(page.html, tag("ul", cls="pagination"), "ul"))),
))

# ── lira and herlan: the same shop software ──────────────────────────────────


def _is_shop_product(page: Page) -> Column:
    return F.contains(page.url, F.lit("product")) & ~F.contains(page.url, F.lit("product-category"))


def _pair(found: Found) -> Columns:
    current, original = prices.pair_second(found.all("prices"))
    return {"current_price": taka(current), "original_price": taka(original)}


_ZOOM = tag("a", class_="woocommerce-main-image pswp-main-image zoom")


def _lira_readings(page: Page, block: Columns) -> Columns:
    html = page.html
    return {
        "name": H.text(html, TITLE),
        "image": H.attr(html, rf"{_ZOOM}\s*{tag('img', read='src')}"),
        "prices": bdi_prices(page),
        "crumbs": crumbs(page),
        "brand": H.text(html, rf"{tag('span', class_='product_brand')}\s*{tag('a')}"),
        "sku": H.text(html, tag("span", class_="sku")),
        "description": H.nodes(block["description"]),
    }


def _lira(page: Page, found: Found) -> Columns:
    return {
        **_pair(found),
        "product_name": found.one("name"),
        "primary_image_url": found.one("image"),
        "category_name": H.nth(found.all("crumbs"), 3),
        "brand_name": found.one("brand"),
        "review_count": F.lit("0"),
        "in_stock": F.lit("Yes"),
        "seller_sku": found.one("sku"),
        "product_description": H.joined(found.all("description")),
    }


register_profile(Profile(
    "lira",
    is_product=_is_shop_product,
    blocks={"description": tag("div", aria__labelledby="tab-title-description")},
    readings=_lira_readings,
    rules=_lira,
    slugs=("product", "brand"),
    links=lambda page: _both(
        _hrefs(H.flat_all(page.html, tag("h2", cls="product-title"), "h2")),
        H.attrs(page.html, tag("a", cls="woocommerce-LoopProduct-link", read="href")),
        H.attrs(page.html, rf"(?={tag('a', cls='page-numbers')}){tag('a', cls='next', read='href')}")),
))

PRODUCT_TAG = rf"{tag('li', class_='*product-tag-item')}\s*{tag('a')}"


def _herlan_readings(page: Page, block: Columns) -> Columns:
    html = page.html
    photos = H.flat_all(html, tag("li", itemprop="associatedMedia"), "li")
    return {
        "name": H.text(html, TITLE),
        "images": H.attrs(photos, tag("img", read="src")),
        "prices": bdi_prices(page),
        "crumbs": crumbs(page),
        "brand": H.text(html, PRODUCT_TAG),
        "stock": H.text(html, rf"{tag('p')}(?=[^<]*In stock)"),
        "description": H.nodes(block["description"]),
    }


def _herlan(page: Page, found: Found) -> Columns:
    images = gallery.gallery_clean(found.all("images"))
    return {
        **_pair(found),
        "product_name": found.one("name"),
        "primary_image_url": gallery.gallery_primary(images),
        "image_urls": F.array_join(images, ";"),
        "category_name": H.nth(found.all("crumbs"), -1),
        "brand_name": found.one("brand"),
        "review_count": F.lit("0"),
        "product_description": H.joined(found.all("description")),
        "in_stock": flags.stock_flag(found.one("stock"), "In stock"),
    }


GRID_LINK = rf"{tag('div', class_='woocommerce-loop-product__title')}\s*{tag('a', read='href')}"

register_profile(Profile(
    "herlan",
    is_product=_is_shop_product,
    blocks={"description": tag("div", class_="cg-accordion-item")},
    readings=_herlan_readings,
    rules=_herlan,
    slugs=("product", "brand"),
    links=lambda page: _both(H.attrs(page.html, GRID_LINK),
                             H.attrs(page.html, tag("a", aria__label="Next", read="href"))),
))

# ── kireibd ──────────────────────────────────────────────────────────────────

_POST = tag("div", cls="post-content")


_KIREIBD_BLOCKS = {
    "price": tag("div", cls="post-content__price"),
    "brand": tag("div", cls="post-content__brand"),
    "rating": tag("div", cls="rating"),
    "description": tag("div", class_="*product-details__content"),
}
_BARCODE = rf"{tag('strong')}(?=[^<]*Barcode)[^<]*</strong\s*>(?:<[^<>]*>)?([^<]*)"
# What follows the "Category" label in its block; the last link there is the category.
_CATEGORIES = (rf"{tag('span')}(?=[^<]*Category)[^<]*</span\s*>"
               r"((?:[^<]++|<(?!/?(?i:div|p|li|ul|td|section)[\s>]))*+)")


def _kireibd_readings(page: Page, block: Columns) -> Columns:
    html = page.html
    categories = F.regexp_extract(html, _CATEGORIES, 1)
    return {
        "name": H.text(H.following(html, _POST), tag("h3", cls="fw-medium")),
        "current": H.text(block["price"], tag("h3", cls="fw-medium")),
        "original": H.text(block["price"], tag("del")),
        "image": H.attr(html, tag("img", src="*cdn.kireibd.com/storage/all/", read="src")),
        "brand": H.text(block["brand"], tag("a")),
        "brand_href": H.attr(block["brand"], tag("a", read="href")),
        "sku": F.array(F.regexp_extract(block["brand"], _BARCODE, 1)),
        "category": H.texts(categories, tag("a")),
        "category_href": F.transform(H.tags(categories, tag("a")), lambda a: H.attr_of(a, "href")),
        "rating": H.text(block["rating"], tag("button")),
        "description": H.nodes(block["description"]),
        "sold_out": H.text(html, tag("span", cls="trk-btn--stock-out")),
    }


def _kireibd(page: Page, found: Found) -> Columns:
    def stripped(c: Column, mark: str) -> Column:
        return strip(prices.without(c, mark))

    return {
        "product_name": found.one("name"),
        "product_slug": urls.url_last_segment(page.url, cut_query=False),
        "current_price": taka(found.one("current")),
        "original_price": taka(found.one("original")),
        "primary_image_url": found.one("image"),
        "brand_name": found.one("brand"),
        "brand_slug": urls.after_token(found.one("brand_href"), "brand="),
        "seller_sku": stripped(found.one("sku"), ":"),
        "category_name": stripped(H.nth(found.all("category"), -1), ","),
        "category_slug": urls.after_token(H.nth(found.all("category_href"), -1), "category="),
        "review_count": prices.first_int_text(found.one("rating")),
        "product_description": H.joined(found.all("description"), " "),
        "in_stock": flags.stock_unless(found.one("sold_out"), "out of stock"),
    }


def _kireibd_links(page: Page) -> Column:
    return F.array_distinct(F.filter(
        _hrefs(page.html),
        lambda href: urls.is_product_href(href) | urls.is_same_category_href(href, page.url)))


def _kireibd_is_product(page: Page) -> Column:
    return F.contains(page.url, F.lit("/product/")) & page.has(_POST)


register_profile(Profile(
    "kireibd",
    is_product=_kireibd_is_product,
    blocks=_KIREIBD_BLOCKS,
    readings=_kireibd_readings,
    rules=_kireibd,
    links=_kireibd_links,
    is_listing=lambda page: ~_kireibd_is_product(page),
    drops_ignored_links=False,
    honours_recurse=False,
))

# ── banglashoppers ───────────────────────────────────────────────────────────

_SKU = tag("div", itemprop="sku")


def _banglashoppers_readings(page: Page, block: Columns) -> Columns:
    html = page.html
    return {
        "name": H.text(html, rf"{tag('h1', class_='page-title')}\s*{tag('span')}"),
        "images": _hrefs(H.flat_all(html, tag("div", id="*MagicToolboxSelectors"), "div")),
        "prices": H.texts(block["prices"], tag("span", class_="price")),
        "crumbs": H.texts(block["trail"], rf"{tag('li')}\s*{tag('a')}"),
        "brand": H.text(html, tag("div", id="brand_name")),
        "reviews": H.text(html, tag("span", itemprop="reviewCount")),
        "sku": H.text(html, _SKU),
        "description": H.nodes(block["description"]),
    }


def _banglashoppers(page: Page, found: Found) -> Columns:
    shown = found.all("prices")
    return {
        "product_name": found.one("name"),
        "primary_image_url": H.nth(found.all("images"), 1),
        "image_urls": H.joined(found.all("images"), ";"),
        "current_price": prices.cut_prefix(prices.clean_price(H.nth(shown, 1), "Tk")),
        "original_price": prices.cut_prefix(H.nth(shown, 2)),
        "category_name": H.nth(found.all("crumbs"), -2),
        "brand_name": found.one("brand"),
        "review_count": prices.digits_only(found.one("reviews")),
        "in_stock": F.lit("Yes"),
        "seller_sku": strip(prices.without(found.one("sku"), "SKU: ")),
        "product_description": H.joined(found.all("description")),
    }


def _banglashoppers_links(page: Page) -> Column:
    cell = rf"{tag('li', class_='item product product-item')}\s*{tag('div')}\s*{tag('div')}"
    following = H.attrs(page.html, tag("a", class_="action  next", read="href"))
    return _both(H.attrs(page.html, rf"{cell}\s*{tag('a', read='href')}"),
                 F.slice(following, 1, 1))


register_profile(Profile(
    "banglashoppers",
    is_product=lambda page: page.has(rf"{_SKU}[^<]"),
    blocks={"prices": tag("div", class_="product-info-custom"),
            "trail": tag("div", class_="breadcrumbs"),
            "description": tag("div", id="description")},
    readings=_banglashoppers_readings,
    rules=_banglashoppers,
    slugs=("product", "brand"),
    links=_banglashoppers_links,
))
