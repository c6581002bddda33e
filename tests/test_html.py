"""Reading HTML, including markup that is broken on purpose."""

import html as stdlib_html
import time
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import html as H
from shelfmark.operators.extract import extract, extract_products, dispatch, page_links
from shelfmark.profiles import Profile, get_profile, profile_names, register_profile

tag = H.tag
BUILT_IN = profile_names()


def read(spark, markup, *readings):
    row = spark.createDataFrame([(markup,)], "h string").select(
        *[r(F.col("h")).alias(f"r{i}") for i, r in enumerate(readings)]).first()
    return list(row) if len(readings) > 1 else row[0]


def test_tags_by_class_and_attribute(spark):
    markup = ("<div class='a b'>1</div><DIV CLASS=\"ab\">2</DIV><div data-class=\"a\">3</div>"
              "<div class=\"b  a\" id=x>4</div>")
    assert read(spark, markup, lambda h: H.texts(h, tag("div", cls="a"))) == ["1", "4"]
    assert read(spark, markup, lambda h: H.texts(h, tag("div", class_="a b"))) == ["1"]
    assert read(spark, markup, lambda h: H.texts(h, tag("div", class_="*b"))) == ["1", "2", "4"]
    assert read(spark, markup, lambda h: H.texts(h, tag("div", id="x"))) == ["4"]


def test_attributes(spark):
    markup = "<a href=\"/x?a=1&amp;b=2\">1</a><a HREF='/it\"s'>2</a><a href=/bare>3</a><a data-href='no'>4</a><a>5</a>"
    hrefs = read(spark, markup, lambda h: H.clean(H.attrs(h, tag("a", read="href"))))
    assert hrefs == ["/x?a=1&b=2", "/it\"s", "/bare"]
    assert read(spark, markup, lambda h: H.attr_of(F.regexp_extract(h, tag("a"), 0), "href")) == "/x?a=1&amp;b=2"


def test_own_text_skips_leaf_children(spark):
    markup = "<bdi><span class=s>৳</span>1,500</bdi><bdi>700<b>x</b></bdi><bdi></bdi>"
    assert read(spark, markup, lambda h: H.texts(h, tag("bdi"))) == ["1,500", "700", ""]
    assert read(spark, "<li>a <b>no</b> c</li>", lambda h: H.joined(H.clean(H.own_nodes(
        H.flat(h, tag("li"), "li"))), "|")) == "a|c"


def test_inner_keeps_nested_elements(spark):
    markup = "<div id='o'>a<div>b<div>c</div></div><divider>d</divider></div><div>e</div>"
    assert read(spark, markup, lambda h: H.inner(h, tag("div", id="o"))) == (
        "a<div>b<div>c</div></div><divider>d</divider>".join([" ", ""]))
    assert read(spark, markup, lambda h: H.joined(H.clean(H.nodes(H.inner(h, tag("div", id="o")))), " ")
                ) == "a b c d"
    unclosed = "<div id='o'>a<div>b"
    assert read(spark, unclosed, lambda h: H.inner(h, tag("div", id="o"))).strip() == "a<div>b"
    assert read(spark, "<p>no</p>", lambda h: H.inner(h, tag("div", id="o"))).strip() == ""


def test_piece_at_path(spark):
    markup = "<div>1</div><section><div>no</div></section><div>2<ul><li>x<li>y</ul><div>3</div><div>4 <a>z</a></div></div>"
    path = [("div", 2), ("div", 2)]
    assert read(spark, markup, lambda h: H.piece_at(h, path)) == "<div>4 <a>z</a>"
    assert read(spark, markup, lambda h: H.piece_at(h, [("div", 3)])) == ""
    assert read(spark, markup, lambda h: H.piece_at(h, [("div", 1), ("div", 1)])) == ""


def test_brackets_in_attribute_values(spark):
    markup = "<img alt=\"a > b > c\" title='x > y' src='/i.jpg'><p>if a=\"b\" > c</p>"
    assert read(spark, markup, lambda h: H.clean(H.attr(H.strip_noise(h), tag("img", read="src")))) == ["/i.jpg"]
    assert read(spark, markup, lambda h: H.clean(H.attr(H.strip_noise(h), tag("img", read="alt")))) == ["a > b > c"]


def test_text_with_children(spark):
    markup = "<h1 class='t'>Soap <b>Gold</b></h1><h1 class='t'>x</h1>"
    assert read(spark, markup, lambda h: H.shown(h, tag("h1", cls="t"), "h1")) == ["Soap Gold"]


def test_stock_and_names_of_rendered_pages(spark):
    page = ("<h1 class='product_title entry-title'>Soap <b>Gold</b></h1><li class='x product-tag-item'><a><i>Nice</i> One</a></li>"
            "<p>text</p><p class='stock'><span>In</span> <span>stock</span></p>")
    pages = spark.createDataFrame([(1, "https://h.com/product/1", page)], "page_id long, url string, html string")
    row = extract(pages, "herlan_browser", "s", "https://s.com").first()
    assert (row["product_name"], row["brand_name"], row["in_stock"]) == ("Soap Gold", "Nice One", "Yes")


def test_labels_and_lists_anywhere(spark):
    page = ("<h1 itemprop='name'>Rod</h1><p>x</p><p>The <b>Product Id:</b> <span>33.1</span></p><div class='overview'>"
            "<ul class='category-info'><li>A</li></ul><p>-</p><ul class='category-info'><li>B</li></ul></div>")
    pages = spark.createDataFrame([(1, "https://r.com/product/1", page)], "page_id long, url string, html string")
    row = extract(pages, "ryans", "s", "https://s.com").first()
    assert (row["seller_sku"], row["product_description"]) == ("33.1", "AB")
    page = ("<div class='post-content'><h3 class='fw-medium'>n</h3></div><span>Category</span><a href='?category=x'>X,</a> <b>-</b> "
            "<a href='?category=y'>Y,\n</a>")
    pages = spark.createDataFrame([(1, "https://k.com/product/1", page)], "page_id long, url string, html string")
    row = extract(pages, "kireibd", "s", "https://s.com").first()
    assert (row["category_name"], row["category_slug"]) == ("Y", "y")


def test_noise_is_removed(spark):
    markup = "a<script>var t='</p>';</script>b<!-- <h1>x</h1> -->c<style>d</style>e<script>never closed"
    assert read(spark, markup, H.strip_noise) == "abce"


def test_unescape_equals_python(spark):
    given = ["&amp;lt;", "&lt;b&gt;", "&#2547;&nbsp;1,500", "&#x9F3;", "&#X41;&#65;", "a&b", "&unknown;",
             "&quot;&apos;", "&#38;lt;b&#38;gt;", "&eacute;&ccedil;&frac12;", "&#0000000065;&#x000000041;", "&", "a&&amp;;", "&#0;", "&#55296;",
             "&#1114112;", "&#99999999999;", "&copy; &middot; &hellip;", "&star; &bigstar; &NotEqualTilde;", "&amp copy", "&copy2 &copyright &notit; &notin;",
             "&amp", "&#65 &#x42x &#", "&lt&gt&quot", "&Aacute &aacute; &AMP &zwj;x", "&#128; &#150;&#x99;", "&fjlig; &Zz; &a; &z;", "&#;", "&;"]
    rows = spark.createDataFrame([(g,) for g in given], "h string").select("h", H.unescape(F.col("h")).alias("u")).collect()
    for r in rows:
        assert r["u"] == stdlib_html.unescape(r["h"]).replace("\xa0", " "), r["h"]


def test_every_name_is_known(spark):
    names = sorted(html5)
    rows = spark.createDataFrame([(f"&{n} x",) for n in names], "h string").select(H.unescape(F.col("h")).alias("u")).collect()
    assert [r["u"] for r in rows] == [html5[n].replace("\xa0", " ") + " x" for n in names]


def test_references_in_attributes(spark):
    markup = "<a href='/x?a=1&region=2&copy=3&amp;b=4&notin;&lt;&copy'>1</a>"
    assert read(spark, markup, lambda h: H.clean(H.attrs(h, tag("a", read="href")))) == ["/x?a=1&region=2&copy=3&b=4∉<©"]


@pytest.mark.parametrize("value", ["a > b > c > d", "a < b", "<b>x</b>", "1 <= 2 >= 3 it's", ">", "<"])
def test_any_value_in_quotes(spark, value):
    quote = '"'
    for markup in (f"<p>1</p><img title={quote}{value}{quote} src={quote}q.png{quote}><p>2</p>", f"<p>1</p><img title = {quote}{value}{quote} data-x='>' src='q.png' /><p>2</p>"):
        got = read(spark, markup, lambda h: H.clean(H.attr(H.strip_noise(h), tag("img", read="src"))),
                   lambda h: H.clean(H.attr(H.strip_noise(h), tag("img", read="title"))),
                   lambda h: H.clean(H.texts(H.strip_noise(h), tag("p"))))
        assert got == [["q.png"], [value], ["1", "2"]]


def test_quotes_that_are_no_values(spark):
    for markup in ("<p>5=\"five</p><a href=\"x\">t</a>", "<p title=it's>5</p><a href='x'>it's</a>", "<p>a=\"b\" > c</p><a href=x>t</a>",
                   "<p a=\"<b\"\"c\">5</p><a href=x>t</a>"):
        assert read(spark, markup, lambda h: H.clean(H.attrs(H.strip_noise(h), tag("a", read="href")))) == ["x"]


@pytest.mark.parametrize("markup", [
    "<div class='overview'>" * 20000,
    "<div " * 60000,
    "<" * 200000,
    "<script>" * 30000,
    "<li>" * 60000 + "</li>" * 60000,
    "<a href=\"" * 40000,
    "<a href='<a title=\"" * 20000,
    "<a x=\"<a x='\" y=\"" * 20000,
    "<a x=\"<\" " * 20000,
    "&#" * 100000,
    "<p class='price'>" + "<bdi>1" * 40000,
], ids=["nested", "unclosed tags", "angle", "scripts", "items", "quotes", "quotes in turn", "crossed quotes", "no end", "entities", "prices"])
def test_hostile_pages(spark, markup):
    """All rules of all profiles end on such pages, and lose nothing of the page."""
    names = [n for n in profile_names() if n in BUILT_IN]
    html = ("<h1 itemprop='name'>n</h1><div itemprop='sku'>s</div><div class='post-content'>" + markup)
    pages = spark.createDataFrame(
        [(n, f"{n}.example.com", f"https://{n}.example.com/product/x", html) for n in names],
        "profile string, domain string, url string, html string").repartition(8)
    start = time.time()
    rows = extract_products(pages, names).select("seller_name", F.xxhash64(F.struct("*")).alias("h")).collect()
    assert sorted(r["seller_name"] for r in rows) == names
    page_links(pages, names).write.format("noop").mode("overwrite").save()
    assert time.time() - start < 60


def test_pages_without_text(spark):
    pages = spark.createDataFrame(
        [(1, "https://ohsogo.example.com/product/1", None), (2, "https://lira.x/product/2", ""), (3, None, None)],
        "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in extract_products(dispatch(pages)).collect()}
    assert sorted(rows) == [1, 2]
    assert rows[1]["product_name"] == "" and rows[2]["original_price"] == ""
    assert rows[2]["currency"] == "BDT" and rows[2]["seller_product_url"] == "https://lira.x/product/2"


def test_dispatch_by_first_label(spark):
    pages = spark.createDataFrame([(1, "https://www.ryans.com/x", ""), (2, "https://ryans.com/x", "")],
                                  "page_id long, url string, html string")
    got = {r["page_id"]: r["profile"] for r in dispatch(pages).collect()}
    assert got == {1: None, 2: "ryans"}
    mapped = dispatch(pages, {"www.ryans.com": "lira"})
    assert {r["page_id"]: r["profile"] for r in mapped.collect()} == {1: "lira", 2: None}
    assert "BroadcastHashJoin" in mapped._jdf.queryExecution().executedPlan().toString()


def test_rows_of_other_profiles_are_left_alone(spark):
    page = "<h1 itemprop='name'>n</h1>"
    pages = spark.createDataFrame([(1, "https://ryans.com/x", page), (2, "https://lira.com/product", page)],
                                  "page_id long, url string, html string")
    assert [r["page_id"] for r in extract_products(dispatch(pages), ["ryans"]).collect()] == [1]


def test_own_profile(spark):
    mine = register_profile(Profile(
        "myshop", is_product=lambda page: page.has(tag("h1")),
        readings=lambda page, block: {"name": H.text(page.html, tag("h1"))},
        rules=lambda page, found: {"product_name": found.one("name"), "in_stock": F.lit("Yes")},
        slugs=("product",)))
    pages = spark.createDataFrame(
        [(1, "https://myshop.com/1", "<h1>Red Rod</h1>"), (2, "https://myshop.com/2", "<h2>x</h2>")],
        "page_id long, url string, html string")
    row, = extract(pages, mine, "Mine", "https://myshop.com").collect()
    assert (row["product_name"], row["product_slug"], row["is_active"], row["seller_name"]) == (
        "Red Rod", "red-rod", "1", "Mine")
    assert get_profile("myshop") is mine
    with pytest.raises(KeyError):
        get_profile("nope")


def test_unindexed_columns_are_rejected(spark):
    bad = Profile("bad", is_product=lambda page: F.lit(True), readings=lambda page, block: {"a": F.array(F.lit("x"))},
                  rules=lambda page, found: {"product_name": found.one("a"), "in_stock": F.lit(""), "colour": F.lit("")})
    pages = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string")
    with pytest.raises(ValueError):
        extract(pages, bad, "s", "b")


def test_recurse_option(spark):
    listing = ("<div class='category-single-product'><h4 class='product-name'><a href='/product/1'>a</a></h4></div>"
               "<h4 class='p-item-name'><a href='/p/1'>a</a><a href='/Cart/x'>b</a></h4>")
    pages = spark.createDataFrame([(1, "https://x.com/list", listing)], "page_id long, url string, html string")
    def hrefs(profile, recurse):
        return sorted(r["href"] for r in page_links(pages, profile, recurse).collect())
    assert hrefs("startech", True) == ["/p/1"] and hrefs("startech", False) == []
    assert hrefs("ryans", False) == ["/product/1"] and hrefs("kireibd", False) == ["/product/1"]
