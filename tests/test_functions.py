"""Scalar rules, row by row against plain Python or stated results."""

from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import brands, flags, gallery, prices, text, urls


def apply(spark, rule, *columns):
    """The rule's value for each row of zipped columns."""
    rows = [(i, *row) for i, row in enumerate(zip(*columns))]
    names = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join(["i int", *[f"{n} string" for n in names]])
    df = spark.createDataFrame(rows, schema).repartition(2)
    out = df.select("i", rule(*[F.col(n) for n in names]).alias("v")).collect()
    return [r["v"] for r in sorted(out, key=lambda r: r["i"])]


SPACES = [chr(i) for i in range(0x110000) if chr(i).isspace()]
DIRTY = ["", " ", "a", "  a b ", "\ta\n", " x ", "\x1cq\x1f", "a　b", "জেল, ক্রিম",
         "Café Noir 2", "x--y  z", "A&B", None, "​zero"] + [f"{s}k{s}" for s in SPACES]


def test_strip_equals_python(spark):
    assert apply(spark, text.strip, DIRTY) == [None if v is None else v.strip() for v in DIRTY]


def test_slugs(spark):
    assert apply(spark, text.slug_basic, DIRTY) == [
        None if v is None else v.lower().replace(" ", "-") for v in DIRTY]
    assert apply(spark, text.slug_trim, DIRTY) == [
        "" if not v else v.lower().strip().replace(" ", "-") for v in DIRTY]
    kept = ["".join(ch for ch in v if ch.isalnum() or ch.isspace()) if v is not None else None
            for v in DIRTY]
    assert apply(spark, text.slug_alnum, DIRTY) == [
        None if v is None else v.replace(" ", "-").lower() for v in kept]


def test_words(spark):
    assert apply(spark, text.first_word, DIRTY) == [
        (v.split() or [None])[0] if v is not None else None for v in DIRTY]
    assert apply(spark, lambda c: text.nth_token(c, " ", 2), ["Based on 12 reviews", "0", ""]) == [
        "12", "0", ""]
    assert apply(spark, lambda c: text.nth_token(c, "/", 0), ["4.2/5", "n"]) == ["4.2", "n"]


def test_categories(spark):
    assert apply(spark, text.drop_all_prefix, ["All Laptop", "Allergy", "Mall", None]) == [
        "Laptop", "ergy", "Mall", None]
    assert apply(spark, text.long_category_to_accessories, ["x" * 18, "x" * 19, None]) == [
        "x" * 18, "Accessories", None]


def test_numbers(spark):
    given = ["12.5", " 12 ", "1e3", ".5", "5.", "-3", "12.5d", "12f", "1_000", "inf", "NaN", "", "a", None]
    assert apply(spark, prices.to_number, given) == [
        12.5, 12.0, 1000.0, 0.5, 5.0, -3.0, None, None, None, None, None, None, None, None]
    assert apply(spark, prices.is_invalid_price, ["12", "12.5", ".5", "1.2.3", "৳ 5", "", None]) == [
        False, False, False, True, True, True, False]
    assert apply(spark, prices.first_int, ["Reviews (22)", "none", None, "1,200"]) == [22, 0, 0, 1]
    assert apply(spark, prices.digits_only, ["1,200 reviews", "none"]) == ["1200", ""]
    assert apply(spark, prices.clean_price, ["৳ 1,250", "Tk 68,000", " 5 "]) == ["1250", "68000", "5"]
    assert apply(spark, prices.mrp_or_sale, ["MRP ৳1,500", "", "none"], ["9", "9", "9"]) == [
        "1500", "9", "9"]


@pytest.mark.parametrize("rule,expected", [
    (prices.pair_second, [("", ""), ("", "1"), ("2", "1"), ("2", "1")]),
    (prices.pair_fallback, [("", ""), ("1", "1"), ("2", "1"), ("2", "1")]),
    (prices.pair_reversed, [("", ""), ("1", "1"), ("1", "2"), ("1", "2")]),
    (prices.triple, [("", ""), ("1", "1"), ("", "1"), ("3", "1")]),
])
def test_price_pairs(spark, rule, expected):
    given = ["", "1", "1|2", "1|2|3"]
    got = apply(spark, lambda c: F.struct(*rule(F.filter(F.split(c, "[|]"), lambda p: p != ""))), given)
    assert [tuple(r) for r in got] == expected


def test_flags(spark):
    assert apply(spark, lambda c: flags.stock_flag(c, "In Stock"), ["In Stock (3)", "in stock", None]) == [
        "Yes", "No", "No"]
    assert apply(spark, lambda c: flags.stock_unless(c, "out of stock"), ["Out of Stock", "", None]) == [
        "No", "Yes", "Yes"]
    assert apply(spark, flags.active_flag, ["Yes", "YES", "No", ""]) == ["1", "1", "0", "0"]


def test_gallery(spark):
    given = ["data:x|https://a/1-150x150.jpg| https://a/1.jpg|https://a/1.jpg|https://a/2.jpg"]
    got = apply(spark, lambda c: gallery.gallery_clean(F.split(c, "[|]")), given)
    assert got == [["https://a/1.jpg", "https://a/2.jpg"]]


def test_brands(spark):
    assert len(brands.BRAND_DENYLIST) == len(set(brands.BRAND_DENYLIST)) == 100
    brand = ["Mederma", " Acme Ltd. ", None, "No Brand", ",", "Tradewind", "Foo L.L.C", "nan", ""]
    name = ["x", "Buy 2 Soap bar", "Mederma, gel", "Dr. Rashel oil", "The Ordinary, serum", "y",
            "Bar: one", None, "   "]
    assert apply(spark, brands.fix_brand_name, brand, name) == [
        "Mederma", "Soap", "Mederma", "Dr. Rashel", "The Ordinary", "Tradewind", "Bar", "Unknown",
        "Unknown"]
    assert apply(spark, brands.brand_from_denylist, [None, "Smart", "Asus", None],
                 ["HP 15", "Lenovo X", "Asus Y", " "]) == ["HP", "Lenovo", "Asus", None]


HREFS = ["", "/a", "a", "../a", "./a", "a/../b", "/a/./b/../c", "../../../x", "?q=1", "#f", "//h.com/x",
         "http://z.com/y", "a?x=1#y", "/p/?a=../b", "b/", "..", ".", "../", "a/..", "mailto:x@y.z",
         "javascript:void(0)", "a//b"]
BASES = ["https://s.com/c/d?x=1#y", "https://s.com", "http://s.com/", "https://s.com/a/b/", "https://s.com/q"]


def test_url_join_equals_python(spark):
    base, href = zip(*[(b, h) for b in BASES for h in HREFS])
    got = apply(spark, urls.url_join, base, href)
    expected = [urljoin(b, h) for b, h in zip(base, href)]
    assert [x for x in zip(base, href, got, expected) if x[2] != x[3]] == []


def test_base_url_equals_python(spark):
    given = ["https://www.a.com/b/c?d", "HTTP://User@A.com:80/x", "a.b", "//h/x", "mailto:x", "",
             "https://a.com", " https://b.com/x", "https://দোকান.com/x"]
    expected = [f"{urlparse(u).scheme}://{urlparse(u).netloc}/" for u in given]
    assert apply(spark, urls.base_url, given) == expected
    assert apply(spark, urls.base_url, [None]) == [""]


def test_make_absolute(spark):
    base = "https://s.com/c/d"
    given = ["", "  ", "#x", "//h/x", "/p", " /p ", "https://z/q", "mailto:a", "rel", "javascript:x"]
    assert apply(spark, lambda h: urls.make_absolute(h, F.lit(base)), given) == [
        None, None, None, "https://h/x", "https://s.com/p", "https://s.com/p", "https://z/q", None,
        None, None]


def test_other_urls(spark):
    assert apply(spark, urls.canonical_url, ["https://a/b?c#d", "https://a/b#d?c", "x"]) == [
        "https://a/b", "https://a/b", "x"]
    assert apply(spark, urls.strip_last_path, ["https://h/a/b", "https://h", "x"]) == [
        "https://h/a", "https:/", "x"]
    assert apply(spark, urls.url_last_segment, ["https://h/a/b?x=/1", "https://h/a/?q"]) == ["1", ""]
    assert apply(spark, lambda u: urls.next_page_url(u, F.lit(4)), [
        "https://h/a", "https://h/a?b=1", "https://h/a?page=4&b=1", "https://h/a?b=1&page=4#x"]) == [
        "https://h/a?page=5", "https://h/a?b=1&page=5", "https://h/a?page=5&b=1", "https://h/a?b=1&page=5#x"]
    assert apply(spark, lambda u: urls.in_domain(u, "a.com"), [
        "https://a.com/x", "https://www.A.com:8080/", "https://ba.com", "https://a.com.b/"]) == [
        True, True, False, False]
    assert apply(spark, lambda u: urls.after_token(u, "brand="), ["/s?brand=x&brand=y", "/s"]) == ["y", None]
