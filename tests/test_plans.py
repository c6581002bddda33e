"""Whole jobs on small, dirty inputs."""

from pyspark.sql import functions as F

from shelfmark.operators.profiling import StageCounts, brand_sample, column_profile
from shelfmark.plans.clean import clean_feed, clean_ryans, clean_startech
from shelfmark.plans.crawl import crawl_round
from shelfmark.schema import FEED_COLUMNS, PRODUCT_COLUMNS

PRODUCTS = ("seq long, seller_product_url string, product_name string, brand_name string, category_name string, "
            "current_price string, original_price string, review_count string, in_stock string, base_url string")


def products(spark):
    return spark.createDataFrame([
        (0, "https://a/x?q", "HP 15s", "Laptop", "All Laptop", "৳ 68,000", "70,000", "Reviews (22)", "Yes", "https://a/laptop"),
        (1, "https://a/x?q", "HP 15s new", None, "All Laptop", "Tk 69,000", "", "none", "Yes", "https://a/laptop"),
        (2, "https://a/y", None, "Smart", None, "Call", None, None, "Yes", None),
        (3, None, "Lenovo IdeaPad", "The", "A very long category name", "5", "6", "1", "No", "https://a/b/c"),
        (4, None, "Dell", None, "R&B Audio", "inf", "12d", "Reviews", "Yes", "x"),
    ], PRODUCTS)


def test_clean_ryans(spark):
    rows = {r["seq"]: r for r in clean_ryans(products(spark)).collect()}
    assert sorted(rows) == [1, 2, 4]
    assert (rows[1]["category_name"], rows[1]["category_slug"]) == ("Laptop", "laptop")
    assert (rows[1]["current_price"], rows[1]["original_price"], rows[1]["in_stock"]) == (69000.0, 0.0, "NO")
    assert (rows[1]["brand_name"], rows[1]["brand_slug"]) == ("HP", "hp")
    assert (rows[2]["category_name"], rows[2]["category_slug"], rows[2]["brand_name"]) == (
        "Uncategorized", "uncategorized", "Smart")
    assert (rows[4]["current_price"], rows[4]["category_slug"]) == (0.0, "rb-audio")


def test_clean_startech(spark):
    patch = spark.createDataFrame([(0, "https://a/x?q", "HP 15s", "65,000", "৳70,000"), (1, "https://a/new", "Acer", "1", None)],
                                  "seq long, seller_product_url string, product_name string, current_price string, original_price string")
    counts = StageCounts()
    rows = {(r["src"], r["seq"]): r for r in clean_startech(products(spark), patch, counts=counts).collect()}
    assert sorted(rows) == [(0, 3), (1, 0), (1, 1)]
    assert counts.values() == {"dedup": 3, "named": 2, "patched": 3}
    fixed = rows[1, 0]
    assert (fixed["current_price"], fixed["product_slug"], fixed["brand_slug"], fixed["review_count"]) == (
        65000.0, "x", "hp", 0)
    kept = rows[0, 3]
    assert (kept["category_name"], kept["category_slug"], kept["base_url"], kept["seller_slug"]) == (
        "Accessories", "accessories", "https://a/b", "star-tech")


def test_clean_feed_takes_any_text(spark):
    feed = spark.createDataFrame([
        (0, "Soap, 50ml", "10", "https://a.com/p/1", "12", None, "i\nj", "True", "no brand", " a\nb ", "4", "3.0"),
        (1, None, "x", None, None, "p", None, "n/a", None, None, None, "many"),
    ], "seq long, " + ", ".join(f"{c} string" for c in FEED_COLUMNS))
    df = clean_feed(feed, "My Shop")
    assert df.columns == ["seq", *PRODUCT_COLUMNS]
    a, b = df.orderBy("seq").collect()
    assert (a["brand_name"], a["review_count"], a["stock_quantity"], a["in_stock"], a["base_url"]) == (
        "Soap", 3, 1, True, "https://a.com/")
    assert (a["image_urls"], a["product_description"], a["seller_slug"]) == ("i j", "a b", "my-shop")
    assert (b["brand_name"], b["review_count"], b["in_stock"], b["base_url"], b["model"]) == (
        "Unknown", 0, False, "", None)


def test_brand_sample_order(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "b"), (4, None), (5, "a")], "seq int, brand_name string")
    got = [(r["brand_name"], r["seq"]) for r in brand_sample(df).orderBy("brand_seq", "seq").collect()]
    assert got == [("b", 0), ("b", 2), ("a", 1), ("a", 5)]


def test_column_profile(spark):
    got = {r["column_name"]: (r["non_null"], r["total_rows"]) for r in column_profile(products(spark)).collect()}
    assert got["seller_product_url"] == (3, 5) and got["seq"] == (5, 5)


def test_crawl_round(spark):
    listing = ("<div class='category-single-product'><h4 class='product-name'><a href='/p/2'>a</a></h4>"
               "<h4 class='product-name'><a href='/p/1'>seen</a></h4>"
               "<h4 class='product-name'><a href='https://other.org/p'>away</a></h4></div>")
    pages = spark.createDataFrame([
        (1, "https://www.ryans.com/p/1", "<h1 itemprop='name'>Rod</h1>"),
        (2, "https://www.ryans.com/list", listing),
        (3, "https://unknown.com/x", "<h1>y</h1>")], "page_id long, url string, html string")
    done = crawl_round(pages, pages, "ryans.com", {"www.ryans.com": "ryans"})
    assert [r["product_name"] for r in done.products.collect()] == ["Rod"]
    assert {r["url"]: r["reason"] for r in done.failures.collect()} == {
        "https://www.ryans.com/list": "Parser returned None", "https://unknown.com/x": "No parser found"}
    assert [r["url"] for r in done.next_urls.collect()] == ["https://www.ryans.com/p/2"]


def test_cleaning_twice_changes_nothing(spark):
    from shelfmark.functions import prices, text
    df = products(spark).select(F.explode(F.array("current_price", "original_price", "brand_name")).alias("c"))
    for rule in (lambda c: prices.clean_price(c, "৳"), prices.to_number, text.slug_trim, text.strip_lines):
        once = df.select(rule(F.col("c")).cast("string").alias("c"))
        twice = once.select("c", rule(F.col("c")).cast("string").alias("d"))
        assert twice.filter(~F.col("c").eqNullSafe(F.col("d"))).count() == 0


def test_pages_are_landed_by_several_tasks(spark, tmp_path):
    """A table that fits one row group is dealt out before its pages are made of it."""
    from shelfmark.demo.views import product_pages
    part = spark.read.parquet("/root/testdata/sf0.1/part.parquet")
    many = part.crossJoin(spark.range(6)).withColumn("p_partkey", F.col("p_partkey") + 20_000 * F.col("id")).drop("id")
    many.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    landed = product_pages(spark, str(tmp_path))
    names = landed.select(F.input_file_name().alias("f")).distinct().collect()
    assert len({r["f"].rsplit("/", 1)[1][:10] for r in names}) > 1
    assert landed.agg(F.count("*"), F.count_distinct("url")).first() == (120_000, 120_000)
