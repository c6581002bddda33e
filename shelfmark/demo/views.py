"""Inputs derived by SQL from the driver's tables, whole tables always.

The text is valid in Spark SQL and in DuckDB, so a query and its check read the same rows.
"""

from pyspark.sql import DataFrame, SparkSession

from ..session import new_folder

_ITEM = "(p_partkey - p_partkey % 4 + least(p_partkey % 4, 2))"

VIEWS: dict[str, str] = {}

# Dirty product rows. Every fourth row repeats a URL; some have none.
VIEWS["raw_products"] = f"""
select p_partkey as seq,
  case when p_partkey % 97 = 0 then null else
    'https://shop' || cast({_ITEM} % 4 as string) || '.example.com/c/item-' || cast({_ITEM} as string)
    || case when {_ITEM} % 5 = 0 then '?ref=x' else '' end end as seller_product_url,
  case when p_partkey % 23 = 0 then null when p_partkey % 13 = 0 then 'Buy 2 ' || p_name
       when p_partkey % 17 = 0 then 'Dr. ' || p_name || ',' when p_partkey % 19 = 0 then 'জেল, ' || p_name
       else p_brand || ': ' || p_name end as product_name,
  case when p_partkey % 10 = 0 then null when p_partkey % 10 = 1 then 'No Brand' when p_partkey % 10 = 2 then 'Square Pharma Ltd.'
       when p_partkey % 10 = 3 then 'USB Cable' when p_partkey % 10 = 4 then ',' else p_brand end as brand_name,
  case when p_partkey % 9 = 0 then null when p_partkey % 9 = 1 then 'All ' || p_type when p_partkey % 9 = 2 then 'Health & Beauty'
       when p_partkey % 9 = 3 then 'Gaming Desktop Component' else p_type end as category_name,
  case when p_partkey % 29 = 0 then null when p_partkey % 31 = 0 then 'Call for price'
       else '৳ ' || cast(1 + p_partkey % 90 as string) || ',' || lpad(cast(p_size as string), 3, '0') end as current_price,
  case when p_partkey % 4 = 0 then null else cast(p_partkey % 900 as string) || '.5' end as original_price,
  case when p_partkey % 6 = 0 then null else 'Reviews (' || cast(p_size as string) || ')' end as review_count,
  case when p_partkey % 3 = 0 then 'No' else 'Yes' end as in_stock,
  'https://www.example.com/' || lower(p_type) as base_url,
  case when p_partkey % 12 = 0 then 'size' else '' end as variation_type
from part
"""

# A second crawl: even keys override known URLs, odd keys are new ones.
VIEWS["price_patch"] = f"""
select p_partkey as seq,
  case when p_partkey % 2 = 0 then
    'https://shop' || cast({_ITEM} % 4 as string) || '.example.com/c/item-' || cast({_ITEM} as string)
    || case when {_ITEM} % 5 = 0 then '?ref=x' else '' end
    else 'https://shop9.example.com/c/new-' || cast(p_partkey as string) end as seller_product_url,
  p_brand || ': ' || p_name as product_name, cast(p_size * 100 as string) as current_price,
  case when p_partkey % 21 = 0 then null else cast(p_size * 110 as string) end as original_price
from part
"""

VIEWS["vendor_feed"] = """
select p_partkey as seq,
  case when p_partkey % 23 = 0 then null when p_partkey % 13 = 0 then 'Buy 2 ' || p_name when p_partkey % 17 = 0 then 'The ' || p_name || ','
       else p_name || ' ' || cast(p_size as string) || 'ml' end as title,
  cast(p_size * 10 as string) as sale_price,
  case when p_partkey % 2000 = 1777 then 'n/a' else 'https://feed.example.com/product/' || cast(p_partkey as string) end as link,
  cast(p_size * 12 as string) as price,
  case when p_partkey % 8 = 0 then null else 'https://cdn.example.com/' || cast(p_partkey as string) || '.jpg' end as primary_image_url,
  'https://cdn.example.com/a.jpg' || chr(10) || 'https://cdn.example.com/b.jpg' as image_urls,
  case when p_partkey % 7 = 0 then null when p_partkey % 7 = 1 then ' ' when p_partkey % 7 = 2 then cast(p_size % 3 as string)
       when p_partkey % 7 = 3 then cast(p_size as string) || '.0' when p_size % 2 = 0 then 'True' else 'False' end as stock,
  case when p_partkey % 10 = 0 then null when p_partkey % 10 = 1 then 'no brand' when p_partkey % 10 = 2 then 'Acme International'
       when p_partkey % 10 = 3 then 'Tradewind' when p_partkey % 10 = 4 then ' , ' else p_brand end as brand,
  'Line one' || chr(10) || 'line two ' as description,
  cast(p_size % 5 as string) as rating, case when p_partkey % 5 = 0 then null else p_size end as reviews
from part
"""

# Time-ordered observations of products.
VIEWS["crawl_items"] = """
select event_id as seq, ts as crawl_ts, 'seller-' || cast(user_id % 4 as string) as seller_name,
  'https://shop' || cast(user_id % 4 as string) || '.example.com/product/item-' || cast(user_id as string) as seller_product_url,
  case when event_id % 11 = 0 then '  Item ' || cast(user_id as string) || ' ' else 'Item ' || cast(user_id as string) end as product_name,
  case when value < 5 then '' else cast(cast(floor(value / 40) * 100 as bigint) as string) end as current_price,
  case when event_type = 'error' then 'No' else 'Yes' end as in_stock
from events
"""

# Known and new URLs in pairs, with blanks and heading words.
VIEWS["url_list"] = """
select p_partkey as seq, case when p_partkey % 50 = 0 then '  ' when p_partkey % 50 = 1 then 'URL'
  else 'https://shop' || cast((p_partkey - p_partkey % 2) % 4 as string) || '.example.com/product/item-'
    || cast(p_partkey - p_partkey % 2 as string) end as url
from part
"""

# Price texts of one page joined by a bar.
VIEWS["price_cells"] = """
select p_partkey as seq,
  case p_partkey % 4 when 0 then '' when 1 then '৳ 1,0' || cast(10 + p_size as string)
    when 2 then '৳ 2,500|৳ 1,0' || cast(10 + p_size as string) else '৳ 3,000|Save 10%|৳ ' || cast(p_size as string) end as prices,
  'BDT 1,2' || cast(10 + p_size as string) as prefixed_price,
  case when p_partkey % 3 = 0 then '' else 'MRP ৳' || cast(p_size as string) || ',500' end as mrp_text, cast(p_size as string) as sale_price
from part
"""

VIEWS["gallery_cells"] = """
select p_partkey as seq, 'data:image/gif;base64,R0|https://c.example.com/' || cast(p_size as string) || '-150x150.jpg| https://c.example.com/'
  || cast(p_size as string) || '.jpg |https://c.example.com/b.jpg|https://c.example.com/' || cast(p_size as string) || '.jpg||' as imgs
from part
"""

# Shop markup per profile number, as the profiles expect it.
_MARKUP = {
    0: """'<h1 itemprop="name"> ' || p_name || ' </h1><p><b>Product Id:</b> <span>33.01.' || cast(p_partkey as string) || '</span></p><span class="new-sp-text">Tk 1,' || lpad(cast(p_size as string),3,'0') || '</span><span class="new-reg-text">Tk 2,' || lpad(cast(p_size as string),3,'0') || '</span><img class="slideshow-items active" alt="big > small" src="https://cdn.example.com/' || cast(p_partkey as string) || '.jpg"><div class="card-body"><div class="d-flex"><a itemtype="http://schema.org/Thing" href="/">Home</a><a itemtype="http://schema.org/Thing" href="/c">All ' || p_type || '</a><a itemtype="http://schema.org/Thing" href="/b">' || p_brand || '</a><a itemtype="http://schema.org/Thing" href="/p">' || p_name || '</a></div></div><div class="overview"><ul class="category-info"><li> Alpha </li><li></li></ul><p>and</p><ul class="category-info"><li>Beta</li></ul></div>' || repeat('<div class="qna-body">r</div>', cast(p_size % 3 as int)) || '<link itemprop="availability" href="https://schema.org/' || case when p_size > 10 then 'InStock' else 'OutOfStock' end || '">'""",
    1: """'<section><div><ul><li><a href="/"><span>Home</span></a></li><li><a href="/c"><span>' || p_type || '</span></a></li></ul></div></section><div>bar</div><div>menu</div><div>ad</div><div>path</div><div class="product-details"><div><div><div>left</div><div><div><div><div><a href="/zoom"><img src="https://cdn.example.com/s' || cast(p_partkey as string) || '.jpg"></a></div></div></div></div></div></div><h1 class="product-name">' || p_name || '</h1><table><td class="product-price"><del>900</del> 1,' || lpad(cast(p_size as string),3,'0') || '৳</td><td class="product-regular-price">2,000৳</td><td class="product-status">' || case when p_size > 10 then 'In Stock' else 'Out Of Stock' end || '</td><td class="product-code">' || cast(p_partkey as string) || '</td></table><div id="write-review"><div><div><h2>Reviews (' || cast(p_size as string) || ')</h2></div></div></div></div>'""",
    2: """'<nav class="woocommerce-breadcrumb"><a href="/">Home</a><a href="/s">Shop</a><a href="/c">' || p_type || '</a></nav><h1 class="product_title entry-title">' || p_name || ' &#0000000038; Co</h1><a class="woocommerce-main-image pswp-main-image zoom" href="/z"><img src="https://c.example.com/l.jpg"></a><p class="price"><bdi>৳ 2,000</bdi>' || case when p_size > 10 then '<bdi><span class="sym">&#2547;&nbsp;</span>1,' || lpad(cast(p_size as string),3,'0') || '</bdi>' else '' end || '</p><span class="product_brand"><a href="/b">' || p_brand || '</a></span><span class="sku">L' || cast(p_partkey as string) || '</span><div aria-labelledby="tab-title-description"><div><p> One </p></div><p>Two</p></div><div>after</div>'""",
    3: """'<nav class="woocommerce-breadcrumb"><a href="/">Home</a><a href="/c">' || p_type || '</a></nav><h1 class="product_title entry-title">' || p_name || '</h1><li itemprop="associatedMedia"><img src="data:image/gif;base64,R0"></li><li itemprop="associatedMedia"><img src="https://c.example.com/' || cast(p_size as string) || '-150x150.jpg"></li><li itemprop="associatedMedia"><img src="https://c.example.com/' || cast(p_size as string) || '.jpg"></li><p class="price"><bdi>৳ 2,000</bdi>' || case when p_size > 10 then '<bdi>৳ 1,500</bdi>' else '' end || '</p><li class="product-tag-item"><a href="/t">' || p_brand || '</a></li>' || case when p_size % 2 = 0 then '<p class="stock">In stock</p>' else '' end || '<div class="cg-accordion-item"><b>Info</b> text</div>'""",
    4: """'<div class="post-content"><h3 class="fw-medium">' || p_name || '</h3><div class="post-content__price"><h3 class="fw-medium">৳ 1,' || lpad(cast(p_size as string),3,'0') || '</h3><del>৳ 2,000</del></div><div class="post-content__brand"><a href="/shop?brand=' || replace(lower(p_brand),'#','-') || '">' || p_brand || '</a><strong>Barcode</strong>: ' || chr(10) || '  880' || cast(p_partkey as string) || '</div><span>Category</span><a href="/shop?category=a">A,</a> <i>and</i> <a href="/shop?category=' || lower(p_type) || '">' || p_type || ',' || chr(10) || '</a><div class="rating"><button>' || cast(p_size as string) || ' Reviews</button></div>' || case when p_size > 40 then '<span class="trk-btn--stock-out">Out of Stock</span>' else '' end || '<img src="https://cdn.kireibd.com/storage/all/' || cast(p_partkey as string) || '.png"><div class="product-details__content"><p>One</p><p> Two </p></div></div>'""",
    5: """'<div class="breadcrumbs"><ul><li><a href="/">Home</a></li><li><a href="/c">' || p_type || '</a></li><li><a href="/p">' || p_name || '</a></li></ul></div><h1 class="page-title"><span>' || p_name || '</span></h1><div itemprop="sku">SKU: ' || chr(10) || ' ' || cast(p_partkey as string) || '</div><div id="MagicToolboxSelectors1"><a href="https://c.example.com/1.jpg"></a><a href="https://c.example.com/2.jpg"></a></div><div class="product-info-custom"><span class="price">BDT1,' || lpad(cast(p_size as string),3,'0') || '</span><span class="price">BDT2,000</span></div><div id="brand_name">' || p_brand || '</div><span itemprop="reviewCount">1,' || lpad(cast(p_size as string),3,'0') || ' reviews</span><div id="description"><p>One</p></div>'""",
    6: """'<h1 class="product__heading h2"><span>' || p_name || '</span></h1><price-money><bdi>৳1,' || lpad(cast(p_size as string),3,'0') || '</bdi></price-money>' || case when p_size > 10 then '<price-money><bdi>৳2,000</bdi></price-money>' else '' end || '<thumbnail-slider><img src="https://c.example.com/a.jpg"><img src="https://c.example.com/b.jpg"></thumbnail-slider><div class="accordion__content rte">Soft text</div><span class="jdgm-rev-widg__summary-average"><b>4.5</b> out of 5</span><div class="jdgm-rev-widg__summary-text jdgm-all-reviews__summary-text--verified">Based on ' || cast(p_size as string) || ' reviews</div>'""",
    7: """'<div class="mt-2 title-full fs-6">' || p_name || '</div><div class="title fw-bold fs-5"><a href="/b"><b>' || p_brand || '</b></a></div><span class="fw-semibold">৳ 2,000</span>' || case when p_size > 10 then '<span class="fw-semibold">10% off</span>' else '' end || case when p_size > 20 then '<span class="fw-semibold">৳ 1,800</span>' else '' end || '<span class="ms-1 m-fs-6 fs-6">' || case when p_size % 2 = 0 then '<b>Add</b> to Cart' else 'Stock Out' end || '</span><ul id="shortDesc"><li>Short</li></ul><div class="swiper-slide-visible" data-swiper-slide-index="0"><img src="https://c.example.com/7.jpg"></div><div data-swiper-slide-index="1"><img data-src="https://c.example.com/8.jpg"></div>'""",
    8: """'<span class="text-sm text-brand">' || p_brand || '</span><div class="text-sm whitespace-nowrap text-gray-500 line-through product_single_mrp_generate">' || case when p_size > 10 then 'MRP ৳1,500' else '' end || '</div><img alt="Image 1" src="https://c.example.com/1.jpg"><img alt="Image 2" src="https://c.example.com/1.jpg">' || case when p_size % 2 = 0 then '<span><i></i>Add To <b>Cart</b></span>' else '' end || '<div class="mt-4">Desc</div><span class="text-gray-700">4.2/5</span><div class="text-sm text-gray-500">' || cast(p_size as string) || ' Ratings</div>'""",
    9: """case when p_partkey % 40 = 39 then '<p>empty</p>' else '<div class="category-single-product"><h4 class="product-name"><a href="/product/item-' || cast(p_partkey - 9 as string) || '?x=1#top">a</a></h4><h4 class="product-name"><a href="/product/item-' || cast(p_partkey - 9 as string) || '?x=1#top">dup</a></h4><h4 class="product-name"><a href="//shop9.example.com/product/item-' || cast(p_partkey % 100 as string) || '">b</a></h4></div><a href="javascript:void(0)">j</a><a href="/cart">c</a><a href="mailto:a@example.com">m</a><a href="#x">h</a><a href="http://other.example.org/product/1">o</a><ul><li class="page-item"><a href="?category=' || lower(p_type) || '&page=' || cast(p_size + 1 as string) || '" rel="next">n</a></li></ul><h4 class="p-item-name"><a href="/st-' || cast(p_partkey as string) || '">s</a><a href="/account/x">acc</a></h4><ul class="pagination"><li><a href="/st?page=2">2</a></li></ul><h2 class="product-title"><a href="/li-' || cast(p_partkey as string) || '">l</a></h2><a class="woocommerce-LoopProduct-link" href="/li-' || cast(p_partkey as string) || '"></a><a class="next page-numbers" href="/li/page/2">n</a><div class="woocommerce-loop-product__title"><a href="/he-' || cast(p_partkey as string) || '">h</a></div><a aria-label="Next" href="/he?page=2">n</a><li class="item product product-item"><div><div><a href="/ba-' || cast(p_partkey as string) || '">b</a></div></div></li><a class="action  next" href="/ba?p=2">n</a><a class="action  next" href="/ba?p=3">n</a><a href="/tm-' || cast(p_partkey as string) || '"><div class="image-container text-center">t</div></a><div class="card-product_title line-clamp"><a href="/oh-' || cast(p_partkey as string) || '">o</a></div>' end""",
}

# Host name per profile number; the first label names the profile.
SHOPS = {0: "ryans", 1: "startech", 2: "lira", 3: "herlan", 4: "kireibd", 5: "banglashoppers",
         6: "ohsogo", 7: "themallbd", 8: "feedshop", 9: "listing"}

VIEWS["product_pages"] = (
    "select p_partkey as page_id, p_partkey % 10 as shop,\n"
    "  'https://' || case p_partkey % 10 "
    + " ".join(f"when {n} then '{name}'" for n, name in SHOPS.items())
    + " end || '.example.com' || case when p_partkey % 10 = 9 then '/shop?category=' || lower(p_type)"
      " || '&page=' || cast(p_size as string) || '&id=' || cast(p_partkey as string)"
      " else '/product/item-' || cast(p_partkey as string) end as url,\n"
      "  '<!DOCTYPE html><html><head><script>var t=\"</p>\";</script></head><body>' || case p_partkey % 10\n"
    + "\n".join(f"  when {n} then {markup}" for n, markup in _MARKUP.items())
    + "\n  end || '</body></html>' as html,\n"
      "  p_name, p_brand, p_type, p_size, p_partkey\nfrom part"
)

# Links found per source and page number; some sources only repeat old links at the end.
VIEWS["listing_pages"] = """
select distinct 'https://shop' || cast(user_id as string) || '.example.com/list' as source_url, 1 + event_id % 12 as page_num,
  'https://shop' || cast(user_id as string) || '.example.com/product/item-'
    || cast(case when event_id % 12 < 4 + 2 * (user_id % 6) then (event_id % 12) * 10 + event_id % 5 else event_id % 5 end as string) as product_url
from events
"""

# Sightings of links by six-day period; some land in the last period only, long after they were made.
VIEWS["link_sightings"] = """
select url, period, case when event_id % 97 = 0 then 4 else period end as landed from (
  select event_id, 'https://shop' || cast(user_id % 4 as string) || '.example.com/product/item-' || cast(user_id as string)
      || '-' || cast(event_id % 20 as string) as url,
    cast(floor((day(ts) - 1) / 6) as int) % 5 as period
  from events) as dated
"""

VIEWS["failure_lines"] = """
select event_id as seq, case when event_id % 9 = 8 then '  (continuation of the stack trace)' else
  '[2026-03-' || lpad(cast(1 + event_id % 28 as string), 2, '0') || ' 01:26:50]' || case when event_id % 2 = 0 then '  ' else ' ' end
  || 'https://shop' || cast(user_id % 4 as string) || '.example.com/product/item-' || cast(user_id as string) || case when event_id % 2 = 0 then '  |  ' else ' | ' end
  || case event_id % 3 when 0 then 'Parser returned None' when 1 then 'IndexError: list index out of range' else 'MaxRetryError: pool exhausted' end end as line
from events
"""

_TABLES = ("part", "events")


def view(spark: SparkSession, sf_dir: str, name: str, deal: str = "") -> DataFrame:
    """``deal`` (a ``distribute by``) spreads the rows of the tables over tasks before anything is
    made of them: a few MB of parquet are one task's otherwise, whatever grows out of them."""
    text = VIEWS[name]
    for table in _TABLES:
        rows = f"parquet.`{sf_dir}/{table}.parquet`"
        text = text.replace(f"from {table}", f"from (select * from {rows} {deal})" if deal else f"from {rows}")
    return spark.sql(text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LANDED: dict[tuple[str, str], str] = {}


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as a crawler would have left them: a table of files, landed once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        folder = new_folder(spark, "pages")
        # A crawler closes a file after so many pages.
        view(spark, sf_dir, "product_pages", "distribute by p_partkey").write.option("maxRecordsPerFile", 2500).parquet(folder)
        _LANDED[key] = folder
    return spark.read.parquet(_LANDED[key])
