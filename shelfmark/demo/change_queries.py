"""Change detection, stop rules and snapshots over crawl observations."""

from pyspark.sql import functions as F

from ..operators import changes
from ..plans.ingest import apply_stop_rules, ingest_run
from ..session import new_folder
from ..sources.snapshots import fold_snapshot, read_snapshot, write_batch
from .catalog import query
from .views import view

# What an observation is compared by, as text.
_SIGNATURE = ("coalesce(trim(product_name), '') || chr(31) || coalesce(trim(current_price), '')"
              " || chr(31) || coalesce(trim(in_stock), '')")

KINDS = f"""
, signed as (select *, {_SIGNATURE} as sig from crawl_items),
kinds as (
  select *, case when lag(sig) over w is null then 'new' when lag(sig) over w <> sig then 'update'
                 else 'duplicate' end as kind
  from signed window w as (partition by seller_name, seller_product_url order by seq))"""

RUNS = """
, runs as (
  select *, sum(case when kind <> 'duplicate' then 1 else 0 end) over w as writes from kinds
  window w as (partition by seller_name order by seq rows unbounded preceding)),
idle as (
  select *, row_number() over (partition by seller_name, writes order by seq)
            - case when writes = 0 then 0 else 1 end as idle from runs)"""

_COLUMNS = "seq, crawl_ts, seller_name, seller_product_url, product_name, current_price, in_stock"

MAX_DUPLICATES = 5
MAX_ITEMS = 400


def _kinds(spark, sf_dir):
    return changes.classify_change(view(spark, sf_dir, "crawl_items"))


@query("classify_change", ("crawl_items",), KINDS + f" select {_COLUMNS}, kind from kinds")
def _classify(spark, sf_dir):
    return _kinds(spark, sf_dir)


@query("change_counts", ("crawl_items",), KINDS + """
select seller_name, kind, count(*) as n from kinds group by all""")
def _counts(spark, sf_dir):
    return changes.change_counts(_kinds(spark, sf_dir))


@query("duplicate_stop", ("crawl_items",), KINDS + RUNS + f"""
, stops as (select seller_name, min(seq) as stop_seq from idle where idle >= {MAX_DUPLICATES} group by all)
select {_COLUMNS}, kind from kinds left join stops using (seller_name)
where stop_seq is null or seq <= stop_seq""")
def _duplicate_stop(spark, sf_dir):
    return apply_stop_rules(_kinds(spark, sf_dir), MAX_DUPLICATES)


@query("item_limit_stop", ("crawl_items",), KINDS + RUNS + f"""
, stops as (select seller_name, min(seq) as stop_seq from idle
            where idle >= 1000 or (kind <> 'duplicate' and writes >= {MAX_ITEMS}) group by all)
select {_COLUMNS}, kind from kinds left join stops using (seller_name)
where (stop_seq is null or seq <= stop_seq) and kind <> 'duplicate'""")
def _item_limit(spark, sf_dir):
    return changes.written(apply_stop_rules(_kinds(spark, sf_dir), 1000, MAX_ITEMS))


@query("stop_points", ("crawl_items",), KINDS + RUNS + f"""
select seller_name, min(seq) as stop_seq from idle
where idle >= {MAX_DUPLICATES} or (kind <> 'duplicate' and writes >= {MAX_ITEMS}) group by all""")
def _stop_points(spark, sf_dir):
    return changes.stop_points(_kinds(spark, sf_dir), MAX_DUPLICATES, MAX_ITEMS)


LATEST = """
select * from crawl_items
qualify row_number() over (partition by seller_name, seller_product_url order by seq desc) = 1"""


@query("latest_snapshot", ("crawl_items",), LATEST)
def _latest(spark, sf_dir):
    return changes.latest_per_url(view(spark, sf_dir, "crawl_items"))


def _two_crawls(spark, sf_dir):
    """All observations in two runs; the second lacks the stock column."""
    items = view(spark, sf_dir, "crawl_items")
    middle = items.agg(F.max("seq")).scalar() / 2
    return items.filter(F.col("seq") <= middle), items.filter(F.col("seq") > middle).drop("in_stock")


@query("upsert_snapshot", ("crawl_items",), """
, halves as (select *, seq > (select max(seq) from crawl_items) / 2 as late from crawl_items)
select seller_product_url, seller_name, product_name, current_price,
  case when late then null else in_stock end as in_stock
from halves qualify row_number() over (partition by seller_name, seller_product_url order by seq desc) = 1""")
def _upsert(spark, sf_dir):
    """Rows of the second run replace whole rows: their stock is NULL, not merged."""
    first, second = _two_crawls(spark, sf_dir)
    snapshot = changes.as_snapshot(changes.latest_per_url(first))
    return changes.upsert_snapshot(snapshot, second).select(
        "seller_product_url", "seller_name", "product_name", "current_price", "in_stock")


@query("snapshot_table", ("crawl_items",), """
, halves as (select *, seq > (select max(seq) from crawl_items) / 2 as late from crawl_items)
select seller_product_url, seller_name, product_name, current_price,
  case when late then null else in_stock end as in_stock
from halves qualify row_number() over (partition by seller_name, seller_product_url order by seq desc) = 1""")
def _store(spark, sf_dir):
    """The same through a table with a partition per run."""
    folder = new_folder(spark, "snapshot")
    for batch_id, items in enumerate(_two_crawls(spark, sf_dir)):
        write_batch(items, folder, batch_id)
    return read_snapshot(spark, folder).select(
        "seller_product_url", "seller_name", "product_name", "current_price", "in_stock")


@query("snapshot_fold", ("crawl_items",), f"""

select seller_product_url, seller_name, product_name, current_price, in_stock from ({LATEST})""")
def _fold(spark, sf_dir):
    """Four runs; the first three are folded into one row per key, the last one is repeated."""
    folder, items = new_folder(spark, "folded"), view(spark, sf_dir, "crawl_items")
    quarter = F.least(F.floor(F.col("seq") * 4 / items.agg(F.max("seq")).scalar()), F.lit(3))
    for batch_id in range(4):
        write_batch(items.filter(quarter == batch_id), folder, batch_id)
    fold_snapshot(spark, folder, 3)
    write_batch(items.filter(quarter == 3), folder, 3)
    return read_snapshot(spark, folder).select(
        "seller_product_url", "seller_name", "product_name", "current_price", "in_stock")


@query("match_existing", ("crawl_items",), """
, halves as (select *, seq > (select max(seq) from crawl_items) / 2 as late from crawl_items),
stored as (select * from halves where not late
           qualify row_number() over (partition by seller_name, seller_product_url order by seq desc) = 1)
select i.seq, i.current_price as price_now, s.current_price as price_before
from halves i left join stored s using (seller_name, seller_product_url) where i.late""")
def _match(spark, sf_dir):
    first, second = _two_crawls(spark, sf_dir)
    snapshot = changes.as_snapshot(changes.latest_per_url(first))
    return changes.match_existing(second, snapshot).select(
        "seq", F.col("current_price").alias("price_now"),
        F.col("stored.current_price").alias("price_before"))


@query("classify_resumed", ("crawl_items",), KINDS + """
select seq, seller_product_url, kind from kinds where seq > (select max(seq) from crawl_items) / 2""")
def _resumed(spark, sf_dir):
    """A second run that starts from the versions the first one left."""
    items = view(spark, sf_dir, "crawl_items")
    middle = items.agg(F.max("seq")).scalar() / 2
    known = changes.latest_per_url(items.filter(F.col("seq") <= middle))
    return changes.classify_change(items.filter(F.col("seq") > middle), known).select(
        "seq", "seller_product_url", "kind")


@query("classify_resumed_negative", ("crawl_items",), KINDS + """
select seq - 1000000000 as seq, seller_product_url, kind from kinds
where seq > (select max(seq) from crawl_items) / 2""")
def _resumed_negative(spark, sf_dir):
    """The same with positions below zero: stored versions lead whatever the positions are."""
    items = view(spark, sf_dir, "crawl_items").withColumn("seq", F.col("seq") - 1000000000)
    middle = (items.agg(F.max("seq")).scalar() - 1000000000) / 2
    known = changes.latest_per_url(items.filter(F.col("seq") <= middle))
    return changes.classify_change(items.filter(F.col("seq") > middle), known).select(
        "seq", "seller_product_url", "kind")


@query("ingest_run", ("crawl_items",), KINDS + RUNS + f"""
, stops as (select seller_name, min(seq) as stop_seq from idle
            where idle >= 50 or (kind <> 'duplicate' and writes >= {MAX_ITEMS}) group by all)
select {_COLUMNS}, kind from kinds left join stops using (seller_name)
where (stop_seq is null or seq <= stop_seq) and kind <> 'duplicate'""")
def _ingest(spark, sf_dir):
    """A whole run; the result is read back from the change log."""
    folder = new_folder(spark, "ingest")
    ingest_run(view(spark, sf_dir, "crawl_items"), folder, 0, 50, MAX_ITEMS)
    return spark.read.parquet(f"{folder}/log").drop("batch")
