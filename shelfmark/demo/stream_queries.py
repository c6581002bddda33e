"""Streams, run to the end of their input; results equal those of the batch twins."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import make_absolute
from ..operators.extract import all_anchors, products_of
from ..session import new_folder
from ..sources import readers
from ..sources.snapshots import read_snapshot
from ..streaming import jobs
from .catalog import query
from .change_queries import KINDS, LATEST, _COLUMNS
from .link_queries import _ANCHORS
from .page_queries import EXPECTED, product_sql
from .views import product_pages, table, view

SLICES = 2


def landing(spark: SparkSession, df: DataFrame, seq: str, run, slices: int = SLICES) -> None:
    """Lands a table slice by slice in ``seq`` order; ``run(folder)`` follows each slice."""
    folder = new_folder(spark, "landing")
    low, high = df.agg(F.min(seq), F.max(seq)).first()
    width = (high - low) // slices + 1
    for k in range(slices):
        begin = low + k * width
        (df.filter(F.col(seq).between(begin, begin + width - 1))
         .write.mode("append").parquet(folder))
        run(folder)


@query("stream_change_detection", ("crawl_items",), KINDS + f" select {_COLUMNS}, kind from kinds")
def _changes(spark, sf_dir):
    """State lasts over two runs: the second takes up the checkpoint of the first."""
    items = view(spark, sf_dir, "crawl_items")
    out, checkpoint = new_folder(spark, "changes"), new_folder(spark, "checkpoint")

    def run(folder: str) -> None:
        stream = readers.stream_table(spark, folder, items.schema)
        jobs.changes_of_stream(stream, out, checkpoint).awaitTermination()

    landing(spark, items, "seq", run)
    return spark.read.parquet(f"{out}/log").drop("batch", "_digest")


@query("stream_snapshot", ("crawl_items",),
       f"select seller_product_url, seller_name, product_name, current_price, in_stock from ({LATEST})")
def _snapshot(spark, sf_dir):
    items = view(spark, sf_dir, "crawl_items")
    out = new_folder(spark, "stream-snapshot")
    checkpoint = new_folder(spark, "checkpoint")

    def run(folder: str) -> None:
        stream = readers.stream_table(spark, folder, items.schema)
        jobs.upsert_stream(stream, out, checkpoint).awaitTermination()

    landing(spark, items, "seq", run)
    return read_snapshot(spark, out).select(
        "seller_product_url", "seller_name", "product_name", "current_price", "in_stock")


@query("stream_ingest", ("crawl_items",), KINDS + f" select {_COLUMNS}, kind from kinds")
def _ingest(spark, sf_dir):
    """The same with the batch operators in each micro-batch."""
    items = view(spark, sf_dir, "crawl_items")
    out, checkpoint = new_folder(spark, "stream-ingest"), new_folder(spark, "checkpoint")

    def run(folder: str) -> None:
        stream = readers.stream_table(spark, folder, items.schema)
        jobs.ingest_stream(stream, out, checkpoint).awaitTermination()

    landing(spark, items, "seq", run)
    return spark.read.parquet(f"{out}/log").drop("batch")


@query("stream_link_dedup", (), f"with {_ANCHORS} select distinct url from absolute")
def _links(spark, sf_dir):
    found = all_anchors(table(spark, sf_dir, "pages"))
    links = found.select("source_url", make_absolute(F.col("href"), F.col("source_url")).alias("url"))
    source, out = new_folder(spark, "links"), new_folder(spark, "urls")
    links.filter("url is not null").write.parquet(source)
    stream = readers.stream_table(spark, source, "source_url string, url string")
    jobs.to_files(jobs.distinct_urls_of_stream(stream), out,
                  new_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.schema("url string").parquet(out)


_PERIODS = 5
# What a period adds: not late by two periods or more, and not kept in the period before.
_KEPT = ",\n".join(
    f"kept{k} as (select distinct url from link_sightings where landed = {k} and period > {k} - 2"
    + (f" and url not in (select url from kept{k - 1})" if k else "") + ")" for k in range(_PERIODS))


@query("stream_link_window", ("link_sightings",), f", {_KEPT}\n" + "\nunion all\n".join(
    f"select url from kept{k}" for k in range(_PERIODS)))
def _link_window(spark, sf_dir):
    """URLs remembered for two days, landed in periods of six: one that comes back after a
    period is found again, one that lands late is dropped."""
    sightings = view(spark, sf_dir, "link_sightings").withColumn(
        "seen_at", F.timestamp_seconds(F.lit(1704067200) + F.col("period") * 6 * 86400))
    out, checkpoint = new_folder(spark, "window"), new_folder(spark, "checkpoint")

    def run(folder: str) -> None:
        stream = readers.stream_table(spark, folder, sightings.schema)
        found = jobs.distinct_urls_of_stream(stream, "seen_at", "2 days")
        jobs.to_files(found, out, checkpoint).awaitTermination()

    landing(spark, sightings, "landed", run, _PERIODS)
    return spark.read.schema("url string").parquet(out)


@query("stream_items", ("product_pages",),
       "\nunion all\n".join(product_sql(shop, fields) for shop, fields in EXPECTED.items()))
def _items(spark, sf_dir):
    """Products from pages as they land."""
    out, checkpoint = new_folder(spark, "outcomes"), new_folder(spark, "checkpoint")
    pages = product_pages(spark, sf_dir).select("page_id", "url", "html")
    schema = None

    def run(folder: str) -> None:
        nonlocal schema
        outcomes = jobs.outcomes_of_stream(readers.stream_pages(spark, folder))
        schema = outcomes.schema
        jobs.to_files(outcomes, out, checkpoint).awaitTermination()

    landing(spark, pages, "page_id", run)
    return products_of(spark.read.schema(schema).parquet(out))
