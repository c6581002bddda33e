"""Structured Streaming jobs. All run with ``availableNow`` and resume from a checkpoint."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import normalize_value
from ..operators.changes import KEYS, classify_change, latest_per_url, split_keyed, written
from ..operators.extract import dispatch, extract_all
from ..schema import PRODUCT_COLUMNS
from ..session import cut
from ..sources.keyed import KeyedTable
from ..sources.snapshots import fold_snapshot, read_snapshot, write_batch


def digest(columns: list[str]):
    """Fingerprint of the normalised fields; their lengths come first, so that no two
    different rows make the same text."""
    fields = [normalize_value(F.col(c)) for c in columns]
    sizes = [F.length(f).cast("string") for f in fields]
    return F.sha2(F.concat_ws("\x1f", *sizes, *fields), 256)


def _fold_now(batch_id: int, fold_every: int | None) -> bool:
    """Whether older micro-batches, all of them done, are due to be folded."""
    return bool(fold_every and batch_id and batch_id % fold_every == 0)


def changes_of_stream(items: DataFrame, folder: str, checkpoint: str, seq: str = "seq",
                      compare: list[str] | None = None, buckets: tuple[int, int] = (8, 8),
                      fold_every: int | None = 20) -> StreamingQuery:
    """Writes the observations of a stream with their ``kind``, by micro-batch, to ``folder/log``.

    Known versions are a table of keys and fingerprints, ``folder/seen``, in ``buckets`` of keys
    (by seller, times by URL). A micro-batch reads the buckets of its own keys only and adds the
    versions it has written. Every ``fold_every`` micro-batches those before are folded to one
    row per key. A replayed micro-batch starts from the versions before it and replaces what it
    wrote. Micro-batches must come in ``seq`` order.
    """
    compare = compare or [c for c in PRODUCT_COLUMNS if c in items.columns and c not in KEYS]

    def classify(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marked = cut(batch.withColumn("_digest", digest(compare)))
        state = T.StructType([*[marked.schema[k] for k in KEYS], T.StructField("_digest", T.StringType())])
        table = KeyedTable(f"{folder}/seen", state, KEYS, *buckets)
        if _fold_now(batch_id, fold_every):
            table.fold(spark, batch_id)
        keyed, _ = split_keyed(marked)
        kinds = classify_change(marked, table.latest(spark, batch_id, keyed), seq=seq, compare=["_digest"])
        log = f"{folder}/log/batch={batch_id}"
        kinds.write.mode("overwrite").parquet(log)
        kinds = spark.read.schema(kinds.schema).parquet(log)
        table.write(latest_per_url(written(kinds), (seq,)), batch_id)

    return (items.writeStream.foreachBatch(classify)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def ingest_stream(items: DataFrame, folder: str, checkpoint: str, seq: str = "seq",
                  fold_every: int | None = 20) -> StreamingQuery:
    """Change log and snapshot of a stream.

    ``folder/log/batch=N`` holds the classified rows of a micro-batch, written once and read
    back for the snapshot; a replay starts from the versions before it and replaces what it
    wrote. Every ``fold_every`` micro-batches the snapshot folds those before.
    """
    def ingest(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = cut(batch)
        if _fold_now(batch_id, fold_every):
            fold_snapshot(spark, f"{folder}/snapshot", batch_id)
        known = read_snapshot(spark, f"{folder}/snapshot", batch_id, batch)
        kinds = classify_change(batch, known, seq=seq)
        log = f"{folder}/log/batch={batch_id}"
        kinds.write.mode("overwrite").parquet(log)
        kinds = spark.read.schema(kinds.schema).parquet(log)
        write_batch(written(kinds), f"{folder}/snapshot", batch_id, seq)

    return (items.writeStream.foreachBatch(ingest)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def to_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to Parquet; a rerun with the same checkpoint takes only what is new."""
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def outcomes_of_stream(pages: DataFrame, domains: dict[str, str] | None = None) -> DataFrame:
    """Products and failures of pages as they land."""
    return extract_all(dispatch(pages, domains))


def upsert_stream(items: DataFrame, folder: str, checkpoint: str, seq: str = "seq",
                  fold_every: int | None = 20) -> StreamingQuery:
    """Keeps a snapshot current. A replayed micro-batch replaces its own partition; every
    ``fold_every`` micro-batches those before are folded."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        if _fold_now(batch_id, fold_every):
            fold_snapshot(batch.sparkSession, folder, batch_id)
        write_batch(batch, folder, batch_id, seq)

    return (items.writeStream.foreachBatch(upsert)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def distinct_urls_of_stream(links: DataFrame, seen_at: str | None = None,
                            within: str | None = None) -> DataFrame:
    """Each URL once.

    Without ``within`` the state holds every URL seen; size it for the crawl. With it a URL is
    forgotten that long after the sighting that was kept (by the time in ``seen_at``), so the
    state is bounded by the URLs of that span: a URL that comes back later counts as found
    again, and a sighting that lands after the watermark has passed it is dropped. The
    watermark lies ``within`` behind the latest time of the micro-batches before.
    """
    if within is None:
        return links.select("url").dropDuplicates(["url"])
    if seen_at is None:
        raise ValueError("a span needs the column with the time of the sighting")
    return (links.select("url", seen_at).withWatermark(seen_at, within)
            .dropDuplicatesWithinWatermark(["url"]))
