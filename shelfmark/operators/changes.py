"""Change detection, stop rules and the latest-version snapshot."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, normalize_value
from ..schema import PRODUCT_COLUMNS, SNAPSHOT_COLUMNS
from .ordered import first_rows, running_counts, with_previous

URL = "seller_product_url"
# What makes two observations versions of one item.
KEYS = ("seller_name", URL)


def split_keyed(items: DataFrame, key: str = URL) -> tuple[DataFrame, DataFrame]:
    """Rows with a key, and rows without one, which belong to the failures."""
    return items.filter(~blank(F.col(key))), items.filter(blank(F.col(key)))


def classify_change(items: DataFrame, known: DataFrame | None = None,
                    keys: tuple[str, ...] = KEYS, seq: str = "seq",
                    compare: list[str] | None = None, slices: int | None = None) -> DataFrame:
    """Adds ``kind``: ``new``, ``update`` or ``duplicate``.

    An observation is compared with the one before it under the same key. That equals
    comparing with the last written version, since a duplicate equals that version.
    ``known`` holds versions from earlier runs; they count as seen and are not returned.
    """
    keys = list(keys)
    compare = compare or [c for c in PRODUCT_COLUMNS if c in items.columns and c not in keys]
    items, _ = split_keyed(items)
    order = [seq]
    if known is not None:
        earlier = known.select(
            *keys, *[(F.col(c) if c in known.columns else F.lit(None)).cast("string").alias(c)
                     for c in compare]).withColumn("_generation", F.lit(0))
        # Earlier versions lead whatever the positions are; one per key is all that is needed.
        items = items.withColumn("_generation", F.lit(1)).unionByName(earlier, allowMissingColumns=True)
        order = ["_generation", seq]
    seen = with_previous(items, keys, order, compare, slices)
    changed = F.lit(False)
    for c in compare:
        changed = changed | (normalize_value(F.col(c)) != normalize_value(F.col("_prev")[c]))
    kind = (F.when(F.col("_prev").isNull(), "new").when(changed, "update").otherwise("duplicate"))
    seen = seen.withColumn("kind", kind).drop("_prev")
    return seen.filter(F.col("_generation") == 1).drop("_generation") if known is not None else seen


def stop_points(kinds: DataFrame, max_duplicates: int | None = None,
                max_items: int | None = None, group: str = "seller_name", seq: str = "seq",
                slices: int | None = None) -> DataFrame:
    """Per seller the position at which a run stops; sellers that never stop are absent.

    A run stops at the ``max_duplicates``-th duplicate in a row (or the first one, if that is
    0) or at the ``max_items``-th written row, whichever comes first. None turns a rule off,
    0 the item limit too; without a rule no seller stops.
    """
    counts = running_counts(kinds, group, seq, F.col("kind") != "duplicate", slices)
    reached = F.lit(False)
    if max_duplicates is not None:
        reached = reached | (~F.col("_write") & (F.col("idle") >= max_duplicates))
    if max_items:
        reached = reached | (F.col("_write") & (F.col("writes") >= max_items))
    return counts.filter(reached).groupBy(group).agg(F.min("seq").alias("stop_seq"))


def left_out(kinds: DataFrame, stops: DataFrame, group: str = "seller_name",
             seq: str = "seq") -> DataFrame:
    """Per seller that stops, how many rows lie behind its stop."""
    return (kinds.join(stops, group).groupBy(group, "stop_seq")
            .agg(F.count_if(F.col(seq) > F.col("stop_seq")).alias("n_left_out")))


def until_stop(kinds: DataFrame, stops: DataFrame, group: str = "seller_name",
               seq: str = "seq") -> DataFrame:
    """Rows a run still sees: up to and including the stopping one."""
    return (kinds.join(stops, group, "left")
            .filter(F.col("stop_seq").isNull() | (F.col(seq) <= F.col("stop_seq")))
            .drop("stop_seq"))


def written(kinds: DataFrame) -> DataFrame:
    return kinds.filter(F.col("kind") != "duplicate")


def change_counts(kinds: DataFrame, group: str = "seller_name") -> DataFrame:
    return kinds.groupBy(group, "kind").agg(F.count(F.lit(1)).alias("n"))


def latest_per_url(log: DataFrame, order: tuple[str | Column, ...] = ("seq",),
                   keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Last version per seller and non-empty URL, or per those of the keys the table has."""
    newest_first = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    present = [k for k in keys if k in log.columns]
    return first_rows(log.filter(~blank(F.col(URL))), present, newest_first)


def as_snapshot(latest: DataFrame, stamp: Column | None = None) -> DataFrame:
    """The stored form: URL first, absent product columns NULL, time of writing last."""
    stamp = F.current_timestamp() if stamp is None else stamp
    present = set(latest.columns)
    return latest.select(
        *[F.col(c) if c in present else F.lit(None).cast("string").alias(c)
          for c in SNAPSHOT_COLUMNS[:-1]],
        stamp.alias("last_updated"))


def upsert_snapshot(snapshot: DataFrame, items: DataFrame, seq: str = "seq") -> DataFrame:
    """Replaces whole rows by seller and URL: columns the new row lacks become NULL, not merged."""
    fresh = as_snapshot(latest_per_url(items, (seq,)))
    both = (snapshot.withColumn("_generation", F.lit(0))
            .unionByName(fresh.withColumn("_generation", F.lit(1))))
    return latest_per_url(both, ("_generation",)).drop("_generation")


def match_existing(items: DataFrame, snapshot: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Each item with its stored version in ``stored``, NULL when there is none."""
    stored = snapshot.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct("*").alias("stored"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return items.join(stored, same, "left").drop(*[f"_{k}" for k in keys])
