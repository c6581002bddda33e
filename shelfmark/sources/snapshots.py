"""The latest-version table: plain files in buckets of keys, with a partition per recent batch."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.changes import KEYS, as_snapshot, latest_per_url
from ..schema import SNAPSHOT_COLUMNS
from .keyed import KeyedTable

_SCHEMA = T.StructType([
    *[T.StructField(c, T.StringType()) for c in SNAPSHOT_COLUMNS[:-1]],
    T.StructField(SNAPSHOT_COLUMNS[-1], T.TimestampType())])


def snapshot_table(folder: str) -> KeyedTable:
    return KeyedTable(folder, _SCHEMA, KEYS)


def write_batch(items: DataFrame, folder: str, batch_id: int, seq: str = "seq") -> None:
    """The last row per key of a batch as the batch's partition; written again, it replaces it.

    An upsert thus costs as much as its batch.
    """
    snapshot_table(folder).write(as_snapshot(latest_per_url(items, (seq,))), batch_id)


def read_snapshot(spark: SparkSession, folder: str, before: int | None = None,
                  items: DataFrame | None = None) -> DataFrame | None:
    """The last version per key, None if there is no table; ``before`` leaves out that batch
    and later ones.

    ``items`` limits it to the buckets of their keys, and to those keys before versions are
    resolved, so that a small batch neither lists nor shuffles the whole table.
    """
    return snapshot_table(folder).latest(spark, before, items)


def fold_snapshot(spark: SparkSession, folder: str, before: int) -> None:
    """Folds the batches older than ``before`` into one row per key, so that reads do not grow
    with the number of batches. They must not be repeated any more."""
    snapshot_table(folder).fold(spark, before)
