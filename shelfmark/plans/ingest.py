"""One ingestion run: classify, stop, log, snapshot."""

from pyspark.sql import DataFrame

from ..operators.changes import (
    classify_change, split_keyed, stop_points, until_stop, written,
)
from ..session import cut
from ..sources.snapshots import read_snapshot, write_batch


def apply_stop_rules(kinds: DataFrame, max_duplicates: int | None = None,
                     max_items: int | None = None, group: str = "seller_name") -> DataFrame:
    """Rows a run sees before it stops; all of them if no rule is given.

    The classified rows are written once and read twice, the first time three columns only.
    ``changes.left_out`` counts what lies behind the stops.
    """
    if max_duplicates is None and not max_items:
        return kinds
    kinds = cut(kinds)
    return until_stop(kinds, stop_points(kinds, max_duplicates, max_items, group), group)


def ingest_run(items: DataFrame, folder: str, batch_id: int, max_duplicates: int | None = None,
               max_items: int | None = None) -> DataFrame:
    """Logs the changes of a run, upserts the snapshot and returns the changes.

    Items are computed once. Those without a URL go to the failures. Everything a run writes
    is a partition of its ``batch_id``: a repeated run starts from the versions before it and
    replaces what it wrote.
    """
    spark = items.sparkSession
    keyed, keyless = split_keyed(cut(items))
    known = read_snapshot(spark, f"{folder}/snapshot", batch_id, keyed)
    seen = written(apply_stop_rules(classify_change(keyed, known), max_duplicates, max_items))
    log = f"{folder}/log/batch={batch_id}"
    seen.write.mode("overwrite").parquet(log)
    changes = spark.read.schema(seen.schema).parquet(log)
    keyless.write.mode("overwrite").parquet(f"{folder}/failures/batch={batch_id}")
    write_batch(changes, f"{folder}/snapshot", batch_id)
    return changes
