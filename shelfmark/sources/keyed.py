"""A table of the latest row per key, in buckets of keys, written batch by batch.

``recent/batch=N/bucket=B`` holds what batch N wrote, ``base/bucket=B`` the latest rows of older
batches, folded. A reader that knows its keys lists and reads the buckets of those keys only.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import first_rows
from ..session import remove_folder

_PLACE = [T.StructField("batch", T.LongType()), T.StructField("bucket", T.LongType())]


class KeyedTable:
    """``schema`` has the rows' columns, ``keys`` among them.

    Buckets are dealt by the first key and within that by all keys, so a batch of one seller
    touches the buckets of that seller only, and a hot seller spans several. Choose
    ``by_first`` times ``by_all`` such that a bucket is some hundred MB.
    """

    def __init__(self, folder: str, schema: T.StructType, keys: tuple[str, ...],
                 by_first: int = 8, by_all: int = 8) -> None:
        self.folder, self.schema, self.keys = folder, schema, list(keys)
        self.by_first, self.by_all = by_first, by_all

    def bucket(self, keys: list[str] | None = None) -> Column:
        columns = [F.col(k) for k in keys or self.keys]
        first = F.pmod(F.xxhash64(columns[0]), F.lit(self.by_first))
        return first * self.by_all + F.pmod(F.xxhash64(*columns), F.lit(self.by_all))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The batch's rows, one per key; written again, they replace what the batch wrote."""
        named = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        (named.withColumn("bucket", self.bucket()).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/recent/batch={batch_id}"))

    def _part(self, spark: SparkSession, part: str, buckets: list[int] | None) -> DataFrame | None:
        """Rows of ``base`` or ``recent``; None if there are none."""
        root = f"{self.folder}/{part}"
        names = "" if buckets is None else "/bucket={" + ",".join(map(str, buckets)) + "}"
        path = root + ("/batch=*" if part == "recent" and names else "") + names
        schema = T.StructType([*self.schema.fields, *_PLACE])
        try:
            return spark.read.schema(schema).option("basePath", root).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def versions(self, spark: SparkSession, before: int | None = None,
                 buckets: list[int] | None = None) -> DataFrame | None:
        """All stored rows with their ``batch`` and ``bucket``, of older batches than ``before``
        if given; None if there are no files."""
        if buckets == []:
            return None
        parts = [p for p in (self._part(spark, part, buckets) for part in ("base", "recent")) if p is not None]
        if not parts:
            return None
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return rows if before is None else rows.filter(F.col("batch") < before)

    def buckets_of(self, items: DataFrame) -> list[int]:
        """The buckets of the items' keys: as many numbers at most as the table has buckets."""
        return sorted(r[0] for r in items.select(self.bucket()).distinct().collect())

    def latest(self, spark: SparkSession, before: int | None = None,
               items: DataFrame | None = None) -> DataFrame | None:
        """The last row per key; ``items`` limits it to the buckets and then to the keys that
        the items have, before versions are resolved."""
        rows = self.versions(spark, before, None if items is None else self.buckets_of(items))
        if rows is None:
            return None
        if items is not None:
            wanted = items.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
            rows = rows.join(wanted, same, "left_semi")
        return self._resolved(rows).drop("batch", "bucket")

    def _resolved(self, rows: DataFrame) -> DataFrame:
        return first_rows(rows, self.keys, [F.col("batch").desc()])

    def fold(self, spark: SparkSession, before: int) -> None:
        """Moves the batches older than ``before`` into ``base``, which keeps one row per key.

        Only the buckets those batches wrote are rewritten. Folded batches must not be repeated
        any more. A fold that is cut off leaves both copies, which read as one; the next fold
        removes the rest.
        """
        recent = self._part(spark, "recent", None)
        if recent is None:
            return
        recent = recent.filter(F.col("batch") < before)
        places = recent.select("batch", "bucket").distinct().collect()
        if not places:
            return
        base = self._part(spark, "base", sorted({r["bucket"] for r in places}))
        rows = recent if base is None else base.unionByName(recent)
        (self._resolved(rows).repartition("bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.folder}/base"))
        for batch in sorted({r["batch"] for r in places}):
            remove_folder(spark, f"{self.folder}/recent/batch={batch}")
