"""URLs a crawl has visited: a table in hash buckets that only grows.

Bucketed by URL, so that an anti join against it moves the new URLs only; the table, which is
the large side, is read where its buckets lie and never shuffled.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Choose them once, such that a bucket is some hundred MB when the crawl is done.
BUCKETS = 64


class VisitedUrls:
    """A catalogue table ``name`` with its files in ``folder`` (or the warehouse)."""

    def __init__(self, spark: SparkSession, name: str, folder: str | None = None,
                 buckets: int = BUCKETS) -> None:
        self.spark, self.name, self.folder, self.buckets = spark, name, folder, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        """``(url, batch)``; a URL may stand there more than once."""
        return self.spark.table(self.name)

    def add(self, urls: DataFrame, batch_id: int) -> None:
        """Appends the distinct URLs of a round, one file a bucket.

        A round that is repeated adds its URLs again, which changes no difference.
        """
        rows = urls.select("url").filter(F.col("url").isNotNull()).distinct().withColumn(
            "batch", F.lit(batch_id).cast("bigint"))
        writer = (rows.repartition(self.buckets, "url").write.mode("append").format("parquet")
                  .bucketBy(self.buckets, "url").sortBy("url"))
        if self.folder:
            writer = writer.option("path", self.folder)
        writer.saveAsTable(self.name)

    def unvisited(self, found: DataFrame) -> DataFrame:
        """Distinct found URLs that are not in the table.

        The found ones are dealt to as many partitions as the table has buckets, each of which
        is then joined where it lies.
        """
        fresh = found.select("url").filter(F.col("url").isNotNull())
        if not self.exists():
            return fresh.distinct()
        # Without the hint a table of a first small round would be sent to all tasks.
        dealt = fresh.distinct().repartition(self.buckets, "url")
        return dealt.join(self.read().select("url").hint("merge"), "url", "left_anti")

    def pending(self, listed: DataFrame) -> DataFrame:
        """Rows of a list that are not in the table, duplicates kept.

        A URL that the list repeats is looked up once. Rows without one stay.
        """
        fresh = listed.join(self.unvisited(listed), "url", "left_semi")
        return fresh.unionByName(listed.filter(F.col("url").isNull()))
