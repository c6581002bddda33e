"""Row deduplication in file order, and the patch merge."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import first_rows

URL = "seller_product_url"


def dedup_keep_first(df: DataFrame, key: str = URL, seq: str = "seq") -> DataFrame:
    """First row per key; rows without a key are one group."""
    return first_rows(df, [key], [F.col(seq).asc()])


def dedup_keep_last(df: DataFrame, key: str = URL, seq: str = "seq") -> DataFrame:
    return first_rows(df, [key], [F.col(seq).desc()])


def patch_merge(base: DataFrame, patch: DataFrame, key: str = URL, seq: str = "seq") -> DataFrame:
    """Both tables by column name, the last row per key kept, so the patch wins.

    ``src`` (0 base, 1 patch) and ``seq`` give the order of the result.
    """
    both = (base.withColumn("src", F.lit(0))
            .unionByName(patch.withColumn("src", F.lit(1)), allowMissingColumns=True))
    return first_rows(both, [key], [F.col("src").desc(), F.col(seq).desc()])
