"""Data profiles and audits."""

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.prices import is_invalid_price
from .ordered import first_rows


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)``, most frequent first, NULL left out."""
    return (df.filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "value"))


def nunique(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """One row with the number of distinct non-NULL values per column."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[distinct(F.col(c)).alias(c) for c in columns])


def distinct_sketches(df: DataFrame, columns: list[str], log2_size: int = 12) -> DataFrame:
    """One row with a sketch of the distinct non-NULL values per column, 2 to the ``log2_size``
    registers each: an error of 1.6 % with the default.

    Sketches of batches are kept and united (``united_nunique``), so a count over all batches
    reads a few KB a batch and not their rows.
    """
    return df.agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(log2_size)).alias(c) for c in columns])


def united_nunique(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the estimated number of distinct values per column, of all sketches together;
    0 without any."""
    return sketches.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.col(c))), F.lit(0)).alias(c)
                          for c in columns])


def column_profile(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, non_null, total_rows)`` in one pass over the data."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"),
                 F.col(f"_n{i}").alias("non_null"), F.col("_total").alias("total_rows"))
        for i, (c, t) in enumerate(df.dtypes)])
    return counts.select(F.inline(rows))


class StageCounts:
    """Row counts of the stages of a lazy chain, taken while it runs.

    ``df = counts.watch(df, "dedup")`` after each stage; ``counts.values()`` once an action
    on the result has finished.
    """

    def __init__(self) -> None:
        self._observations: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        observation = self._observations[stage] = Observation()
        return df.observe(observation, F.count(F.lit(1)).alias("rows"))

    def values(self) -> dict[str, int]:
        return {stage: o.get["rows"] for stage, o in self._observations.items()}


def run_summary(outcomes: DataFrame) -> DataFrame:
    """``(seller_name, outcome, n)``."""
    return outcomes.groupBy("seller_name", "outcome").agg(F.count(F.lit(1)).alias("n"))


def failure_reasons(failures: DataFrame) -> DataFrame:
    """Failures by the leading word of the reason (an exception type, mostly)."""
    return (failures.groupBy(F.regexp_extract("reason", r"^(\w+)", 1).alias("reason_type"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason_type"))


def never_scraped(failures: DataFrame, products: DataFrame,
                  key: str = "seller_product_url") -> DataFrame:
    """Failed URLs that never became a product."""
    done = products.select(F.col(key).alias("url")).distinct()
    return failures.select("url").distinct().join(done, "url", "left_anti")


def recovered(failures: DataFrame, products: DataFrame,
              key: str = "seller_product_url") -> DataFrame:
    """Failed URLs that did become a product."""
    done = products.select(F.col(key).alias("url")).distinct()
    return failures.select("url").distinct().join(done, "url", "left_semi")


def invalid_price_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_invalid_price(F.col(column)))


def null_rows(df: DataFrame, columns: list[str], show: list[str | Column]) -> DataFrame:
    """Audit projection of rows in which any of ``columns`` is NULL."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return df.filter(any_null).select(*show)


def denylisted(df: DataFrame, denylist: list[str], column: str = "brand_name") -> DataFrame:
    """Rows whose value is in a list. A hash set in the filter; nothing is shuffled."""
    return df.filter(F.col(column).isin(denylist))


def brand_sample(df: DataFrame, k: int = 2, brand: str = "brand_name",
                 seq: str = "seq") -> DataFrame:
    """First ``k`` rows per brand; ``brand_seq`` is the brand's first appearance.

    Missing brands form no sample. Order the result by ``(brand_seq, seq)``.
    """
    rows = first_rows(df.filter(F.col(brand).isNotNull()), [brand], [F.col(seq).asc()], k)
    # At most k rows per brand are left here.
    return rows.withColumn("brand_seq", F.min(seq).over(Window.partitionBy(brand)))
