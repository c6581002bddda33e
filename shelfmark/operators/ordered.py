"""Order-dependent operators that never put an unbounded group into one task.

Every table has a ``seq``: a position, unique within its group. Rows are dealt to slices by
ranges of (group, ``seq``), which Spark samples, so that slices are of even size whatever the
values and however hot a group is. Windows run inside slices, and one small row per slice (and
group) carries totals from slice to slice.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def in_slices(df: DataFrame, order: list[str], slices: int | None = None) -> DataFrame:
    """Adds ``_slice``, written once: slices follow one another in ``order``.

    Their number is that of shuffle partitions, unless given. The range shuffle reads its
    input twice, once to sample it, so cut an input that is costly to compute.
    """
    ranged = df.repartitionByRange(*([slices] if slices else []), *order)
    return cut(ranged.withColumn("_slice", F.spark_partition_id()))


def first_rows(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows per key.

    Catalyst puts a group limit in front of the shuffle, so each map task sends at most
    ``k`` rows of a key, however hot it is.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def with_previous(df: DataFrame, keys: list[str], seq: str | list[str], columns: list[str],
                  slices: int | None = None) -> DataFrame:
    """Adds ``_prev``: ``seq`` and ``columns`` of the row before, per key in ``seq`` order.

    ``seq`` may be several columns, the first one leading. NULL is a key like any other. The
    first row of a slice takes the last row of the slice before it, which is one row per slice.
    """
    order = [seq] if isinstance(seq, str) else seq
    carried = [*order, *[c for c in columns if c not in order]]
    fields = [*keys, *[c for c in carried if c not in keys]]
    sliced = in_slices(df, [*keys, *order], slices)
    ends = sliced.groupBy("_slice").agg(
        F.max_by(F.struct(*fields), F.struct(*keys, *order)).alias("_end"))
    carry = ends.select(
        "_slice", F.lag("_end").over(Window.orderBy("_slice")).alias("_carry"))
    w = Window.partitionBy("_slice").orderBy(*keys, *order)
    # One lag per existing column: nothing is added to the shuffled rows.
    inside = F.struct(*[F.lag(c).over(w).alias(c) for c in fields])
    before = F.when(F.col("_place") > 1, F.col("_inside")).otherwise(F.col("_carry"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col("_before")[k].eqNullSafe(F.col(k))
    prev = F.struct(*[F.col("_before")[c].alias(c) for c in carried])
    return (sliced.withColumn("_inside", inside).withColumn("_place", F.row_number().over(w))
            .join(carry, "_slice").withColumn("_before", before)
            .select(*df.columns,
                    F.when(F.col("_before").isNotNull() & same, prev).alias("_prev")))


def row_index(df: DataFrame, seq: str = "seq", lead: list[str] | None = None,
              out: str = "row_index", slices: int | None = None) -> DataFrame:
    """1-based position in the order ``(*lead, seq)``, over the whole table."""
    order = [*(lead or []), seq]
    sliced = in_slices(df, order, slices)
    # One row per slice, not per data row.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    w = Window.partitionBy("_slice").orderBy(*order)
    return (sliced.withColumn("_rn", F.row_number().over(w)).join(offsets, "_slice")
            .withColumn(out, (F.col("_offset") + F.col("_rn")).cast("bigint"))
            .drop("_slice", "_rn", "_offset"))


def chunk_number(index: Column, size: int) -> Column:
    """1-based chunk of a 1-based position."""
    return F.call_function("div", index - 1, F.lit(size)) + 1


def take_while(df: DataFrame, keep: Column, seq: str = "seq") -> DataFrame:
    """Rows before the first one that fails ``keep``."""
    first_bad = df.filter(~F.coalesce(keep, F.lit(False))).agg(F.min(seq)).scalar()
    return df.filter(F.coalesce(F.col(seq) < first_bad, F.lit(True)))


def running_counts(df: DataFrame, group: str, seq: str, write: Column,
                   slices: int | None = None, carried: list[str] | None = None) -> DataFrame:
    """Per row: writes so far and rows since the last write, within its group.

    Returns ``(group, seq, _write, *carried, writes, idle)``; rows without a group are left out.
    """
    carried = carried or []
    narrow = df.select(group, F.col(seq).alias("seq"), write.alias("_write"), *carried).filter(
        F.col(group).isNotNull() & F.col("seq").isNotNull())
    narrow = in_slices(narrow, [group, "seq"], slices)
    w = (Window.partitionBy(group, "_slice").orderBy("seq")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = (narrow.withColumn("_pos", F.row_number().over(w))
             .withColumn("_w", F.sum(F.col("_write").cast("bigint")).over(w))
             .withColumn("_last", F.max(F.when(F.col("_write"), F.col("_pos"))).over(w)))
    totals = local.groupBy(group, "_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_w").alias("_wn"), F.max("_last").alias("_ln"))
    before = (Window.partitionBy(group).orderBy("_slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        totals.withColumn("_rows0", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_writes0", F.coalesce(F.sum("_wn").over(before), F.lit(0)))
        .withColumn("_last0", F.coalesce(
            F.max(F.col("_rows0") + F.col("_ln")).over(before), F.lit(0)))
        .select(group, "_slice", "_rows0", "_writes0", "_last0")
    )
    position = F.col("_rows0") + F.col("_pos")
    last_write = F.coalesce(F.col("_rows0") + F.col("_last"), F.col("_last0"))
    return local.join(offsets, [group, "_slice"]).select(
        group, "seq", "_write", *carried,
        (F.col("_writes0") + F.col("_w")).alias("writes"),
        (position - last_write).alias("idle"))
