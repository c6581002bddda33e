"""Where results go."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import chunk_number, row_index

_CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false"}

# Fixed value: rows per upload file.
CHUNK_ROWS = 2500


def append_change_log(kinds: DataFrame, path: str) -> None:
    """Appends new and updated versions."""
    kinds.filter(F.col("kind") != "duplicate").write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> bool:
    """Writes a table with header; nothing when it is empty."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").options(**_CSV).csv(path)
    return True


def write_url_list(urls: DataFrame, path: str) -> None:
    """Sorted unique URLs."""
    (urls.select("url").distinct().orderBy("url")
     .write.mode("overwrite").options(**_CSV).csv(path))


def write_link_pairs(links: DataFrame, path: str) -> None:
    """Unique and sorted within a source; kept across sources."""
    (links.select("source_url", "product_url").distinct()
     .repartitionByRange("source_url", "product_url")
     .sortWithinPartitions("source_url", "product_url")
     .write.mode("overwrite").options(**_CSV).csv(path))


def write_cleaned(df: DataFrame, path: str) -> None:
    """One folder of CSV files per seller."""
    df.write.mode("overwrite").partitionBy("seller_name").options(**_CSV).csv(path)


def with_chunk(df: DataFrame, size: int = CHUNK_ROWS, seq: str = "seq",
               lead: list[str] | None = None) -> DataFrame:
    """Adds ``part``: consecutive slices of exactly ``size`` rows, from 1."""
    return (row_index(df, seq, lead, "_index")
            .withColumn("part", chunk_number(F.col("_index"), size)))


def write_chunks(df: DataFrame, path: str, size: int = CHUNK_ROWS, seq: str = "seq",
                 lead: list[str] | None = None) -> None:
    """One file per slice, rows in order. A slice is written by one task, ``size`` rows."""
    numbered = with_chunk(df, size, seq, lead)
    (numbered.repartition("part").sortWithinPartitions("part", "_index").drop("_index")
     .write.mode("overwrite").partitionBy("part").options(**_CSV).csv(path))


def write_brand_review(sample: DataFrame, path: str) -> None:
    (sample.orderBy("brand_seq", "seq")
     .select("brand_name", "seller_product_name", "seller_product_url")
     .write.mode("overwrite").options(**_CSV).csv(path))


def failure_line(ts, url, reason):
    return F.concat(F.lit("["), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("]  "),
                    url, F.lit("  |  "), reason)


def append_failures(failures: DataFrame, path: str) -> None:
    """One log entry per failed URL; ``ts`` is the present time unless given."""
    ts = F.col("ts") if "ts" in failures.columns else F.current_timestamp()
    (failures.select(failure_line(ts, F.col("url"), F.col("reason")).alias("value"))
     .write.mode("append").text(path))


def quarantine_pages(pages: DataFrame, path: str) -> None:
    pages.write.mode("append").parquet(path)


def write_sketches(sketches: DataFrame, folder: str, batch_id: int) -> None:
    """The sketches of a batch as its partition; written again, they replace it."""
    sketches.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
