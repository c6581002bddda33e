"""Tables and files the jobs start from.

Schemas are explicit, but for CSV files that name their own columns: all cells are text, and
files with different headers are brought together by name.
"""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import blank, strip
from ..operators.ordered import in_slices
from ..schema import PAGES, RAW_FEED, RAW_PRODUCT
from ..session import cut

_CSV = {"header": "true", "escape": '"', "enforceSchema": "false"}
_START = r"^\[?[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\]"
_FAILURE = r"(?s)^\[?([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2})\]\s+(\S+)\s+\|\s+(.*)"

# First cells that are headings, not URLs.
HEADING_CELLS = ["url", "link", "entrypoint", ""]

_PLACE = ["_file", "_block", "_at"]

# A cell with the comma behind it, and a record with its line breaks in quotes.
_CELL = r'("(?:[^"]++|"")*+"|[^,]*+),'
_RECORD = r'(?:[^"\n]++|"(?:[^"]++|"")*+"|")++'


def located(df: DataFrame) -> DataFrame:
    """Adds where each row was read: file, start of the input split, place in the split."""
    return df.select(
        "*", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"))


def in_file_order(rows: DataFrame, out: str = "seq") -> DataFrame:
    """Adds the 0-based position of each located row in the files it was read from.

    Counts rows per input split, then numbers them inside a split, so no task sees more
    than one split.
    """
    split = ["_file", "_block"]
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"))
               .select(*split, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = F.row_number().over(Window.partitionBy(*split).orderBy("_at")) - 1
    return (rows.withColumn("_inside", inside).join(offsets, split)
            .withColumn(out, F.col("_offset") + F.col("_inside"))
            .drop(*_PLACE, "_inside", "_offset"))


def _cells(line: Column) -> Column:
    """The cells of one CSV record; an empty one without quotes is NULL."""
    found = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(_CELL), F.lit(1))
    return F.transform(found, lambda c: F.when(c == "", None).when(
        F.startswith(c, F.lit('"')), F.replace(F.substring(c, 2, F.length(c) - 2), F.lit('""'), F.lit('"')))
        .otherwise(c))


def _records(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    """Located records of CSV files as ``_cells``; blank lines are none."""
    lines = located(spark.read.text(path, wholetext=multi_line))
    record = F.col("value")
    if multi_line:
        # One row a file comes in; a quoted line break does not end a record.
        records = F.regexp_extract_all(F.col("value"), F.lit(_RECORD), F.lit(0))
        lines = lines.select(*_PLACE[:2], F.posexplode(records).alias("_at", "value"))
        record = F.rtrim(F.col("value"), F.lit("\r"))
    return lines.filter(~blank(record)).select(*_PLACE, _cells(record).alias("_cells"))


def _unique(names: list[str | None]) -> list[str]:
    """Names of the columns of one file: a nameless one is called after its place, a repeated
    one gets a number."""
    out: list[str] = []
    for k, name in enumerate(names):
        name, n = name or f"_c{k}", 0
        while (shown := f"{name}.{n}" if n else name) in out:
            n += 1
        out.append(shown)
    return out


def _with_header(spark: SparkSession, path: str | list[str], multi_line: bool
                 ) -> tuple[DataFrame, dict[str, Column]]:
    """Located records as ``_cells``, and each column name's cell.

    The files are read once. Every file's own header row says by a join where in its rows a
    column stands; what the driver sees is the distinct header rows, however many files have
    them. With ``multi_line`` cells may hold line breaks, but a file is then read by one task.
    """
    records = cut(_records(spark, path, multi_line))
    first = records.groupBy("_file").agg(
        F.min_by(F.struct("_block", "_at", "_cells"), F.struct("_block", "_at")).alias("_first"))
    # A byte order mark belongs to no name.
    header = F.transform(F.col("_first._cells"), lambda c: F.ltrim(c, F.lit("\ufeff")))
    first = cut(first.select("_file", "_first._block", "_first._at", header.alias("_header")))
    headers = sorted((r["_header"] for r in first.select("_header").distinct().collect()),
                     key=lambda h: [c or "" for c in h])
    named = [_unique(h) for h in headers]
    names = list(dict.fromkeys(name for n in named for name in n))
    # For each header row the place of every name, 0 if it has none: one small row a header.
    places = F.array(F.array().cast("array<int>"), *[
        F.array(*[F.lit(n.index(name) + 1 if name in n else 0) for name in names]) for n in named])
    which = F.lit(0)
    for k, header_row in enumerate(headers):
        same = F.array(*[F.lit(c) for c in header_row]).cast("array<string>")
        which = F.when(F.col("_header").eqNullSafe(same), k + 1).otherwise(which)
    of_file = first.select("_file", F.col("_block").alias("_b"), F.col("_at").alias("_a"),
                           F.get(places, which).alias("_places"))
    rows = records.join(of_file, "_file").filter(
        (F.col("_block") != F.col("_b")) | (F.col("_at") != F.col("_a"))).drop("_b", "_a")
    return rows, {name: F.get(F.col("_cells"), F.get(F.col("_places"), F.lit(k)) - 1)
                  for k, name in enumerate(names)}


def _unnamed(name: str) -> bool:
    return bool(re.match(r"^(Unnamed|_c\d+$)", name))


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Without the nameless columns that trailing commas make."""
    return df.drop(*filter(_unnamed, df.columns))


def entrypoints_or_default(urls: DataFrame, start_url: str) -> DataFrame:
    """Non-empty URLs; the start URL when there are none."""
    urls = urls.select("url").filter(F.coalesce(F.col("url"), F.lit("")) != "")
    fallback = urls.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
        F.lit(start_url).alias("url"))
    return urls.unionByName(fallback)


def read_entrypoints(spark: SparkSession, path: str, start_url: str) -> DataFrame:
    """The ``url`` column; the start URL if the file is absent or has none."""
    try:
        rows, cells = _with_header(spark, path, False)
        urls = rows.select(cells.get("url", F.lit(None).cast("string")).alias("url"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        urls = spark.createDataFrame([], "url string")
    return entrypoints_or_default(urls, start_url)


def without_headings(cells: DataFrame) -> DataFrame:
    """``url`` cells, stripped, that are not a heading word."""
    return (cells.select(strip(F.col("url")).alias("url"))
            .filter(~F.lower("url").isin(HEADING_CELLS)))


def read_entrypoints_headerless(spark: SparkSession, path: str) -> DataFrame:
    return without_headings(
        spark.read.options(header="false", escape='"').csv(path)
        .select(F.col("_c0").alias("url")))


def listed_urls(df: DataFrame) -> DataFrame:
    """The ``url`` column, or the first one where that is blank; stripped, blanks dropped."""
    return _listed(df, F.col("url") if "url" in df.columns else F.lit(None), F.col(df.columns[0]))


def _listed(rows: DataFrame, url: Column, first: Column) -> DataFrame:
    chosen = F.coalesce(F.nullif(url, F.lit("")), first)
    return rows.select(strip(chosen).alias("url")).filter(~blank(F.col("url")))


def read_url_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As ``listed_urls``; the first column is that of each file."""
    rows, cells = _with_header(spark, path, False)
    return _listed(rows, cells.get("url", F.lit(None)), F.get(F.col("_cells"), F.lit(0)))


def read_products(spark: SparkSession, path: str | list[str], multi_line: bool = False
                  ) -> DataFrame:
    """Product rows with their file position ``seq``. Columns no file has are absent; others
    than the known ones follow, under the names the files give them, in capitals or not."""
    rows, cells = _with_header(spark, path, multi_line)
    known = [c for c in RAW_PRODUCT.fieldNames() if c in cells]
    extra = [c for c in cells if c not in known and not _unnamed(c)]
    return in_file_order(rows, "_seq").select(
        F.col("_seq").alias("seq"), *[cells[c].alias(c) for c in (*known, *extra)])


# A second crawl of the same seller has the same form.
read_fixed_patch = read_products


def read_feed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    rows = spark.read.schema(RAW_FEED).options(**_CSV, multiLine=str(multi_line).lower()).csv(path)
    return in_file_order(located(rows))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def stream_table(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    """Files that land in a folder as a stream; ``max_files`` bounds a micro-batch."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(path))


def stream_pages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return stream_table(spark, path, PAGES, max_files)


def _joined(rows: Column, field: str) -> Column:
    """The lines of some rows in their order."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(rows)), lambda x: x[field]), "\n")


def _folded(lines: DataFrame) -> DataFrame:
    """Entries of a log as ``_entry``, each with the lines up to the next one.

    Lines are dealt to slices in their order and folded there. Only the ends of slices, where
    an entry may go on in the next one, are brought together afterwards: two rows a slice.
    """
    sliced = in_slices(lines.withColumn("_start", F.rlike("_line", F.lit(_START)).cast("int")), ["seq"])
    inside = Window.partitionBy("_slice").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    pieces = (sliced.withColumn("_local", F.sum("_start").over(inside)).groupBy("_slice", "_local")
              .agg(_joined(F.struct("seq", "_line"), "_line").alias("_entry")))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy("_slice").agg(F.sum("_start").alias("_n")).select(
        "_slice", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    pieces = cut(pieces.join(counts, "_slice"))
    at_end = (F.col("_local") == 0) | (F.col("_local") == F.col("_n"))
    ends = pieces.filter(at_end).groupBy((F.col("_before") + F.col("_local")).alias("_number")).agg(
        _joined(F.struct("_slice", "_local", "_entry"), "_entry").alias("_entry"))
    # What stands before the first entry has the number 0.
    return pieces.filter(~at_end).select("_entry").union(ends.filter("_number > 0").select("_entry"))


def parse_failures(lines: DataFrame, column: str = "line", seq: str = "seq") -> DataFrame:
    """``(ts, url, reason)`` of log entries.

    An entry starts at a line with a time in brackets; the lines up to the next one, in ``seq``
    order, belong to its reason. Lines before the first entry, and entries without a URL, are
    dropped.
    """
    entries = _folded(lines.select(F.col(seq).alias("seq"), F.col(column).alias("_line")))
    c = F.col("_entry")
    return (entries.filter(F.rlike(c, F.lit(_FAILURE))).select(
        # Log times carry no zone.
        F.try_to_timestamp(F.regexp_extract(c, _FAILURE, 1), F.lit("yyyy-MM-dd HH:mm:ss")
                           ).cast("timestamp_ntz").alias("ts"),
        F.regexp_extract(c, _FAILURE, 2).alias("url"),
        strip(F.regexp_extract(c, _FAILURE, 3)).alias("reason")))


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """Failure log entries, reasons over several lines kept whole."""
    return parse_failures(in_file_order(located(spark.read.text(path))), "value")
