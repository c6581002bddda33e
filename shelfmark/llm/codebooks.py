"""Vector codes: each part of a vector as the index of the nearest entry of that part's codebook.

Nearest entries are found by Orchard's search. Every entry of a codebook has the list of all
entries by their distance from it. A search stands at an entry and reads its list; an entry
nearer to the query is gone to, and its list read from the start. An entry further from where the
search stands than twice the query is cannot be nearer to the query, nor can any behind it.
Components are integers, so all distances, ties and means are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfmark.llm.common import unused

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components beyond this are held at it: the squared distances of a part must fit 64 bits.
MOST = 1 << 26
#: Queries that a task searches for at once.
TOGETHER = 1 << 15


@dataclass
class Codebooks:
    """Entries as (part, entry, position) integers and, by entry, all entries by distance."""

    entries: np.ndarray

    def __post_init__(self):
        apart = self.entries[:, :, None] - self.entries[:, None]
        far = (apart * apart).sum(axis=3)
        self.lists = far.argsort(axis=2, kind="stable")
        self.far = np.take_along_axis(far, self.lists, axis=2)

    def nearest(self, part: int, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest entry; of equally near ones, the
        lowest index."""
        lists, far, entries = self.lists[part], self.far[part], self.entries[part]
        here = np.zeros(len(queries), dtype=np.int64)
        near = _squares(queries - entries[0])
        seen = np.zeros((len(queries), len(entries)), dtype=bool)
        seen[:, 0] = True
        place = np.zeros(len(queries), dtype=np.int64)
        open_ = np.arange(len(queries))
        while len(open_):
            at, k = here[open_], place[open_]
            # |query - other| >= |here - other| - |query - here|: strictly beyond twice, none is as near
            open_ = open_[far[at, k] <= 4 * near[open_]]
            at, k = here[open_], place[open_]
            other = lists[at, k]
            place[open_] += 1
            new = ~seen[open_, other]
            rows, other = open_[new], other[new]
            seen[rows, other] = True
            distance = _squares(queries[rows] - entries[other])
            better = (distance < near[rows]) | ((distance == near[rows]) & (other < here[rows]))
            rows = rows[better]
            here[rows], near[rows], place[rows] = other[better], distance[better], 0
            open_ = open_[place[open_] < len(entries)]
        return here, near

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (row, part) of vectors and the squared distances summed over their parts."""
        codes, error = np.zeros((len(vectors), len(self.entries)), dtype=np.int64), np.zeros(len(vectors), dtype=np.int64)
        cut = vectors.reshape(len(vectors), len(self.entries), -1)
        for part in range(len(self.entries)):
            codes[:, part], distance = self.nearest(part, cut[:, part])
            error += distance
        return codes, error

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _squares(difference: np.ndarray) -> np.ndarray:
    return (difference * difference).sum(axis=1)


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def integers(batch: pa.RecordBatch, column: int, width: int) -> Iterator[np.ndarray]:
    """The vectors of a batch as whole numbers, in blocks of rows; short ones are continued by zeros."""
    lists = batch.column(column)
    for first in range(0, len(lists), TOGETHER):
        part = lists.slice(first, TOGETHER)
        sizes = part.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        values = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        out = np.zeros((len(part), width), dtype=np.int64)
        rows = np.repeat(np.arange(len(part)), sizes)
        out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.clip(np.floor(values * SCALE), -MOST, MOST)
        yield out


def _first(vectors: DataFrame, width: int, parts: int, entries: int) -> Codebooks:
    """The codebooks of the smallest ids; of equal ids, of the smallest vectors. Ids that are null come last."""
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    batch = pa.record_batch([rows.column(0).combine_chunks()], names=["vector"])
    found = np.concatenate(list(integers(batch, 0, width)))
    return Codebooks(found.reshape(len(found), parts, -1).transpose(1, 0, 2).copy())


def _means(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the mean of the parts it is nearest to, rounded down; entries
    without a part stay. A task sends one row a part, entry and position, whatever it reads."""
    parts, entries, wide = books.entries.shape

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, wide), dtype=np.int64)
        for batch in batches:
            for block in integers(batch, 0, parts * wide):
                codes, _ = books.encode(block)
                cut = block.reshape(len(block), parts, wide)
                for part in range(parts):
                    counts[part] += np.bincount(codes[:, part], minlength=entries)
                    np.add.at(sums[part], codes[:, part], cut[:, part])
        part, entry = np.nonzero(counts)
        if len(part):
            repeat = [np.repeat(x, wide) for x in (part, entry, counts[part, entry])]
            columns = [repeat[0], repeat[1], np.tile(np.arange(wide), len(part)), repeat[2], sums[part, entry].ravel()]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "position", "n", "total"])

    totals = vectors.select("vector").mapInArrow(of_batches, "part long, entry long, position long, n long, total long")
    # as many rows as the codebooks have components
    rows = totals.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()
    part, entry, position, n, total = (rows.column(k).to_numpy() for k in range(5))
    out = books.entries.copy()
    out[part, entry, position] = total // n
    return Codebooks(out)


def codes(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """All columns of the table with `code` (two hex digits a part) and `error` (the squared
    distances of its parts from their entries), and the codebooks, None for a table without
    vectors.

    Rows whose vector is null or holds a null or non-finite component are left out, all others
    kept, repeated ids too. Where vectors differ in length, or the length is no multiple of
    `parts`, they count as continued by zeros; a vector without components is all zeros. Columns
    named `code` or `error` are set aside as `_code`, `_error`. Components are floor(256 x), held
    at ±2^26. Only the codebooks (entries x length, whatever the table) are sent to tasks."""
    if entries > 256:
        raise ValueError("an index has two hex digits")
    clashes = {c: unused(f"_{c}", table.columns) for c in table.columns if c.lower() in ("code", "error")}
    kept = table.where(usable(F.col(vector_column))).withColumnsRenamed(clashes)
    vectors = kept.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    longest = vectors.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return kept.withColumns({"code": F.lit("").cast("string"), "error": F.lit(0).cast("long")}), None
    wide = max(-(-longest // parts), 1)
    books = _first(vectors, parts * wide, parts, entries)
    for _ in range(rounds):
        books = _means(vectors, books)
    vector = kept.columns.index(vector_column)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [books.encode(block) for block in integers(batch, vector, parts * wide)]
            if not found:
                continue
            digits = np.concatenate([c for c, _ in found]).astype(np.uint8)
            code = pa.array([x.tobytes().hex() for x in digits], pa.string())
            error = pa.array(np.concatenate([e for _, e in found]), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, code, error], names=[*batch.schema.names, "code", "error"])

    schema = StructType([*kept.schema.fields, StructField("code", StringType()), StructField("error", LongType())])
    return kept.mapInArrow(of_batches, schema), books


def with_group_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """`label_error`: `error` summed over the rows of equal label, nulls together. Sums are made
    before the shuffle and joined back, one row a label; no label's rows are gathered. A column
    of that name is set aside as `_label_error`."""
    coded = coded.withColumnsRenamed({c: unused(f"_{c}", coded.columns) for c in coded.columns if c.lower() == "label_error"})
    name = unused("_of", coded.columns)
    sums = coded.groupBy(F.col(label).alias(name)).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, coded[label].eqNullSafe(sums[name]), "left").drop(name)
