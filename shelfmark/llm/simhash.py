"""SimHash near-duplicates by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import SPACED, linked, texts, unused, words
from shelfmark.session import cut

#: Shingles whose bits are counted at once.
_STEP = 1 << 17


def fingerprint(text: bytes, starts: np.ndarray, ends: np.ndarray, size: int) -> int:
    """SimHash of the words of a text as a signed 64-bit number: bit 1 where more than half of
    the shingles' hashes have it. No word: 0."""
    n = len(starts)
    if not n:
        return 0
    spaced = b" ".join([text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    right = np.cumsum(ends - starts + 1) - 1
    left = right - (ends - starts)
    size = min(size, n)
    left, right = left[: n - size + 1], right[size - 1 :]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(left), _STEP):
        pairs = zip(left[k : k + _STEP].tolist(), right[k : k + _STEP].tolist(), strict=True)
        hashes = np.array([digest(spaced[a:b], 42) for a, b in pairs], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(left), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fp and digest (of the text, 64 bits), a row for each row. Null and empty texts have
    fingerprint zero."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, data, offsets in texts(batch):
                raw = data.tobytes()
                starts, ends, first = words(data, offsets, SPACED)
                found += [fingerprint(raw, starts[a:b], ends[a:b], size) for a, b in zip(first, first[1:])]
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.int64()), batch.column("digest")], names=["doc_id", "fp", "digest"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), _digest(text_column).alias("digest"))
    return rows.mapInArrow(of_batches, "doc_id long, fp long, digest long")


def _digest(text_column: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))


def variants(fp: str, segments: int, bits: int = 64) -> Column:
    """Keys of a fingerprint: each segment with each of its bits blanked in turn. Two
    fingerprints whose segment differs in one bit at most share a key of it."""
    width = bits // segments
    out = []
    for s in range(segments):
        part = F.shiftrightunsigned(F.col(fp), s * width).bitwiseAND(F.lit((1 << width) - 1))
        out += [part.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << j))) + F.lit((s * width + j) << width) for j in range(width)]
    return F.array(*out)


def near_classes(prints: DataFrame, distance: int = 3) -> DataFrame:
    """node, component of the distinct fingerprints (column fp) with a link to another one.

    Cut into (distance + 1) / 2 segments, two fingerprints within the distance have a segment in
    which they differ by one bit at most: fewer segments, and so rarer keys, than when a segment
    must be equal. Each link is verified by counting the differing bits."""
    segments = max(2, (distance + 2) // 2)
    while 64 % segments:
        segments += 1
    # spread anew: so little data would come in few tasks, and each row has 64 keys
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = prints.select("fp").distinct().repartition(parts)
    buckets = distinct.select(F.col("fp").alias("node"), F.explode(variants("fp", segments)).alias("key"))

    def close(pairs: DataFrame) -> DataFrame:
        return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)

    return linked(buckets, close)


def _classed(docs: DataFrame, distance: int, size: int) -> DataFrame:
    """doc_id, fp, digest, class of every row."""
    prints = cut(fingerprints(docs, size))
    return prints.join(near_classes(prints, distance), prints.fp == F.col("node"), "left").select(
        "doc_id", "fp", "digest", F.coalesce("component", "fp").alias("class")
    )


def near_duplicates(docs: DataFrame, distance: int = 3, size: int = 3) -> DataFrame:
    """A row for each document: doc_id, fingerprint (16 hex digits), component_id, kept.

    Documents link if their fingerprints differ in `distance` bits at most; component_id is the
    smallest doc_id reachable, kept says that it is the document's own. Null or wordless texts
    have fingerprint zero and link like any other. Rows with the same doc_id are one document:
    all are returned, with the same decision if their texts agree. A null doc_id is never
    smallest; a component of such rows alone has component_id null and is kept. Other columns
    are ignored. An empty table gives none."""
    rows = _classed(docs, distance, size)
    first = rows.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return rows.join(first, "class").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, distance: int = 3, size: int = 3) -> DataFrame:
    """One document of each component, with all its columns: that of the smallest doc_id, or if
    no row of the component has one, of the smallest digest of its text.

    Each row is judged by its own text, so rows that share a doc_id, or have none, go or stay
    with what they are like. Repeated rows of the document that stays, and rows with its doc_id
    whose texts are near it, count as one document; of those texts the one of least digest
    stays, as often as it stands there."""
    rows = _classed(docs, distance, size)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    first = rows.groupBy("class").agg(F.min(order).alias("first"))
    # a row a document that goes; of a hot class the copies are one row a task before the join
    doc, text = unused("gone", docs.columns), unused("digest", docs.columns)
    gone = rows.groupBy("class", "doc_id", "digest").agg(F.lit(True).alias("seen")).join(first, "class").where(~order.eqNullSafe(F.col("first")))
    gone = gone.select(F.col("doc_id").alias(doc), F.col("digest").alias(text))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (_digest("text") == F.col(text))
    return docs.join(gone, same, "left_anti")
