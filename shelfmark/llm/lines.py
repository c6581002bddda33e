"""Line dedup: near-equal lines by a segment-partition edit join."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import _BASE, _INVERSE, _powers, checked_pairs, folded_counts, linked, mixed, rare_keys, texts_of, unused, with_both_texts
from shelfmark.session import cut, scratch


def segments(length: int, distance: int) -> list[tuple[int, int]]:
    """Start and length of the distance + 1 segments of a string: as even as can be, the longer
    ones last."""
    count = distance + 1
    short, longer = length // count, length % count
    out, at = [], 0
    for k in range(count):
        size = short + (k >= count - longer)
        out.append((at, size))
        at += size
    return out


def probes(length: int, distance: int) -> list[tuple[int, int, int, int]]:
    """Where a string of some length must be looked up: indexed length, segment, start, size.

    If a string is within the distance of one that is not longer, some segment of the shorter
    stands in the longer one, shifted by no more than what edits before it and behind it can
    make up (the multi-match-aware bounds)."""
    out = []
    for other in range(max(length - distance, distance + 1), length + 1):
        shift = length - other
        for k, (start, size) in enumerate(segments(other, distance)):
            low = max(0, start - k, start + shift - (distance - k))
            high = min(length - size, start + k, start + shift + (distance - k))
            out += [(other, k, at, size) for at in range(low, high + 1)]
    return out


def block_keys(lines: list[str], distance: int, places: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of many lines, one behind the other, and how many each has: for itself as
    indexed and as probing. Two lines within the distance share one. A key is a difference of one
    running polynomial over all the lines, so no segment is handled by itself."""
    lengths = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    kinds, kind = np.unique(lengths, return_inverse=True)
    for length in kinds.tolist():
        if length not in places:
            places[length] = np.array(probes(length, distance), dtype=np.int64).reshape(-1, 4)
    table = np.concatenate([np.zeros((0, 4), dtype=np.int64), *[places[length] for length in kinds.tolist()]])
    sizes = np.array([len(places[length]) for length in kinds.tolist()], dtype=np.int64)
    many = sizes[kind]
    begin = np.cumsum(many) - many
    other, k, at, size = table[np.arange(many.sum()) + np.repeat((np.cumsum(sizes) - sizes)[kind] - begin, many)].T
    at = at + np.repeat(np.cumsum(lengths) - lengths, many)
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum((codes + np.uint64(1)) * _powers(_BASE, len(codes)), out=total[1:])
        value = (total[at + size] - total[at]) * _powers(_INVERSE, len(codes))[at]
        return mixed(value + ((other << 8) | k).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64), many


def keys(line: str, distance: int, places: dict[int, np.ndarray]) -> list[int]:
    """`block_keys` of one line."""
    return block_keys([line], distance, places)[0].tolist()


def _alike(a: str, i: int, b: str, j: int) -> int:
    """How many characters a from i and b from j have in common: steps that double, then halve."""
    most = min(len(a) - i, len(b) - j)
    if a[i : i + most] == b[j : j + most]:
        return most
    k, step = 0, 8
    while a[i + k : i + k + step] == b[j + k : j + k + step]:
        k += step
        step *= 2
    while step > 1:
        step //= 2
        if a[i + k : i + k + step] == b[j + k : j + k + step]:
            k += step
    return k


def within(a: str, b: str, distance: int) -> bool:
    """Whether the edit distance is no more than `distance`: how far each of 2 * distance + 1
    diagonals goes with so many edits, over whole runs of equal characters at a time."""
    shift = len(b) - len(a)
    if abs(shift) > distance:
        return False
    if a == b:
        return True
    reach = {0: _alike(a, 0, b, 0)}
    for left in range(distance - 1, -1, -1):
        new = {}
        # diagonals from which the edits left lead to the end
        for d in range(shift - left, shift + left + 1):
            # one of a for one of b, one of b put in, one of a left out
            i = max(reach.get(d, -2) + 1, reach.get(d - 1, -1), reach.get(d + 1, -2) + 1)
            i = min(i, len(a), len(b) - d)
            if i >= max(0, -d):
                new[d] = i + _alike(a, i, b, i + d)
        reach = new
        if reach.get(shift, -1) >= len(a):
            return True
    return False


#: Lengths whose places, and lines whose keys, a task remembers.
_LENGTHS, _SEEN = 20_000, 200_000
#: What counts as a blank at the ends of a line.
_BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def line_rows(docs: DataFrame, least: int) -> DataFrame:
    """A row for each line of at least `least` characters of documents with an id: doc_id,
    line_no, node (a 64-bit digest of the line) and the line. Lines end at a line feed; blanks
    around them do not count."""
    each = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "line")
    )
    # most lines begin and end with a visible ASCII character, and trimming looks at every character
    plain = F.left("line", F.lit(1)).between("!", "~") & F.right("line", F.lit(1)).between("!", "~")
    each = each.select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"), F.when(plain, F.col("line")).otherwise(F.btrim("line", F.lit(_BLANKS))).alias("line")
    )
    return each.where(F.length("line") >= least).select("doc_id", "line_no", F.xxhash64("line").alias("node"), "line")


def keyed_lines(lines: DataFrame, least: int, distance: int) -> DataFrame:
    """The lines without their text, and with their bucket keys. Shorter ones than `least` have
    none, nor have most of those that a task has had before."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[int, np.ndarray] = {}
        seen: set[int] = set()
        for batch in batches:
            if len(places) > _LENGTHS:
                places.clear()
            if len(seen) > _SEEN:
                seen.clear()
            fresh = []
            long = pc.greater_equal(pc.utf8_length(batch.column("line")), least).to_numpy(zero_copy_only=False)
            nodes = batch.column("node").to_numpy()
            for k, node in zip(np.flatnonzero(long).tolist(), nodes[long].tolist(), strict=True):
                if node not in seen:
                    seen.add(node)
                    fresh.append(k)
            found, many = block_keys(batch.column("line").take(pa.array(fresh, pa.int64())).to_pylist(), distance, places)
            counts = np.zeros(len(batch), dtype=np.int64)
            counts[fresh] = many
            lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), found)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], lists], names=[*names, "keys"])

    names = ["doc_id", "line_no", "node"]
    return lines.mapInArrow(of_batches, "doc_id long, line_no long, node long, keys array<bigint>")


def grams(line: str, size: int) -> set[int]:
    """Digests of all runs of `size` characters, the n-th of equal ones as such."""
    seen: Counter = Counter()
    out = set()
    for k in range(len(line) - size + 1):
        run = line[k : k + size]
        out.add(xxhash.xxh3_64_intdigest(run, seen[run]) - (1 << 63))
        seen[run] += 1
    return out


def rare_grams(members: DataFrame, found: DataFrame, least: int, distance: int) -> DataFrame:
    """The rarest runs of characters of each line as its buckets, for `linked`.

    An edit changes at most q of a line's runs of q characters, so lines within the distance
    share one of their q * distance + 1 rarest runs, and all but q * distance of a line's runs
    stand in the other."""
    size = max(1, min(4, least // (distance + 1)))
    lost = size * distance

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column("text").to_pylist()
            values = [list(grams(t, size)) for t in lines]
            counts = [folded_counts(np.frombuffer(t.encode("utf-32-le"), dtype="<u4"), 32).tolist() for t in lines]
            yield pa.record_batch(
                [batch.column("node"), pa.array(values, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int8()))],
                names=["node", "grams", "counts"],
            )

    open_texts = found.join(members.select("node").distinct(), "node", "left_semi").select("node", "text")
    rows = open_texts.mapInArrow(of_batches, "node long, grams array<bigint>, counts array<tinyint>")
    # lengths differ by no more than the distance, and an edit takes one character and brings one
    return rare_keys(
        rows, F.lit(lost + 1), F.lit(lost + 1), lambda most: F.least(2 * most + 2 * lost, 2 * F.col("n") + distance), F.lit(distance)
    )


def line_classes(keyed: DataFrame, docs: DataFrame, least: int, distance: int) -> DataFrame:
    """node, component of the lines with another one within the distance of them."""
    buckets = keyed.where(F.size("keys") > 0).select("node", "keys")
    found: list[DataFrame] = []

    def prepare(nodes: DataFrame) -> None:
        found.append(texts_of(line_rows(docs, least).withColumnRenamed("line", "text"), nodes))

    def close(pairs: DataFrame) -> DataFrame:
        return checked_pairs(with_both_texts(pairs, found[0]), lambda a, b: within(a, b, distance))

    return linked(buckets, close, prepare, lambda members: rare_grams(members, found[0], least, distance))


def repeated_lines(docs: DataFrame, least: int = 20, distance: int = 2, shortest: int | None = None) -> DataFrame:
    """A row for each line that is equal to another one of the table or reaches it by edits of at
    most `distance` characters a step: doc_id, line_no (from 0), class, first_doc_id,
    first_line_no, removed.

    The first line of a class by doc_id, then line_no, stays; the others are removed. Lines
    shorter than `least` characters without blanks around them are never touched, unless
    `shortest` is given: those of as many characters then count where they are equal. Rows without a
    doc_id keep their lines and count for nothing; rows with the same doc_id are one document.
    Null and empty texts have no lines. Digests of lines have 64 bits. Other columns are ignored.
    An empty table gives none."""
    with scratch(docs.sparkSession) as keep:
        rows = keep(keyed_lines(line_rows(docs, least if shortest is None else min(shortest, least)), least, distance))
        return cut(_repeated(rows, line_classes(rows, docs, least, distance)))


def _repeated(rows: DataFrame, classes: DataFrame) -> DataFrame:
    rows = rows.join(classes, "node", "left").select("doc_id", "line_no", F.coalesce("component", "node").alias("class"))
    first = rows.groupBy("class").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.max(F.struct("doc_id", "line_no")).alias("last"))
    several = first.where("first <> last").select("class", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"))
    removed = ~((F.col("doc_id") == F.col("first_doc_id")) & (F.col("line_no") == F.col("first_line_no")))
    return rows.join(several, "class").select("doc_id", "line_no", "class", "first_doc_id", "first_line_no", removed.alias("removed"))


def drop_repeated_lines(docs: DataFrame, least: int = 20, distance: int = 2, shortest: int | None = None) -> DataFrame:
    """All documents with all their columns, their texts without the removed lines; a document
    that loses every line stays with what is left of it. n_chars, if there, is set anew where a
    line was removed."""
    doc, lost = unused("doc", docs.columns), unused("lost", docs.columns)
    gone = repeated_lines(docs, least, distance, shortest).where("removed").groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set("line_no").alias(lost))
    left = F.array_join(F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(lost, i.cast("long"))), "\n")
    joined = docs.join(gone, F.col("doc_id").cast("long") == F.col(doc), "left")
    out = joined.withColumn("text", F.when(F.col(lost).isNull(), F.col("text")).otherwise(left))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(lost).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(*docs.columns)
