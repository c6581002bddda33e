"""Packing of tokenised documents into sequences by cutting-stock patterns."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.session import cut


END = 1

# Texts of these characters alone take the quick way; they lower-case one to one, and composing
# them changes nothing. Any other text goes to the tokenizer whole.
_PLAIN = re.compile("[\t\n\r -~¡«»¿-ÖØ-öø-įı-ſ–-„…]*")
_LETTERS = "a-zß-öø-ſ"
# The splitting rule of the tokenizer file, for those characters.
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+")
#: Words whose ids a worker remembers; the store starts anew when it is full.
_REMEMBERED = 300_000
# How byte-level vocabularies write bytes: printable ones of Latin-1 as themselves, the others
# as the characters from 256 on.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = dict(zip(_SELF, _SELF, strict=True)) | {b: 256 + k for k, b in enumerate(sorted({*range(256)}.difference(_SELF)))}


class WordIds(dict):
    """Ids of words, as 32-bit little-endian bytes, by a tokenizer that splits text into words
    before it merges: its model encodes each word once."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # in a text these are ids of their own, across the words
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _REMEMBERED:
            self.clear()
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
        found = self[word] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
        return found

    def of(self, text: str) -> bytes:
        """The ids of a whole text, as the tokenizer gives them for it."""
        low = text.lower()
        if not _PLAIN.fullmatch(text) or any(s in low for s in self.special):
            return self.ids(text)
        return b"".join(map(self.__getitem__, _WORD.findall(low)))


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One store for all tasks that a worker runs one after another."""
    return WordIds(path)


def cuts(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: as many full sequences as it has, of what is left a half
    and a quarter sequence if it has them, and the rest, which is shorter than a quarter."""
    out = [capacity] * (total // capacity)
    rest = total % capacity
    for part in (capacity // 2, capacity // 4):
        if rest >= part > 0:
            out.append(part)
            rest -= part
    return out + [rest] * (rest > 0)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, grain: int) -> DataFrame:
    """Each document's ids and the end id in pieces: a row for each, with its class (length in
    grains, rounded up) and its place among the pieces of its class in this partition."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = word_ids(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(-(-capacity // grain) + 1, dtype=np.int64)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = known.of(text.as_py() or "") + end
                total = len(ids) // 4
                start = 0
                for length in cuts(total, capacity):
                    size = -(-length // grain)
                    rows.append((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, size, part, int(seen[size])))
                    seen[size] += 1
                    start += length
            if rows:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "size", "part", "place"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of_batches, ", ".join(f"{n} long" for n in names))


def best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of highest price that fits: an unbounded knapsack, by dynamic programming over
    the room. `sizes` ascend."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), "right")
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        if k := fits[r]:
            value = best[r - sizes[:k]] + prices[:k]
            j = int(value.argmax())
            if value[j] > best[r]:
                best[r], last[r] = value[j], j
    pattern, r = np.zeros(len(sizes)), room
    while r > 0:
        if last[r] < 0:
            r -= 1
        else:
            pattern[last[r]] += 1
            r -= int(sizes[last[r]])
    return float(best[room]), pattern


def solve_patterns(sizes: np.ndarray, counts: np.ndarray, room: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a column each) and how often to use them, in fractions, so that every size is
    used as often as counted with the fewest sequences: the linear program's simplex basis, one
    column at a time, each the knapsack's best at the basis' prices. Stopped after `rounds`, the
    solution is still feasible."""
    fill = np.floor(room / sizes)
    patterns, inverse, x = np.diag(fill), np.diag(1 / fill), counts / fill
    for k in range(rounds):
        if k and k % 500 == 0:
            inverse = np.linalg.inv(patterns)
            x = np.maximum(inverse @ counts, 0)
        value, column = best_pattern(inverse.sum(0), sizes, room)
        if value <= 1 + 1e-6:
            break
        step = inverse @ column
        ratio = np.full(len(x), np.inf)
        np.divide(x, step, out=ratio, where=step > 1e-9)
        leaving = int(ratio.argmin())
        if not np.isfinite(ratio[leaving]):
            break
        amount = ratio[leaving]
        x = np.maximum(x - amount * step, 0)
        x[leaving] = amount
        patterns[:, leaving] = column
        row = inverse[leaving] / step[leaving]
        inverse -= np.outer(step, row)
        inverse[leaving] = row
    return patterns, x


def plan(counts: dict[int, int], room: int, rounds: int = 4000) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of sizes, with how many sequences take each; together they use every size as
    often as counted. Fractions are rounded down, then up while pieces are left for it; what
    remains, less than a sequence for each pattern, goes best fit decreasing."""
    sizes = np.array(sorted(counts), dtype=np.int64)
    left = np.array([counts[s] for s in sizes.tolist()], dtype=np.int64)
    if not len(sizes):
        return []
    patterns, x = solve_patterns(sizes, left.astype(float), room, rounds)
    patterns = np.rint(patterns).astype(np.int64)
    made: list[tuple[tuple[int, ...], int]] = []

    def use(k: int, often: int) -> None:
        nonlocal left
        if often > 0:
            made.append((tuple(np.repeat(sizes, patterns[:, k]).tolist()), often))
            left = left - often * patterns[:, k]

    def most(k: int) -> int:
        some = patterns[:, k] > 0
        return int((left[some] // patterns[some, k]).min()) if some.any() else 0

    for k in range(len(x)):
        use(k, min(int(x[k] + 1e-9), most(k)))
    for k in np.argsort(-(x - np.floor(x + 1e-9))).tolist():
        use(k, min(1, most(k)))
    bins: list[list[int]] = []
    free = np.zeros(0, dtype=np.int64)
    for size in np.repeat(sizes, left)[::-1].tolist():
        fitting = np.flatnonzero(free >= size)
        if len(fitting):
            k = int(fitting[free[fitting].argmin()])
        else:
            k = len(bins)
            bins.append([])
            free = np.append(free, room)
        bins[k].append(size)
        free[k] -= size
    return made + [(tuple(b), 1) for b in bins]


def slots(made: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan by size and rank: from `rank` on, the pieces of `size` go to `often` sequences
    from `sequence` on, into slot `slot` of each."""
    rows, used, sequence = [], {}, 0
    for pattern, often in made:
        for slot, size in enumerate(pattern):
            rank = used.get(size, 0)
            rows.append((size, rank, sequence, slot))
            used[size] = rank + often
        sequence += often
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return dict(zip(("size", "rank", "sequence", "slot"), columns, strict=True))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, grain: int = 4) -> DataFrame:
    """A row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A document is its ids and id 1 (null and empty texts: that alone). Strings of the
    tokenizer's special tokens in a text are their ids, as the tokenizer has it. It is cut into full
    sequences, a half, a quarter and a rest, which short rests of others fill up. The histogram of lengths, in
    grains of `grain` ids, is the cutting-stock problem; it has capacity / grain entries at any
    size of the table. Pieces are ranked within their size by partition and place, and rank
    decides the sequence, so nothing is sorted and no size, however frequent, meets in one
    task. Repeated rows are packed each for itself; rows without doc_id too, under null. Ties
    are settled by place. An empty table gives none. Only doc_id and text are read."""
    room = capacity // grain
    pieces = cut(token_pieces(docs, tokenizer_path, capacity, grain))
    by_part = pieces.groupBy("size", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = cut(by_part.select("size", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")))
    counted = {r["size"]: r["n"] for r in by_part.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    layout = docs.sparkSession.sparkContext.broadcast(slots(plan(counted, room)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = layout.value
        key = (rows["size"] << 48) + rows["rank"]
        for batch in batches:
            size, rank = (batch.column(n).to_numpy() for n in ("size", "rank"))
            k = np.searchsorted(key, (size << 48) + rank, "right") - 1
            sequence = rows["sequence"][k] + rank - rows["rank"][k]
            yield pa.record_batch(
                [batch.column(n) for n in kept] + [pa.array(sequence), pa.array(rows["slot"][k])],
                names=[*kept, "sequence_id", "slot"],
            )

    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    ranked = pieces.join(by_part.drop("n"), ["size", "part"]).withColumn("rank", F.col("earlier") + F.col("place"))
    placed = ranked.select(*kept, "size", "rank").mapInArrow(place, ", ".join(f"{n} long" for n in [*kept, "sequence_id", "slot"]))
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*kept, "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))
