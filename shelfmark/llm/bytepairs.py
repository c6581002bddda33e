"""Byte-level BPE as a monoid: texts are encoded in halves, and neighbours joined up the tree.

What an encoded stretch of text is: its words (the matches of the splitting pattern) and the ids
of each. Joining two stretches encodes again only a window over their border, which grows until
nothing outside it can change:

* words. A match depends on its own text and at most `AHEAD` characters from its start, or one
  behind its end. Words of the left stretch that end early enough stand. Splitting goes on from
  there, and once a word ends where one of the right stretch ends, the rest of the right stands,
  as the pattern never looks back.
* ids of a word that both stretches hold a part of. A row of ids is what the merges give for its
  bytes exactly if each two neighbours are for theirs; so a window is wide enough once the ids
  on both of its edges are a lawful pair with their neighbours outside.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from shelfmark.llm.common import unused

#: Characters that a leaf of the tree of a text has at most, and bytes that one of a word has.
LEAF_CHARS, LEAF_BYTES = 2048, 64
#: Characters that the pattern reads from the start of a match, whatever its length: a quote and two letters.
AHEAD = 3
#: Characters of texts whose words are encoded together, and words that are merged at once.
GROUP_CHARS, TOGETHER = 1 << 20, 1 << 15
#: Bytes of texts or ids that a task holds the results of.
PART_BYTES = 2 << 20
#: Words and pairs whose ids a task remembers; the store starts anew when it is full.
REMEMBERED = 300_000
_ID = np.dtype("<u4")
_NONE = 1 << 62


class Merges:
    """Ids of bytes by the ranks of a vocabulary: the pair of least rank merges first, the
    leftmost of equal ones."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.lawful: dict[tuple[int, int], bool] = {}
        self.pairs: tuple[np.ndarray, np.ndarray] | None = None

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair of ids merges to, `_NONE` where none."""
        if self.pairs is None:
            get = self.ranks.get
            found = sorted(
                (a << 32 | b, whole) for token, whole in self.ranks.items() for k in range(1, len(token))
                if (a := get(token[:k])) is not None and (b := get(token[k:])) is not None
            )
            self.pairs = tuple(np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
        keys, wholes = self.pairs
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, wholes[at], _NONE)

    def merged_together(self, words: list[bytes]) -> list[bytes]:
        """The ids of many short words as 32-bit numbers: one merge of each word at a time."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        ids = of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        last = np.zeros(len(ids), dtype=bool)
        last[np.cumsum(sizes) - 1] = True
        ranks = np.where(last, _NONE, self._pair_ranks(ids, np.append(ids[1:], 0)))
        out, open_ = [b""] * len(words), np.arange(len(words))
        while True:
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(ranks, starts)
            done = least == _NONE
            if done.any():
                packed = ids.astype(_ID).tobytes()
                for k, a, n in zip(open_[done].tolist(), starts[done].tolist(), sizes[done].tolist(), strict=True):
                    out[k] = packed[4 * a : 4 * (a + n)]
                stay = np.repeat(~done, sizes)
                ids, ranks, open_, sizes, least = ids[stay], ranks[stay], open_[~done], sizes[~done], least[~done]
                if not len(open_):
                    return out
                starts = np.cumsum(sizes) - sizes
            # the leftmost place of each word's least rank
            places = np.flatnonzero(ranks == np.repeat(least, sizes))
            at = places[np.searchsorted(places, starts)]
            ids[at] = least
            stay = np.ones(len(ids), dtype=bool)
            stay[at + 1] = False
            # a pair that began with the second of the two is gone; what it pairs with now is looked up
            ends = at + 2 == starts + sizes
            at -= np.arange(len(at))
            ids, ranks, sizes = ids[stay], ranks[stay], sizes - 1
            starts = np.cumsum(sizes) - sizes
            behind = ids[np.minimum(at + 1, len(ids) - 1)]
            ranks[at] = np.where(ends, _NONE, self._pair_ranks(ids[at], behind))
            before = at[at > starts] - 1
            ranks[before] = self._pair_ranks(ids[before], ids[before + 1])

    def merged(self, data: bytes) -> list[int]:
        """Ids of a stretch, merge by merge."""
        get = self.ranks.get
        if (whole := get(data)) is not None:
            return [whole]
        if len(data) > LEAF_BYTES:
            return self._merged_by_heap(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [get(data[i : i + 2], _NONE) for i in range(len(data) - 1)]
        while pairs and (least := min(pairs)) != _NONE:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], _NONE)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], _NONE)
        return [self.ranks[p] for p in parts]

    def _merged_by_heap(self, data: bytes) -> list[int]:
        """The same for windows that had to grow: the next pair comes from a heap."""
        get, n = self.ranks.get, len(data)
        ends, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        gone = bytearray(n)
        heap = [(rank, i) for i in range(n - 1) if (rank := get(data[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            if gone[i] or (j := after[i]) == n or get(data[i : ends[j]]) != rank:
                continue  # one of the two has merged since
            ends[i], after[i], gone[j] = ends[j], after[j], 1
            if after[i] < n:
                before[after[i]] = i
                if (new := get(data[i : ends[after[i]]])) is not None:
                    heappush(heap, (new, i))
            if (k := before[i]) >= 0 and (new := get(data[k : ends[i]])) is not None:
                heappush(heap, (new, k))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : ends[i]]])
            i = after[i]
        return out

    def stays(self, a: int, b: int) -> bool:
        """Whether the two ids are what their joint bytes are encoded to."""
        found = self.lawful.get((a, b))
        if found is None:
            if len(self.lawful) >= REMEMBERED:
                self.lawful.clear()
            found = self.lawful[a, b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of the bytes of both."""
        i, j = 1, 1
        while True:
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, left[-i:] + right[:j])))
            left_stays = i >= len(left) or self.stays(left[-i - 1], window[0])
            right_stays = j >= len(right) or self.stays(window[-1], right[j])
            if left_stays and right_stays:
                return left[:-i] + window + right[j:]
            i, j = i if left_stays else 2 * i, j if right_stays else 2 * j

    def encoded(self, data: bytes) -> list[int]:
        """Ids of bytes of any length: of both halves, joined."""
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        half = len(data) // 2
        return self.joined(self.encoded(data[:half]), self.encoded(data[half:]))

    def decoded(self, ids: list[int]) -> bytes:
        """The bytes of ids: of both halves, concatenated."""
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decoded(ids[:half]) + self.decoded(ids[half:])


class Words(dict):
    """Ids of words as 32-bit numbers, each word encoded once."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def learn(self, words: set[str]) -> None:
        """Encodes the short ones of the words that are not known yet, all together."""
        if len(self) >= REMEMBERED:
            self.clear()
        new = [w for w in words.difference(self) if len(w) <= LEAF_BYTES]
        for first in range(0, len(new), TOGETHER):
            part = new[first : first + TOGETHER]
            self.update(zip(part, self.merges.merged_together([w.encode("utf-8", "replace") for w in part]), strict=True))

    def __missing__(self, word: str) -> bytes:
        return _packed(self.merges.encoded(word.encode("utf-8", "replace")))


class Encoder:
    """Ids of whole texts: words by a pattern, which leaves out no character, each by the merges."""

    def __init__(self, path: str, pattern: str):
        self.merges, self.pattern = Merges(path), regex.compile(pattern)
        self.words = Words(self.merges)

    def ids(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as 32-bit numbers."""
        for group in _groups(texts):
            leaves = [{a: self.pattern.findall(text, a, b) for a, b in _leaves(0, len(text))} for text in group]
            self.words.learn(set().union(*(words for leaf in leaves for words in leaf.values())))
            for text, leaf in zip(group, leaves, strict=True):
                yield b"".join(self._stretch(text, 0, len(text), leaf)[1])

    def _stretch(self, text: str, start: int, end: int, leaf: dict[int, list[str]]) -> tuple[list[int], list[bytes]]:
        """Where the words of a stretch end, and the ids of each."""
        if end - start <= LEAF_CHARS:
            ends = list(accumulate(map(len, leaf[start]), initial=start))
            return ends[1:], list(map(self.words.__getitem__, leaf[start]))
        half = (start + end) // 2
        left, right = self._stretch(text, start, half, leaf), self._stretch(text, half, end, leaf)
        return self._joined(text, start, left, right, half, end)

    def _joined(self, text: str, start: int, left: tuple, right: tuple, border: int, end: int) -> tuple[list[int], list[bytes]]:
        (ends, ids), (later, later_ids) = left, right
        first = len(ends)  # words of the left before this one stand
        while first and not _stands(ends[first - 2] if first > 1 else start, ends[first - 1], border):
            first -= 1
        at = ends[first - 1] if first else start
        # where words of the right end, and how many do by then
        met, taken = {border: 0, later[0]: 1}, 1
        while True:
            edge = later[taken - 1]
            words, here = [], at
            for word in self.pattern.findall(text, at, edge):
                stop = here + len(word)
                if edge < end and not _stands(here, stop, edge):
                    break
                words.append((here, stop))
                here = stop
                if stop in met:
                    rest = met[stop]
                    new = [self._between(text, a, b, ends, ids, later, later_ids, border, start) for a, b in words]
                    return ends[:first] + [b for _, b in words] + later[rest:], ids[:first] + new + later_ids[rest:]
            if edge == end:
                raise ValueError("the pattern leaves out characters")
            grown = min(2 * taken, len(later))
            met |= {later[k]: k + 1 for k in range(taken, grown)}
            taken = grown

    def _between(self, text, a, b, ends, ids, later, later_ids, border, start) -> bytes:
        """Ids of a word of the window: joined where it is one word of each side."""
        if a < border < b and ends[-1] == border and b == later[0] and a == (ends[-2] if len(ends) > 1 else start):
            both = (np.frombuffer(x, dtype=_ID).tolist() for x in (ids[-1], later_ids[0]))
            return _packed(self.merges.joined(*both))
        return self.words[text[a:b]]


def _groups(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in groups of bounded size, unless one text alone is longer."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _leaves(start: int, end: int) -> Iterator[tuple[int, int]]:
    """The leaves of the tree over a stretch."""
    if end - start <= LEAF_CHARS:
        yield start, end
    else:
        half = (start + end) // 2
        yield from _leaves(start, half)
        yield from _leaves(half, end)


def _stands(start: int, stop: int, edge: int) -> bool:
    """Whether a match in text that was cut at the edge is one whatever follows there."""
    return max(stop + 1, start + AHEAD) <= edge


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype=_ID).tobytes()


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of bounded bytes, unless one value alone is longer."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(sizes, dtype=np.int64), 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PART_BYTES, "right")))
            yield batch.slice(first, last - first)
            first = last


def _with(batch: pa.RecordBatch, drop: int, name: str, values: list[bytes]) -> pa.RecordBatch:
    kept = [i for i in range(batch.num_columns) if i != drop]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(i) for i in kept], pa.array(values, pa.binary())], names=[*[batch.schema.names[i] for i in kept], name]
    )


def _schema(rows: DataFrame, name: str) -> StructType:
    return StructType([*rows.schema.fields, StructField(name, BinaryType())])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The columns of documents without the text, and `ids`: its ids as 32-bit little-endian numbers.

    A null is an empty text; bytes that are no UTF-8 count as U+FFFD. A column named `ids` is set
    aside as `_ids`. Equal rows stay as many. Texts of any length are encoded whole, in the task
    that holds the row; a task keeps the ids of 300,000 words, and of those of one group of texts."""
    aside = {c: unused("_ids", docs.columns) for c in docs.columns if c.lower() == "ids" and c != text}
    rows = docs.withColumnsRenamed(aside).withColumn(text, F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "utf-8"))
    at = rows.columns.index(text)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in _parts(batches, at):
            texts = (x.as_py().decode("utf-8", "replace") for x in batch.column(at))
            yield _with(batch, at, "ids", list(encoder.ids(texts)))

    return rows.mapInArrow(of_batches, _schema(rows.drop(text), "ids"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of `encode`'s rows and `decoded`: the bytes of their ids. Null ids have none.

    A column named `decoded` is set aside as `_decoded`."""
    aside = {c: unused("_decoded", encoded.columns) for c in encoded.columns if c.lower() == "decoded"}
    rows = encoded.withColumnsRenamed(aside)
    at = rows.columns.index("ids")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(path)
        for batch in _parts(batches, at):
            found = [merges.decoded(np.frombuffer(x.as_py() or b"", dtype=_ID).tolist()) for x in batch.column(at)]
            yield _with(batch, -1, "decoded", found)

    return rows.mapInArrow(of_batches, _schema(rows, "decoded"))
