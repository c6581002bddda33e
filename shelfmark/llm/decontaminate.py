"""Benchmark decontamination: suffix arrays of the training words, searched by test suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import ALNUM, texts, unused, word_hashes, words

#: Bytes of test texts that travel to the tasks at once; longer test sets take more passes.
TEST_BYTES = 8 << 20


def suffix_array(line: np.ndarray, depth: int) -> np.ndarray:
    """Positions of `line` (small non-negative integers) in the order of their suffixes, to
    `depth` entries at least; behind the end stand zeros. Prefix doubling from three entries on
    (one, if they are too many to sort three at once), sorting anew only what still ties."""
    n = len(line)
    if n and line.max() < 1 << 21:
        padded = np.concatenate([line, np.zeros(2, dtype=np.int64)])
        known, key = 3, (padded[:n] << 42) | (padded[1 : n + 1] << 21) | padded[2:]
    else:
        known, key = 1, line
    order = np.argsort(key, kind="stable")
    changes = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = 0
    while True:
        heads = np.flatnonzero(changes)
        sizes = np.diff(np.append(heads, n))
        rank[order] = np.repeat(heads, sizes) + 1
        if known >= depth or len(heads) == n:
            return order
        tied = np.flatnonzero(np.repeat(sizes, sizes) > 1)
        who = order[tied]
        second = rank[np.minimum(who + known, n)]
        key = (rank[who] << 32) | second
        inner = np.argsort(key, kind="stable")
        order[tied] = who[inner]
        key = key[inner]
        changes[tied] = np.concatenate([[True], key[1:] != key[:-1]])
        known *= 2


def narrowed(line: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each range of the suffix array, whose suffixes agree in `depth` entries, the part that
    goes on with a value: binary search of all ranges side by side. `line` is padded."""
    bounds = []
    for beyond in (0, 1):
        a, b = lo.copy(), hi.copy()
        while (open_ := a < b).any():
            middle = (a + b) >> 1
            less = open_ & (line[order[np.minimum(middle, len(order) - 1)] + depth] < value + beyond)
            a = np.where(less, middle + 1, a)
            b = np.where(open_ & ~less, middle, b)
        bounds.append(a)
    return bounds[0], bounds[1]


class Tests(NamedTuple):
    """Test items: ids, words of all items one after another, their hashes, where each item
    begins, and the windows: item, place of the first word, number of words."""

    ids: list[str]
    words: list[bytes]
    hashes: np.ndarray
    first: np.ndarray
    windows: np.ndarray


def prepared(items: list[tuple], window: int) -> Tests:
    """Every suffix of an item with at least `window` words is searched for its first `window`;
    a shorter item as a whole."""
    batch = pa.record_batch([pa.array([t or "" for _, t in items], pa.string())], names=["text"])
    all_words: list[bytes] = []
    hashes, first, windows = [], [0], []
    for _, data, offsets in texts(batch):
        raw = data.tobytes()
        starts, ends, at = words(data, offsets, ALNUM)
        hashes.append(word_hashes(data, starts, ends))
        base = len(all_words)
        all_words += [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        first += (at[1:] + base).tolist()
    for k in range(len(items)):
        n, size = first[k + 1] - first[k], min(window, first[k + 1] - first[k])
        windows += [(k, first[k] + w, size) for w in range(n - size + 1) if size]
    return Tests(
        [str(i) for i, _ in items], all_words, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
        np.array(first), np.array(windows, dtype=np.int64).reshape(-1, 3),
    )


def matches(data: np.ndarray, offsets: np.ndarray, tests: Tests, depth: int) -> tuple[np.ndarray, list[list[tuple[int, int, str]]]]:
    """Of the texts of a block: the number of words of each, and its longest verbatim matches
    with items: first word, end, item."""
    starts, ends, first = words(data, offsets, ALNUM)
    n = np.diff(first)
    found: list[list[tuple[int, int, str]]] = [[] for _ in n]
    hashes = word_hashes(data, starts, ends)
    vocabulary, rank = np.unique(hashes, return_inverse=True)
    if not len(tests.windows) or not len(vocabulary):
        return n, found
    place = np.searchsorted(vocabulary, tests.hashes)
    present = (place < len(vocabulary)) & (vocabulary[np.minimum(place, len(vocabulary) - 1)] == tests.hashes)
    missing = np.concatenate([[0], np.cumsum(~present)])
    item, at, size = tests.windows.T
    whole = missing[at + size] == missing[at]
    item, at, size = item[whole], at[whole], size[whole]
    if not len(item):
        return n, found
    value = np.where(present, place + 1, 0)
    # a zero behind each text keeps suffixes apart
    spot = np.arange(len(rank)) + np.repeat(np.arange(len(n)), n)
    line = np.zeros(len(rank) + len(n), dtype=np.int64)
    line[spot] = rank + 1
    order = suffix_array(line, depth)
    padded = np.concatenate([line, np.zeros(depth + 1, dtype=np.int64)])
    lo, hi = np.zeros(len(item), dtype=np.int64), np.full(len(item), len(order))
    done: list[tuple[np.ndarray, ...]] = []
    for d in range(int(size.max())):
        lo, hi = narrowed(padded, order, lo, hi, d, value[at + d])
        some = lo < hi
        item, at, size, lo, hi = item[some], at[some], size[some], lo[some], hi[some]
        ready = size == d + 1
        done.append(tuple(x[ready] for x in (item, at, size, lo, hi)))
        item, at, size, lo, hi = (x[~ready] for x in (item, at, size, lo, hi))
    item, at, size, lo, hi = (np.concatenate(x) for x in zip(*done, strict=True))
    if not len(item):
        return n, found
    # every occurrence; those of one item on one diagonal join to the longest match
    many = hi - lo
    which = np.repeat(np.arange(len(item)), many)
    where = order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + lo[which]]
    begin = first[:-1] + np.arange(len(n))
    doc = np.searchsorted(begin, where, "right") - 1
    word, shift = where - begin[doc], where - at[which]
    order = np.lexsort((word, shift, item[which]))
    raw = data.tobytes()
    last: tuple | None = None

    def keep(k: int, t: int, a: int, b: int, shift: int) -> None:
        own = first[k] + a
        test = int(begin[k] + a - shift)
        if [raw[starts[own + x] : ends[own + x]] for x in range(b - a)] == tests.words[test : test + b - a]:
            found[k].append((a, b, tests.ids[t]))

    for k, t, a, s, length in zip(doc[order].tolist(), item[which][order].tolist(), word[order].tolist(), shift[order].tolist(), size[which][order].tolist(), strict=True):
        if last and last[0] == k and last[1] == t and last[4] == s and a <= last[3]:
            last = (k, t, last[2], max(last[3], a + length), s)
        else:
            if last:
                keep(*last)
            last = (k, t, a, a + length, s)
    keep(*last)
    return n, found


def covered(spans: list[tuple[int, int, str]]) -> int:
    """Words inside any of the spans."""
    total, reach = 0, 0
    for a, b, _ in sorted(spans):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


_FOUND = {"n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean"}
_TYPES = {"long": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType()}
_MATCH = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("item_id", T.StringType())]))


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The test items in blocks of bounded bytes."""
    sized = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // TEST_BYTES) or 1
    for k in range(count):
        yield [tuple(r) for r in sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()]


def with_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """All rows and columns of `docs` with n_words, n_hit, n_items, items_sha256, contaminated and
    matches (start, end in words, item_id): the longest verbatim matches of each text.

    Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII. An
    item's windows are its runs of `window` words, of a shorter item its whole; a word inside an
    occurrence of a window is hit. Each task holds a shard of whole texts as a suffix array over
    words, as deep as the longest item, and every test suffix is searched in every shard. Null
    texts and items have no words and match nothing; repeated items count once by their id, and
    repeated rows are searched each for itself. Without items nothing is contaminated. Columns
    named like a result are replaced."""
    docs = docs.drop(*_FOUND, "matches").withColumn("text", F.col("text").cast("string"))
    place, width = docs.columns.index("text"), len(docs.columns)
    schema = T.StructType([
        *docs.schema.fields, *(T.StructField(n, _TYPES[t]) for n, t in _FOUND.items()), T.StructField("matches", _MATCH),
    ])
    names = schema.names
    arrow = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("item_id", pa.string())]))]
    out = docs
    for block in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def of_batches(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tests = prepared(shared.value, window)
            depth = int(np.diff(tests.first).max(initial=1))
            for batch in batches:
                rows: list[tuple] = []
                earlier = batch.column(width + 5).to_pylist() if batch.num_columns > width else [None] * batch.num_rows
                text = pa.record_batch([batch.column(place)], names=["text"])
                for at, data, offsets in texts(text):
                    n, found = matches(data, offsets, tests, depth)
                    for k, spans in enumerate(found):
                        spans = spans + [(m["start"], m["end"], m["item_id"]) for m in earlier[at + k] or []]
                        ids = sorted({i for *_, i in spans})
                        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
                        hit = covered(spans)
                        rows.append((int(n[k]), hit, len(ids), digest, hit > 0, [dict(zip(("start", "end", "item_id"), s, strict=True)) for s in sorted(spans)]))
                columns = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 6, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], *columns], names=names)

        out = out.mapInArrow(of_batches, schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """A row for each document: doc_id and the results of `with_matches`."""
    return with_matches(docs.select("doc_id", "text"), benchmark, window).drop("text")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without any match, with their columns as they are, whatever their names."""
    aside = {c: unused(f"_{c}", docs.columns) for c in docs.columns if c.lower() in (*_FOUND, "matches")}
    clean = with_matches(docs.withColumnsRenamed(aside), benchmark, window).where("NOT contaminated")
    return clean.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
