"""Substring dedup: paragraphs banded by MinHash, and passages inside them at anchored places."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import SPACED, checked_pairs, folded_counts, linked, mixed, rare_keys, texts, texts_of, unused, with_both_texts, word_hashes, words
from shelfmark.session import cut, scratch

#: Words of a shingle.
SHINGLE = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` words."""
    n = max(0, len(hashes) - size + 1)
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            out = out * _ODD + hashes[k : k + n]
        return mixed(out)


def band_keys(shingles: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Of each run of shingles that begins at `starts`: a key for each band of `rows` least
    values under as many permutations."""
    out = np.zeros((len(starts), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(starts), b + 1, dtype=np.uint64)
            for r in range(rows):
                salt = mixed(np.array([b * rows + r + 1], dtype=np.uint64))[0] | np.uint64(1)
                least = np.minimum.reduceat((shingles ^ (shingles >> np.uint64(29))) * salt, starts)
                key = mixed(key * _ODD + least)
            out[:, b] = key
    return out


def paragraph_spans(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Paragraphs (lines) of at least `least` words in a block: text, first word in the block, end,
    and the words of the block: starts, ends, first word of each text."""
    starts, ends, first = words(data, offsets, SPACED)
    feeds = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([np.searchsorted(starts, feeds), first]))
    a, b = edges[:-1], edges[1:]
    long = b - a >= least
    a, b = a[long], b[long]
    return np.searchsorted(first, a, "right") - 1, a, b, starts, ends, first


def normal(raw: bytes) -> bytes:
    return b" ".join(raw.split())


def paragraph_rows(docs: DataFrame, least: int, bands: int, rows: int, text: bool = False) -> DataFrame:
    """A row for each paragraph: node (a 64-bit digest of its words), doc_id, start and end in
    words, and its band keys; or node and text."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for at, data, offsets in texts(batch):
                owner, a, b, starts, ends, first = paragraph_spans(data, offsets, least)
                if not len(a):
                    continue
                raw = data.tobytes()
                lines = [normal(raw[x:y]) for x, y in zip(starts[a].tolist(), ends[b - 1].tolist(), strict=True)]
                nodes = np.array([xxhash.xxh3_64_intdigest(x) for x in lines], dtype=np.uint64).view(np.int64)
                if text:
                    yield pa.record_batch([pa.array(nodes), pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())], names=["node", "text"])
                    continue
                # every run of words inside paragraphs, so that no shingle spans two of them
                shingles = shingle_hashes(word_hashes(data, starts, ends), SHINGLE)
                many = b - a - SHINGLE + 1
                begin = np.cumsum(many) - many
                inside = np.arange(many.sum()) - np.repeat(begin, many) + np.repeat(a, many)
                keys = band_keys(shingles[inside], begin, bands, rows).view(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), keys.ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes), pa.array(ids[at + owner].astype(np.int64)), pa.array(a - first[owner]), pa.array(b - first[owner]), lists],
                    names=["node", "doc_id", "start", "end", "keys"],
                )

    kind = "node long, text string" if text else "node long, doc_id long, start long, end long, keys array<bigint>"
    return _identified(docs).mapInArrow(of_batches, kind)


def _identified(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def similar(left: str, right: str, least: float) -> bool:
    """Whether the sets of five-word runs have a Jaccard similarity of `least`."""
    one, two = left.split(" "), right.split(" ")
    a = {tuple(one[k : k + SHINGLE]) for k in range(len(one) - SHINGLE + 1)}
    b = {tuple(two[k : k + SHINGLE]) for k in range(len(two) - SHINGLE + 1)}
    both = len(a & b)
    return both >= least * (len(a) + len(b) - both)


def rare_prefixes(members: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """The rarest five-word runs of each paragraph as its buckets, for `linked`.

    Of two sets as similar as asked, the larger shares one of its rarest (1 - s) n + 1 runs with
    the rarest (1 - 2 s / (1 + s)) n + 1 of the smaller, counted from the rarest on in one order
    for all: the smaller is found where it is indexed. Runs that no other paragraph has cannot
    be shared, which bounds the similarity of a pair: (1 + s) / s times what two sets share is
    at least the sum of their sizes."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, counts = [], []
            for line in batch.column("text").to_pylist():
                own = line.split(" ")
                own = {" ".join(own[k : k + SHINGLE]) for k in range(len(own) - SHINGLE + 1)}
                digests = {xxhash.xxh3_64_intdigest(r) for r in own}
                runs.append([x - (1 << 63) for x in digests])
                counts.append(folded_counts(np.fromiter(digests, dtype=np.uint64), 64).tolist())
            yield pa.record_batch(
                [batch.column("node"), pa.array(runs, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int8()))],
                names=["node", "grams", "counts"],
            )

    open_texts = found.join(members.select("node").distinct(), "node", "left_semi").select("node", "text")
    keys, indexed = (F.col("n") - F.ceil(F.col("n") * s - 1e-9) + 1 for s in (similarity, 2 * similarity / (1 + similarity)))
    rows = open_texts.mapInArrow(of_batches, "node long, grams array<bigint>, counts array<tinyint>")
    # of two sets that alike, (1 - s) / (1 + s) of both sizes together is in one of them only
    apart = F.col("n") * ((1 - similarity) / (1 + similarity)) + 1e-6
    return rare_keys(rows, keys, indexed, lambda most: most * ((1 + similarity) / similarity) + 1e-6, apart)


def block_anchors(hashes: np.ndarray, first: np.ndarray, size: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of runs of `size` words whose hash is the least among `reach` neighbours in a row of
    their text, with the hash and a second one independent of it. `first` has the first word of
    each text, and the end."""
    key = shingle_hashes(hashes, size)
    check = shingle_hashes(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5), size)
    begin, runs = first[:-1], first[1:] - first[:-1] - size + 1
    found = [begin[k : k + 1] + key[begin[k] : begin[k] + runs[k]].argmin() for k in np.flatnonzero((runs > 0) & (runs <= reach))]
    begin, many = begin[runs > reach], runs[runs > reach] - reach + 1
    if len(many):
        at = np.arange(many.sum()) + np.repeat(begin - np.cumsum(many) + many, many)
        rows = np.lib.stride_tricks.sliding_window_view(key, reach)
        step = 1 << 18
        found += [few + rows[few].argmin(1) for few in (at[k : k + step] for k in range(0, len(at), step))]
    place = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *found]))
    return place, key[place], check[place]


def anchors(hashes: np.ndarray, size: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`block_anchors` of one text."""
    return block_anchors(hashes, np.array([0, len(hashes)]), size, reach)


def anchor_rows(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, start, key, check of the anchored runs of `size` words of each document. Of any
    2 * size words that stand in two documents, both have the same anchored run."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for at, data, offsets in texts(batch):
                starts, ends, first = words(data, offsets, SPACED)
                place, key, check = block_anchors(word_hashes(data, starts, ends), first, size, size + 1)
                if not len(place):
                    continue
                owner = np.searchsorted(first, place, "right") - 1
                yield pa.record_batch(
                    [pa.array(ids[at + owner].astype(np.int64)), pa.array((place - first[owner]).astype(np.int64)), pa.array(key.view(np.int64)), pa.array(check.view(np.int64))],
                    names=["doc_id", "start", "key", "check"],
                )

    return _identified(docs).mapInArrow(of_batches, "doc_id long, start long, key long, check long")


def grown(own: np.ndarray, place: np.ndarray, size: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the runs of `size` words at the given places of texts that go from `low` to `high`: hash,
    and hashes of the run with 1 to `size` words more before it, then behind it, as many as there
    are; number of the former, and of both."""
    with np.errstate(over="ignore"):
        at = place[:, None] + np.arange(size)
        key = shingle_hashes(own[at].ravel(), size)[::size]
        check = shingle_hashes(own[at].ravel() ^ np.uint64(0xA5A5A5A5A5A5A5A5), size)[::size]
        out = np.zeros((len(place), 2 * size), dtype=np.uint64)
        for side in (0, 1):
            value = mixed(check + np.uint64(side + 1) * _ODD)
            for k in range(size):
                at = place + size + k if side else place - 1 - k
                value = mixed(value * _ODD + own[np.clip(at, 0, len(own) - 1)])
                out[:, side * size + k] = value
    before, behind = np.minimum(place - low, size), np.minimum(high - place - size, size)
    step = np.arange(2 * size)
    there = np.where(step < size, step < before[:, None], step - size < behind[:, None])
    return key, before, before + behind, out[there]


def grown_rows(docs: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """doc_id, start, key, n_before, values (see `grown`) of the runs at places doc_id, start."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("starts")
            for at, data, offsets in texts(batch):
                starts, ends, first = words(data, offsets, SPACED)
                hashes = word_hashes(data, starts, ends)
                lists = wanted.slice(at, len(offsets) - 1)
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                place = first[owner] + lists.flatten().to_numpy()
                inside = place + size <= first[owner + 1]
                owner, place = owner[inside], place[inside]
                for k in range(0, len(place), 2000):
                    few, text = place[k : k + 2000], owner[k : k + 2000]
                    key, before, both, values = grown(hashes, few, size, first[text], first[text + 1])
                    found = pa.ListArray.from_arrays(np.append(0, np.cumsum(both)).astype(np.int32), values.view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at + text].astype(np.int64)), pa.array(few - first[text]), pa.array(key.view(np.int64)), pa.array(before), found],
                        names=["doc_id", "start", "key", "n_before", "values"],
                    )

    by_doc = places.groupBy("doc_id").agg(F.collect_set("start").alias("starts"))
    rows = _identified(docs).join(by_doc, "doc_id").select("doc_id", "text", "starts")
    return rows.mapInArrow(of_batches, "doc_id long, start long, key long, n_before long, values array<bigint>")


#: What tells contexts of a run apart: the hash of the run, how many words around it count, and
#: the hashes that stand for all of them.
_CONTEXT = ["key", "n_before", "n_behind", "left", "right"]
#: Contexts of one run that a task compares at once; those of more common runs are joined word by word.
CONTEXTS = 500


def compared(key: np.ndarray, place: np.ndarray, n_before: np.ndarray, n_behind: np.ndarray, values: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of contexts sorted by key and first place (a number each): words before and behind that stand at another
    place, those that stand at an earlier one than its first, and the contexts of the first places
    of the words before (those at an earlier one, all of them); -1 if there are none."""
    m = len(key)
    own, fresh = np.arange(m), np.append(True, key[1:] != key[:-1])
    run, size = np.cumsum(fresh), max(int(n_before.max(initial=0)), int(n_behind.max(initial=0)))
    base = np.cumsum(n_before + n_behind) - n_before - n_behind
    reach, lo_kept, all_kept = np.zeros((4, m), dtype=np.int64), np.full(m, -1), np.full(m, -1)
    for side, (count, begin) in enumerate(((n_before, base), (n_behind, base + n_before))):
        for k in range(size):
            at = own[count > k]
            value, group = values[begin[at] + k], run[at]
            order = np.lexsort((value, group))
            value, group, at = value[order], group[order], at[order]
            new = np.append(True, (value[1:] != value[:-1]) | (group[1:] != group[:-1]))[: len(at)]
            number = np.cumsum(new) - 1
            first = at[new][number]
            later = place[first] != place[at]
            shared = np.bincount(number, later | several[at])[number] > 0
            reach[side, at[shared]] = k + 1
            reach[2 + side, at[later]] = k + 1
            if side == 0:
                all_kept[at[shared]], lo_kept[at[later]] = first[shared], first[later]
    return *reach, lo_kept, all_kept


_COMPARED = ("before", "behind", "lo_before", "lo_behind")


def compared_contexts(contexts: DataFrame) -> DataFrame:
    """The contexts of runs with `CONTEXTS` contexts at most, each with what `compared` says."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        key, n_before, n_behind, lo_doc, lo_start, hi_doc, hi_start = (
            rows.column(c).to_numpy() for c in ("key", "n_before", "n_behind", "lo_doc", "lo_start", "hi_doc", "hi_start")
        )
        values = rows.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        place = np.cumsum(np.append(True, (key[1:] != key[:-1]) | (lo_doc[1:] != lo_doc[:-1]) | (lo_start[1:] != lo_start[:-1])))
        *reach, lo_kept, all_kept = compared(key, place, n_before, n_behind, values, (lo_doc != hi_doc) | (lo_start != hi_start))
        out = [rows.column(c).combine_chunks() for c in (*_CONTEXT, "lo_doc", "lo_start")] + [pa.array(r) for r in reach]
        for kept in (lo_kept, all_kept):
            out += [pa.array(x[kept], mask=kept < 0) for x in (lo_doc, lo_start)]
        return pa.RecordBatch.from_arrays(out, names=names)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            # the last run of a batch may go on in the next one
            key = batch.column("key").to_numpy()
            ends = int(np.searchsorted(np.cumsum(np.append(False, key[1:] != key[:-1])), np.count_nonzero(key[1:] != key[:-1])))
            if kept and (ends or kept[-1].column("key")[-1] != batch.column("key")[0]):
                yield block(pa.Table.from_batches([*kept, batch.slice(0, ends)]))
                kept = []
            elif ends:
                yield block(pa.Table.from_batches([batch.slice(0, ends)]))
            kept.append(batch.slice(ends))
        if kept:
            yield block(pa.Table.from_batches(kept))

    names = [*_CONTEXT, "lo_doc", "lo_start", *_COMPARED, "lo_kept_doc", "lo_kept_start", "all_kept_doc", "all_kept_start"]
    flat = contexts.select(
        *_CONTEXT, F.col("lo.doc_id").alias("lo_doc"), F.col("lo.start").alias("lo_start"), F.col("hi.doc_id").alias("hi_doc"),
        F.col("hi.start").alias("hi_start"), "values",
    )
    found = flat.repartition("key").sortWithinPartitions("key", "lo_doc", "lo_start").mapInArrow(of_batches, ", ".join(f"{n} long" for n in names))
    return found.select(*_CONTEXT, *[
        F.when(F.col(f"{n}_doc").isNotNull(), F.struct(F.col(f"{n}_doc").alias("doc_id"), F.col(f"{n}_start").alias("start"))).alias(n) for n in ("lo", "lo_kept", "all_kept")
    ], *_COMPARED)


def joined_contexts(contexts: DataFrame) -> DataFrame:
    """As `compared_contexts`, for runs with any number of contexts: a join by each word."""
    values = contexts.select(*_CONTEXT, "lo", "hi", F.posexplode("values").alias("k", "value"))
    first = values.groupBy("key", "value").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).where("first <> last").drop("last")
    left, earlier = F.col("k") < F.col("n_before"), F.col("lo") != F.col("first")
    n = F.when(left, F.col("k") + 1).otherwise(F.col("k") - F.col("n_before") + 1)
    most = {"before": left, "behind": ~left, "lo_before": left & earlier, "lo_behind": ~left & earlier}
    found = values.join(first, ["key", "value"]).groupBy(*_CONTEXT, "lo").agg(
        F.max_by("first", F.when(left & earlier, n)).alias("lo_kept"), F.max_by("first", F.when(left, n)).alias("all_kept"),
        *[F.coalesce(F.max(F.when(test, n)), F.lit(0)).cast("long").alias(c) for c, test in most.items()],
    )
    return found.select(*_CONTEXT, "lo", "lo_kept", "all_kept", *_COMPARED)


def reaches(docs: DataFrame, places: DataFrame, size: int, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """doc_id, start, and how many words (`size` at most) before and behind the run there stand
    with it at another place, and at an earlier one; kept: where the earliest of these is.

    Places with the same run and the same words around it as far as that are one context, and
    contexts are compared: all but the first place of one have all of it at an earlier place."""
    where = F.struct("doc_id", "start")
    before, behind = F.col("n_before"), (F.size("values") - F.col("n_before")).cast("long")
    rows = grown_rows(docs, places, size).withColumn("n_behind", behind)
    # each value is a hash of all words up to it, so the last ones stand for all
    for name, n, at in (("left", before, before), ("right", F.col("n_behind"), F.size("values"))):
        rows = rows.withColumn(name, F.when(n > 0, F.try_element_at("values", at.cast("int"))).otherwise(0))
    rows = keep(rows)
    contexts = keep(rows.groupBy(*_CONTEXT).agg(F.min(where).alias("lo"), F.max(where).alias("hi"), F.first("values").alias("values")))
    common = cut(contexts.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CONTEXTS).select("key"))
    if common.isEmpty():
        found = compared_contexts(contexts)
    else:
        found = compared_contexts(contexts.join(F.broadcast(common), "key", "left_anti"))
        found = found.union(joined_contexts(contexts.join(F.broadcast(common), "key", "left_semi")))
    own = where == F.col("lo")
    reach = rows.select("doc_id", "start", *_CONTEXT).join(found, _CONTEXT).select(
        "doc_id", "start", "before", "behind", F.when(own, F.col("lo_before")).otherwise(F.col("n_before")).alias("earlier_before"),
        F.when(own, F.col("lo_behind")).otherwise(F.col("n_behind")).alias("earlier_behind"), F.when(own, F.col("lo_kept")).otherwise(F.col("all_kept")).alias("kept"),
    )
    # a place has several contexts where rows share a doc_id
    most = [F.max(c).alias(c) for c in ("before", "behind", "earlier_before", "earlier_behind")]
    return reach.groupBy("doc_id", "start").agg(*most, F.max_by("kept", "earlier_before").alias("kept"))


def repeated_passages(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, start, end, class, first_doc_id, first_start, removed of the stretches of anchored
    runs that stand at two places, with the words around them that do so too."""
    with scratch(docs.sparkSession) as keep:
        with scratch(docs.sparkSession) as brief:
            found = keep(_repeated_runs(brief(anchor_rows(docs, size)), size))
        edges = found.where("edge").select("key", "check").distinct()
        places = found.join(edges, ["key", "check"], "left_semi").select("doc_id", "start")
        with scratch(docs.sparkSession) as brief:
            reach = keep(reaches(docs, places, size, brief))
        return cut(_stretches(found, reach, size))


def _repeated_runs(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, start, key, check, first, removed, edge of the anchored runs that stand at two places:
    where the first one is, whether this is another, and whether a stretch of them ends here."""
    where = F.struct("doc_id", "start")
    first = rows.groupBy("key", "check").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first <> last").drop("last")
    found = rows.join(first, ["key", "check"]).select("doc_id", "start", "key", "check", "first", (where != F.col("first")).alias("removed"))
    inside = Window.partitionBy("doc_id", "removed").orderBy("start")
    # the words between two runs that touch are theirs; only where runs end, words may be missing
    apart = [F.coalesce(d > size, F.lit(True)) for d in (F.col("start") - F.lag("start").over(inside), F.lead("start").over(inside) - F.col("start"))]
    return found.withColumn("edge", apart[0] | apart[1])


def _stretches(found: DataFrame, reach: DataFrame, size: int) -> DataFrame:
    """`repeated_passages` of the runs, and how far the words around them go."""
    where = F.struct("doc_id", "start")
    found = found.join(reach, ["doc_id", "start"], "left").na.fill(0, ["before", "behind", "earlier_before", "earlier_behind"])

    def spans(rows: DataFrame, removed: bool, before: str, behind: str, kept: Column) -> DataFrame:
        return rows.select(
            "doc_id", F.lit(removed).alias("removed"), (F.col("start") - F.col(before)).alias("start"), (F.col("start") + size + F.col(behind)).alias("end"),
            "key", kept["doc_id"].alias("first_doc_id"), (kept["start"] - F.col(before)).alias("first_start"),
        )

    # a place that is not the first of its run may be the first of a longer one
    longer = "NOT removed OR before > earlier_before OR behind > earlier_behind"
    both = spans(found.where("removed"), True, "earlier_before", "earlier_behind", F.coalesce("kept", "first"))
    both = both.union(spans(found.where(longer), False, "before", "behind", where))
    inside = Window.partitionBy("doc_id", "removed").orderBy("start", "end")
    fresh = F.coalesce(F.col("start") > F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")
    run = F.sum("fresh").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("fresh", fresh).withColumn("run", run).groupBy("doc_id", "removed", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("key").alias("class"),
        F.min(F.struct("first_doc_id", F.col("start").alias("at"), "first_start")).alias("first"),
    ).select("doc_id", "removed", "start", "end", "class", "first.first_doc_id", "first.first_start")


def repeats(docs: DataFrame, least: int = 25, similarity: float = 0.8, bands: int = 9, rows: int = 3) -> DataFrame:
    """A row for each repeated stretch of a document: doc_id, start, end (in words, end excluded),
    kind, class, first_doc_id, first_start, removed.

    kind paragraph: a line of at least `least` words with a like one (Jaccard similarity of its
    five-word runs, links followed to components) elsewhere in the table; nine bands of three
    find 99.8 % of the pairs at 0.8, and more beyond it. kind passage: a stretch that stands word
    for word at another place, wherever lines end: each of at least 2 * `least` words is found
    from its first to its last word. The first place by doc_id, then
    start, is kept, the others are marked as removed. Words are A-Z lower-cased and parted by
    white space. Rows without doc_id count for nothing; rows with the same doc_id are one
    document. Null, empty and short texts have no stretches. Other columns are ignored. An empty
    table gives none."""
    with scratch(docs.sparkSession) as keep:
        whole = cut(repeated_paragraphs(docs, keep(paragraph_rows(docs, least, bands, rows)), least, similarity, bands, rows))
    return whole.union(repeated_passages(docs, least).withColumn("kind", F.lit("passage")).select(*whole.columns))


def repeated_paragraphs(docs: DataFrame, found: DataFrame, least: int, similarity: float, bands: int, rows: int) -> DataFrame:
    """The paragraphs of `repeats`, out of all paragraphs with their keys."""
    kept: list[DataFrame] = []

    def prepare(nodes: DataFrame) -> None:
        kept.append(texts_of(paragraph_rows(docs, least, bands, rows, text=True), nodes))

    def close(pairs: DataFrame) -> DataFrame:
        return checked_pairs(with_both_texts(pairs, kept[0]), lambda a, b: similar(a, b, similarity))

    classes = linked(found.select("node", "keys"), close, prepare, lambda members: rare_prefixes(members, kept[0], similarity))
    members = found.join(classes, "node", "left").select("doc_id", "start", "end", F.coalesce("component", "node").alias("class"))
    where = F.struct("doc_id", "start")
    first = members.groupBy("class").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first <> last").drop("last")
    return members.join(first, "class").select(
        "doc_id", "start", "end", F.lit("paragraph").alias("kind"), "class", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.start").alias("first_start"), (where != F.col("first")).alias("removed"),
    )


def drop_repeats(docs: DataFrame, **options) -> DataFrame:
    """All documents with all their columns; the removed stretches are cut out of their texts,
    with the white space behind them."""
    doc, lost = unused("doc", docs.columns), unused("lost", docs.columns)
    gone = repeats(docs, **options).where("removed").groupBy(F.col("doc_id").alias(doc)).agg(F.collect_list(F.struct("start", "end")).alias(lost))
    joined = docs.withColumn("text", F.col("text").cast("string")).join(gone, F.col("doc_id").cast("long") == F.col(doc), "left").drop(doc)
    schema, place = docs.withColumn("text", F.col("text").cast("string")).schema, docs.columns.index("text")
    names, last = schema.names, len(docs.columns)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [cut_out(t, s) for t, s in zip(batch.column(place).to_pylist(), batch.column(last).to_pylist(), strict=True)]
            columns = [*batch.columns[:place], pa.array(out, pa.string()), *batch.columns[place + 1 : last]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(of_batches, schema)


def cut_out(text: str | None, spans: list[dict] | None) -> str | None:
    """A text without the given stretches of words."""
    if text is None or not spans:
        return text
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, _, _ = words(data, np.array([0, len(raw)]), SPACED)
    edge = np.append(starts, len(raw)).tolist()
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
        a, b = edge[span["start"]], edge[span["end"]]
        if a > at:
            out.append(raw[at:a])
        at = max(at, b)
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace")
