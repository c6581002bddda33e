"""What the operators share: reading, cutting lineage, words of Arrow text, linking."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import cut

#: Bytes of text that a task handles at once, unless one text alone is longer.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, columns: list[str]) -> str:
    """The name, with as many underscores before it as it takes to be none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(text: str | Column) -> Column:
    """Text with A-Z lower-cased and nothing else; null becomes empty."""
    return F.translate(
        F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz",
    )


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word bytes: all but blank and the controls 9 to 13.
SPACED = np.ones(256, dtype=bool)
SPACED[[32, *range(9, 14)]] = False
#: Word bytes: digits, a-z and every byte beyond ASCII, of lower-cased text.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def texts(
    batch: pa.RecordBatch, column: str = "text", lower: bool = True
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of an Arrow batch in blocks of bounded bytes: first row, bytes (A-Z lower-cased
    unless told otherwise) and the n + 1 offsets of n rows. A null is an empty text."""
    values = batch.column(column).cast(pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    if not len(values):
        return
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(values):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1)
        block = data[offsets[first] : offsets[last]]
        yield first, LOWER[block] if lower else block, offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in a block, and for each text the number of its first word
    (n + 1 entries). `kind` says which bytes belong to words."""
    inside = kind[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), base, dtype=np.uint64)]), dtype=np.uint64)[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, equal for equal bytes wherever they stand: differences of one
    running polynomial, so no word is handled by itself."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=total[1:])
        value = (total[ends] - total[starts]) * _powers(_INVERSE, len(data))[starts]
        return mixed(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


#: Links that a task of `components` takes.
LINKS_A_TASK = 200_000


def components(edges: DataFrame) -> DataFrame:
    """Columns a, b (links) to node, component: the smallest node reachable. Nodes without a link
    to another node are left out.

    Alternating large and small stars: each round keeps one row per link at most, combines
    before shuffling and gathers no group; rounds grow with the logarithm of the diameter."""
    star = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state, parts = None, -(-star.count() // LINKS_A_TASK) + 1
    while True:
        # where partitions are not merged at run time, this keeps small links in few files
        star = star.coalesce(parts)
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts).distinct().coalesce(parts)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least).coalesce(parts).distinct()
        )
        star = cut(small.coalesce(parts))
        now = star.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state or not now[0]:
            break
        state = now
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


#: Keys that a task sorts at once, at least.
KEYS_AT_ONCE = 1 << 20
#: Keys are dealt by so many of their first bits; beyond those come pairs that have met already,
#: in rows of as many.
_PART_BITS, _MET = 12, 256
_PARTED = ["part", "keys", "nodes", "counts"]


def _sorted_pairs(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in the order of key, then node; and which are the first and the last of their key."""
    order = np.argsort(key)
    key, node = key[order], node[order]
    same = key[1:] == key[:-1]
    own = np.flatnonzero(np.append(False, same) | np.append(same, False))
    node[own] = node[own[np.lexsort((node[own], key[own]))]]
    fresh = np.append(True, ~same | (node[1:] != node[:-1]))[: len(key)]
    key, node = key[fresh], node[fresh]
    change = key[1:] != key[:-1]
    return key, node, np.append(True, change)[: len(key)], np.append(change, True)[: len(key)]


def _rows(part: np.ndarray, edges: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """A row for each stretch of some columns: its part, and the stretch of each column as an array."""
    offsets = pa.array(np.append(edges, len(columns[0])).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in columns]
    return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *lists], names=_PARTED[: 1 + len(lists)])


def _in_parts(by: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """`_rows` by the first bits of numbers in ascending order."""
    part = by >> (64 - _PART_BITS)
    edges = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[: len(part)]
    return _rows(part[edges], edges, *columns)


def _key_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Key and node of rows node, array of keys, in blocks."""
    held, size = [], 0
    for batch in batches:
        node, keys = batch.columns
        own = mixed(keys.flatten().to_numpy().view(np.uint64)).view(np.int64)
        held.append((own, np.repeat(node.to_numpy(), keys.value_lengths().fill_null(0).to_numpy())))
        size += len(own)
        if size >= KEYS_AT_ONCE:
            yield held
            held, size = [], 0
    if size:
        yield held


def _whole_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of rows in the order of part in blocks that hold whole parts; part once a number."""

    def block(held: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
        part, *lists = (pa.concat_arrays([x.column(c) for x in held]) for c in range(held[0].num_columns))
        return np.repeat(part.to_numpy(), lists[0].value_lengths().to_numpy()), *(x.flatten().to_numpy() for x in lists)

    held, size = [], 0
    for batch in batches:
        if not len(batch):
            continue
        # the last part of a batch may go on in the next one
        part = batch.column("part").to_numpy()
        ends = int(np.searchsorted(part, part[-1]))
        if held and (ends or held[-1].column("part")[-1].as_py() != part[0]) and size >= KEYS_AT_ONCE:
            yield block([*held, batch.slice(0, ends)])
            held, size, batch = [], 0, batch.slice(ends)
        held.append(batch)
        size += len(batch.column(1).flatten())
    if held:
        yield block(held)


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows node, keys to rows part, keys, nodes. Nodes that share a key inside a block have met, and only
    the least and the greatest of them go to the part of the key."""

    def block(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        key, node, head, tail = _sorted_pairs(*(np.concatenate(x) for x in zip(*held, strict=True)))
        many = ~(head & tail)
        met, meeting = (key[many], node[many]), (key[head | tail], node[head | tail])
        yield _in_parts(meeting[0], *meeting)
        edges = np.arange(0, len(met[0]), _MET)
        yield _rows(((met[0][edges] ^ met[1][edges]) & 4095) + (1 << _PART_BITS), edges, *met)

    for held in _key_blocks(batches):
        yield from block(held)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `_dealt` in the order of part to rows key, node where two nodes share the key."""

    for part, key, node in _whole_parts(batches):
        before = part >= 1 << _PART_BITS
        own, other, head, tail = _sorted_pairs(key[~before], node[~before])
        many = ~(head & tail)
        out = (np.append(key[before], own[many]), np.append(node[before], other[many]))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["key", "node"])


def shared_keys(rows: DataFrame) -> DataFrame:
    """key, node (distinct) of the keys that several nodes have, out of rows node, keys (an array
    of longs, of which key is a digest without collisions).

    Keys are sorted in blocks before they are dealt out, and move as arrays: most have one node.
    A key that many nodes have sends two of them a block to its part; the others need not meet."""
    dealt = rows.select("node", "keys").mapInArrow(_dealt, "part int, keys array<bigint>, nodes array<bigint>")
    return dealt.repartition("part").sortWithinPartitions("part").mapInArrow(_met, "key long, node long").distinct()


def merged(rows: DataFrame) -> DataFrame:
    """The rows, to be joined by a merge join. Spark sizes what explode makes by the rows before
    it, however many it makes of each, and would send all of them to the driver to broadcast them."""
    return rows.hint("merge")


def linked(
    buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], prepare: Callable[[DataFrame], None] | None = None,
    refine: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Components of the nodes that share a bucket and pass `verify`.

    `buckets` has key and node, or node and keys, an array of longs; `verify` takes pairs a, b and returns those that are links.
    `prepare`, if given, is called once with all nodes that share a bucket with another one.
    First every member of a bucket is held against one of its nodes. Buckets whose members then
    still lie in different components go to `refine`, if given, which returns finer buckets
    (key, node, weight, indexed, size, reach, counts, slack): every link between nodes of a bucket
    must share one in which one end is indexed, the sizes of both ends together must not exceed
    the reach of either, and their counts must not differ by more, in sum, than the slack of
    both. There it is done again, against the indexed node of most weight. What is
    open then is paired across components alone. A pair inside a component cannot change it,
    so the result is that of all pairs, while a bucket of n like nodes costs n checks."""
    if "keys" in buckets.columns:
        members = cut(shared_keys(buckets))
    else:
        shared = buckets.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
        members = cut(merged(buckets).join(shared.select("key"), "key").distinct())
    if prepare:
        prepare(members.select("node").distinct())
    plain = members.select("key", "node", *unranked())
    edges = cut(verify(_stars(plain.withColumn("class", F.col("node")))).select("a", "b"))
    classes = components(edges)
    members = cut(_open(plain, classes))
    if refine:
        members = cut(_open(refine(members.select("key", "node")).distinct(), classes))
        edges = edges.union(cut(verify(_stars(members)).select("a", "b")))
        classes = components(edges)
        members = cut(_open(members.drop("class"), classes))
    left, right = (members.withColumnsRenamed({c: f"{side}_{c}" for c in members.columns if c != "key"}) for side in "ab")
    rest = left.join(right.where("b_indexed"), "key").where(f"(a_class < b_class OR (a_class > b_class AND NOT a_indexed)) AND {_POSSIBLE}")
    rest = rest.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
    more = cut(verify(rest.distinct()).select("a", "b"))
    if more.isEmpty():
        return classes
    return components(edges.union(more))


_POSSIBLE = """least(a_reach, b_reach) >= a_size + b_size
    AND aggregate(zip_with(a_counts, b_counts, (x, y) -> abs(cast(x as int) - y)), 0, (s, x) -> s + x) <= a_slack + b_slack"""
_RANKS = ("size", "reach", "counts", "slack")


def unranked() -> list[Column]:
    """What `refine` returns beside key and node, where every pair of a bucket is possible."""
    numbers = [F.lit(0.0).alias(n) for n in ("weight", "size", "reach", "slack")]
    return [*numbers, F.lit(True).alias("indexed"), F.array().cast("array<tinyint>").alias("counts")]


def _open(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of buckets that hold two components or more, with their class."""
    labelled = members.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")
    several = labelled.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi")
    return labelled.join(several.select("key"), "key")


def _stars(members: DataFrame) -> DataFrame:
    """Pairs a, b of each bucket's indexed node of most weight with its nodes of other classes."""
    best = F.max(F.struct("weight", (-F.col("node")).alias("first"), "class", "node", *_RANKS)).alias("hub")
    hubs = members.where("indexed").groupBy("key").agg(best).select("key", *[F.col(f"hub.{c}").alias(f"b_{c}") for c in ("class", "node", *_RANKS)])
    pairs = members.withColumnsRenamed({c: f"a_{c}" for c in members.columns if c != "key"}).join(hubs, "key").where(f"a_class <> b_class AND {_POSSIBLE}")
    return pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows node, array of keys by the parts of the keys."""
    for held in _key_blocks(batches):
        key, node = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(key)
        yield _in_parts(key[order], key[order], node[order])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `_spread` in the order of part by the parts of the nodes, with how often each key stands."""
    for _, key, node in _whole_parts(batches):
        _, kind, often = np.unique(key, return_inverse=True, return_counts=True)
        by = mixed(node.view(np.uint64)).view(np.int64)
        order = np.argsort(by)
        yield _in_parts(by[order], key[order], node[order], often[kind][order])


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `_counted` in the order of part as a row for each node."""
    for _, key, node, often in _whole_parts(batches):
        order = np.lexsort((key, often, node))
        key, node, often = key[order], node[order], often[order]
        edges = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        n = np.diff(np.append(edges, len(node)))
        columns = [node[edges], np.add.reduceat(often, edges) / n, n, np.add.reduceat((often > 1).astype(np.int64), edges)]
        lists = pa.ListArray.from_arrays(np.append(edges, len(node)).astype(np.int32), pa.array(key))
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), lists], names=["node", "weight", "n", "common", "grams"])


def counted_keys(rows: DataFrame) -> DataFrame:
    """Of rows node (each once), grams (an array of distinct longs): node, weight (how often its
    grams stand, on average), n, common (those of other nodes too), and digests of the grams
    without collisions, the rarest first. Grams move as arrays, to the parts of grams and back."""
    part = "part int, keys array<bigint>, nodes array<bigint>"
    dealt = rows.select("node", "grams").mapInArrow(_spread, part).repartition("part").sortWithinPartitions("part")
    back = dealt.mapInArrow(_counted, f"{part}, counts array<bigint>").repartition("part").sortWithinPartitions("part")
    return back.mapInArrow(_ranked, "node long, weight double, n long, common long, grams array<bigint>")


def rare_keys(grams: DataFrame, keys: Column, indexed: Column, reach: Callable[[Column], Column], slack: Column) -> DataFrame:
    """Buckets for `linked`: the rarest of each node's grams, in one order for all nodes.

    `grams` has node, an array of distinct longs, and the counts by which two nodes are told
    apart. `keys` says how many of a node's `n` grams it brings, `indexed` how many of them it
    is found by. At the first gram that two nodes share, they share at most what each has from
    there on of grams that stand at another node too; `reach` makes of that number the most that
    the sizes of both may be together. Among many versions of one text the rarest grams are
    those of their differences, so versions that differ much do not meet; those that meet
    nevertheless are told apart by their counts, before any text is looked at. The weight, a
    node's mean frequency of grams, is largest for the version that most others share."""
    grams = cut(grams)
    sets = counted_keys(grams).withColumn("grams", F.slice("grams", F.lit(1), keys.cast("int"))).join(grams.select("node", "counts"), "node")
    dealt = sets.select(
        "node", "weight", indexed.alias("first"), "n", "common", "counts", slack.cast("double").alias("slack"),
        F.posexplode("grams").alias("place", "gram"),
    )
    most = F.least("common", F.col("n") - F.col("place"))
    return dealt.select(
        F.col("gram").alias("key"), "node", "weight", (F.col("place") < F.col("first")).alias("indexed"),
        F.col("n").cast("double").alias("size"), reach(most).cast("double").alias("reach"), "counts", "slack",
    )


def folded_counts(values: np.ndarray, places: int) -> np.ndarray:
    """How many of the numbers fall on each of some places, 127 at most. What is counted may
    change by one at no more than one place for a number that comes or goes."""
    counted = np.bincount((values % places).astype(np.int64), minlength=places)
    return np.minimum(counted, 127).astype(np.int8)


#: Nodes whose list is sent to all tasks, 8 bytes each; more are joined by a shuffle.
SENT_NODES = 1_000_000


def texts_of(candidates: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text of the given nodes out of a table with a row for every occurrence of a node."""
    nodes = cut(nodes.select("node").distinct())
    if nodes.count() <= SENT_NODES:
        nodes = F.broadcast(nodes)
    return cut(candidates.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")))


def with_both_texts(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """a, b, left, right: the texts of both nodes of a pair."""
    one = found.select(F.col("node").alias("a"), F.col("text").alias("left"))
    two = found.select(F.col("node").alias("b"), F.col("text").alias("right"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")


def checked_pairs(pairs: DataFrame, accept: Callable[[str, str], bool]) -> DataFrame:
    """The pairs a, b whose texts pass."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            passed = pa.array([accept(x, y) for x, y in both], pa.bool_())
            yield batch.select(["a", "b"]).filter(passed)

    return pairs.mapInArrow(of_batches, "a long, b long")
