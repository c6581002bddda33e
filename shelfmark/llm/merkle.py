"""A Merkle manifest of a table: a tree of digests per source, and one over their roots.

Leaves are dealt to aligned blocks. A block keeps each of its levels as one string of hex digests
of fixed width, so a parent is the digest of a substring, and the siblings of a node are the
substrings before and behind it. The tops of the blocks are the leaves of the next round, until
a tree is one block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.ordered import in_slices
from shelfmark.session import cut

#: Nodes that share a parent, levels of a block, leaves of a block, characters of a digest.
ARITY, LEVELS = 3, 4
BLOCK = ARITY**LEVELS
WIDTH = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def told(value: Column) -> Column:
    """A value that cannot run into its neighbours: its bytes counted, `-` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**instead: Column) -> Column:
    """The digest of a document's five fields; `instead` replaces fields."""
    return digest(*[told(instead.get(f, F.col(f))) for f in FIELDS])


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to along its path."""
    return F.aggregate(path, start, lambda node, x: digest(x["left"], node, x["right"]))


def proof(path: Column) -> Column:
    """All siblings of a path, one string, level by level and left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def manifest(leaves: DataFrame) -> DataFrame:
    """tree, key and leaf of each row, and columns to carry, to the same with subroot, root and path.

    `tree` orders the trees (null first, bytewise); in a tree, leaves ascend by `key` (null first)
    and then by digest, so repeated keys have one order and repeated rows any. `path` holds for
    each level up to the root the siblings left and right of the node, as strings of digests. A
    lone leaf is its tree's root; an empty table gives no row.

    Nothing gathers a tree: leaves are numbered in slices of even size, hot trees spanning many,
    and then live in blocks of `BLOCK`, each a group of its own."""
    carried = [c for c in leaves.columns if c not in ("tree", "key", "leaf")]
    # the key of a tree is never null, and no two trees share one
    rows = cut(leaves.select(
        told(F.col("tree")).alias("id"), F.col("tree").cast("string").alias("tree"), "key", F.col("leaf").alias("digest"),
        F.struct("key", *carried).alias("row"),
    )).withColumn("tie", F.monotonically_increasing_id())
    nodes, most = numbered(rows, ["id"], ["id", "key", "digest", "tie"], ["row", "tree"])

    def crown(tops: DataFrame) -> DataFrame:
        """The subroots' own tree: one row a tree comes in, with its root and path it goes out."""
        one = tops.select(F.lit("").alias("all"), "id", F.col("tree").alias("order"), F.col("top").alias("digest"))
        named, trees = numbered(one, ["all"], ["order"], ["id"])
        named = named.withColumnRenamed("id", "row").withColumnRenamed("all", "id").withColumn("tree", F.lit(None).cast("string"))
        roots = climbed(named, trees, lambda x: x.select("id", "block", F.col("top").alias("root"), F.col("top").alias("subroot"), _nothing()))
        return roots.select(F.col("row").alias("id"), F.col("digest").alias("subroot"), "root", "path").join(
            tops.select("id", "block"), "id"
        )

    out = climbed(nodes, most, crown)
    return out.select("tree", "row.key", F.col("digest").alias("leaf"), *[F.col("row")[c].alias(c) for c in carried], "subroot", "root", "path")


def numbered(rows: DataFrame, group: list[str], order: list[str], keep: list[str]) -> tuple[DataFrame, int]:
    """The rows with their 0-based place in their group and its size n; and the largest size."""
    sliced = in_slices(rows, order)
    inside = Window.partitionBy("_slice", *group).orderBy(*order)
    counts = cut(sliced.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("rows")))
    # one row a slice and group, not one a row
    whole = Window.partitionBy(*group)
    offsets = counts.select(
        *group, "_slice", F.sum("rows").over(whole).alias("n"),
        (F.sum("rows").over(whole.orderBy("_slice")) - F.col("rows")).alias("before"),
    )
    found = sliced.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["_slice", *group])
    most = counts.groupBy(*group).agg(F.sum("rows").alias("n")).agg(F.max("n")).first()[0]
    return found.select(*group, *keep, "digest", "n", (F.col("before") + F.col("at")).alias("place")), most or 0


def climbed(nodes: DataFrame, most: int, above: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """id (of a tree), tree, n, place, digest, row to the same with subroot, root and path.

    `above` gets one row a tree (id, tree, block, top) and gives id, block, subroot, root, path."""
    blocks = cut(_blocks(nodes))
    if most <= BLOCK:
        heads = above(blocks.select("id", "tree", "block", "top"))
    else:
        tops = blocks.select(
            "id", "tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("place"),
            F.col("top").alias("digest"), F.lit(0).alias("row"),
        )
        heads = climbed(tops, -(-most // BLOCK), above).withColumnRenamed("place", "block")
    heads = heads.select("id", "block", "subroot", "root", F.col("path").alias("higher"))
    members = blocks.join(heads, ["id", "block"]).select(
        "id", "tree", "n", "subroot", "root", "higher", "levels", F.explode("members").alias("member")
    )
    own = F.transform(F.slice(F.sequence(F.lit(0), F.lit(LEVELS)), F.lit(1), F.size("levels") - 1), _siblings)
    return members.select(
        "id", "tree", "n", "member.place", "member.digest", "member.row", "subroot", "root", F.concat(own, "higher").alias("path")
    )


def _blocks(nodes: DataFrame) -> DataFrame:
    """id, tree, n, block, members, levels (the digests of each level in one string), top."""
    block = F.floor(F.col("place") / BLOCK).alias("block")
    members = F.sort_array(F.collect_list(F.struct("place", "digest", "row")))  # BLOCK rows at most
    # a tree of n nodes is climbed to its root or, beyond one block, to the top of each block
    depth = F.size(F.filter(F.array(*[F.lit(ARITY**k) for k in range(LEVELS)]), lambda p: p < F.col("n")))
    first = F.array(F.array_join(F.transform("members", lambda x: x["digest"]), ""))
    steps = F.slice(F.sequence(F.lit(1), F.lit(LEVELS)), F.lit(1), depth)
    levels = F.aggregate(steps, first, lambda found, _: F.concat(found, F.array(_parents(F.element_at(found, -1)))))
    grouped = nodes.groupBy("id", "tree", "n", block).agg(members.alias("members"))
    return grouped.withColumn("levels", levels).withColumn("top", F.element_at("levels", -1))


def _parents(level: Column) -> Column:
    """The next level's string: digests of substrings of `ARITY` nodes, the last perhaps shorter."""
    run = ARITY * WIDTH
    starts = F.sequence(F.lit(1), F.length(level), F.lit(run))
    return F.array_join(F.transform(starts, lambda at: F.sha2(F.substring(level, at, F.lit(run)), 256)), "")


def _siblings(height: Column) -> Column:
    """Left and right siblings of a member at a height of its block."""
    level = F.element_at("levels", height + 1)
    at = F.floor((F.col("member.place") % BLOCK) / F.pow(F.lit(ARITY), height)).cast("int")
    first = at - at % ARITY
    left = F.substring(level, first * WIDTH + 1, (at - first) * WIDTH)
    right = F.substring(level, (at + 1) * WIDTH + 1, (first + ARITY - 1 - at) * WIDTH)
    return F.struct(left.alias("left"), right.alias("right"))


def _nothing() -> Column:
    return F.array().cast(_PATH).alias("path")


def documents_manifest(docs: DataFrame, **carried: Column) -> DataFrame:
    """The manifest of documents: a tree per `source`, leaves by `doc_id`, further columns carried.

    Nulls are leaves like any other: a null field is told apart from an empty one. Columns other
    than the five fields are ignored, whatever their names."""
    return manifest(docs.select(
        F.col("source").cast("string").alias("tree"), F.col("doc_id").alias("key"), leaf().alias("leaf"),
        *[c.alias(name) for name, c in carried.items()],
    ))


def verified(docs: DataFrame, altered: Column) -> DataFrame:
    """Per document doc_id, leaf, subroot, root, proof_sha256, and whether a copy still belongs.

    `altered` is the text as some later copy has it; the copy's leaf is folded along the
    untampered document's path. `folded_root` equals `root` where nothing changed."""
    # a text that is the same keeps its digest, and is not hashed twice
    claim = F.when(altered.eqNullSafe(F.col("text")), F.lit(None)).otherwise(leaf(text=altered))
    found = documents_manifest(docs, claim=claim)
    found = found.withColumn("folded_root", folded(F.coalesce("claim", "leaf"), F.col("path")))
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
