"""Embedding near-duplicates by a robust-pruned graph over overlapping cluster shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import components
from shelfmark.session import cut

#: What float32 may lose of a cosine; found neighbours are verified in double precision.
_SLACK = 1e-3


def stacked(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equally long float arrays as a matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one, scaled first so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the vectors that can link: of the commonest length, without null or
    non-finite components, not zero, with an id."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    width = rows.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size(v) == (width["d"] if width else 0))


def centroids(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of a sample of unit vectors."""
    rng = np.random.default_rng(7)
    centres = sample[rng.choice(len(sample), size=min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, sample)
        size = np.linalg.norm(total, axis=1)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1e-12)[:, None], centres)
    return centres


def in_clusters(rows: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """rep, embedding, cluster, home: a row for each of the `overlap` nearest clusters."""
    shared = rows.sparkSession.sparkContext.broadcast(centres.astype(np.float32))
    overlap = min(overlap, len(centres))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = unit(stacked(batch.column("embedding"))).astype(np.float32) @ shared.value.T
            near = np.argsort(-scores, axis=1, kind="stable")[:, :overlap]
            for k in range(overlap):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep"), batch.column("embedding"), pa.array(near[:, k].astype(np.int64))],
                    names=["rep", "embedding", "cluster"],
                )

    return rows.select("rep", "embedding").mapInArrow(of_batches, "rep long, embedding array<double>, cluster long")


def medoids(x: np.ndarray, count: int) -> np.ndarray:
    """Members of a shard nearest to the centres of a few groups of it."""
    return np.unique((centroids(x, count, 4) @ x.T).argmax(1))


def robust_graph(x: np.ndarray, degree: int, pool: int, alpha: float) -> np.ndarray:
    """Neighbours of each row of unit vectors, -1 where there are fewer.

    Candidates are the nearest rows, some random ones and the medoids. The nearest candidate
    becomes a neighbour and removes those that lie nearer to it, by the factor alpha, than to
    the row; so few edges lead both near and far. Edges are added backwards, up to the degree."""
    n = len(x)
    if n == 1:
        return np.full((1, 1), -1)
    rng = np.random.default_rng(n)
    pool, far = min(pool, n - 1), medoids(x, 16)
    out = np.full((n, degree), -1)
    for a in range(0, n, 512):
        b = min(a + 512, n)
        scores = x[a:b] @ x.T
        scores[np.arange(b - a), np.arange(a, b)] = -2
        near = np.argpartition(-scores, pool - 1, axis=1)[:, :pool]
        extra = np.concatenate([rng.integers(0, n, (b - a, 16)), np.broadcast_to(far, (b - a, len(far)))], axis=1)
        candidates = np.concatenate([near, extra], axis=1)
        away = 1 - np.take_along_axis(scores, candidates, axis=1)
        open_ = candidates != np.arange(a, b)[:, None]
        places = x[candidates]
        rows = np.arange(b - a)
        for k in range(degree):
            best = np.where(open_, away, np.inf).argmin(1)
            some = open_[rows, best]
            if not some.any():
                break
            out[a:b, k] = np.where(some, candidates[rows, best], -1)
            between = 1 - np.einsum("ncd,nd->nc", places, places[rows, best])
            open_ &= (alpha * between > away) | ~some[:, None]
            open_ &= candidates != candidates[rows, best][:, None]
    rows, k = np.nonzero(out >= 0)
    ends = out[rows, k]
    order = np.lexsort((k, ends))
    ends, rows = ends[order], rows[order]
    place = np.arange(len(ends)) - np.searchsorted(ends, ends)
    back = np.full((n, degree), -1)
    back[ends[place < degree], place[place < degree]] = rows[place < degree]
    return np.concatenate([out, back], axis=1)


def range_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs query, row of cosine `least` or more that a walk through the graph meets.

    All queries of a block walk side by side. Each starts from the medoids and expands the
    nearest of its beam until the whole beam is expanded; then it expands every row found in
    range, until these lead to no new one. Rows are compared once a query."""
    starts, found_q, found_x, step = medoids(x, 16), [], [], 4
    for a in range(0, len(queries), 256):
        q = queries[a : a + 256]
        n = len(q)
        seen = np.zeros((n, len(x)), dtype=bool)
        hit = np.zeros_like(seen)
        expanded = np.zeros_like(seen)

        def visit(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Cosines of the given rows (-1: none) where they are new, and else -2."""
            score = np.full(nodes.shape, -2.0, dtype=np.float32)
            r, c = np.nonzero((nodes >= 0) & ~seen[np.arange(n)[:, None], nodes])
            flat = nodes[r, c]
            _, once = np.unique(r * len(x) + flat, return_index=True)
            r, c, flat = r[once], c[once], flat[once]
            value = np.einsum("ij,ij->i", q[r], x[flat])
            seen[r, flat] = True
            score[r, c] = value
            hit[r[value >= least - _SLACK], flat[value >= least - _SLACK]] = True
            return nodes, score

        nodes, score = visit(np.broadcast_to(starts, (n, len(starts))).copy())
        while True:
            waiting = (score > -2) & ~expanded[np.arange(n)[:, None], nodes]
            if not waiting.any():
                break
            ranked = np.where(waiting, score, -2)
            width = min(step, ranked.shape[1])
            pick = np.argpartition(-ranked, width - 1, axis=1)[:, :width]
            chosen = np.where(np.take_along_axis(ranked, pick, 1) > -2, np.take_along_axis(nodes, pick, 1), -1)
            r, c = np.nonzero(chosen >= 0)
            expanded[r, chosen[r, c]] = True
            next_ = np.where((chosen >= 0)[:, :, None], graph[chosen], -1).reshape(n, -1)
            more, value = visit(next_)
            nodes, score = np.concatenate([nodes, more], 1), np.concatenate([score, value], 1)
            if nodes.shape[1] > beam:
                keep = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
                nodes, score = np.take_along_axis(nodes, keep, 1), np.take_along_axis(score, keep, 1)
        while (left := hit & ~expanded).any():
            r, c = np.nonzero(left)
            place = np.arange(len(r)) - np.searchsorted(r, r)
            r, c, place = r[place < 8], c[place < 8], place[place < 8]
            expanded[r, c] = True
            chosen = np.full((n, 8), -1)
            chosen[r, place] = c
            visit(np.where((chosen >= 0)[:, :, None], graph[chosen], -1).reshape(n, -1))
        r, c = np.nonzero(hit)
        found_q.append(r + a)
        found_x.append(c)
    return np.concatenate(found_q), np.concatenate(found_x)


def found_pairs(reps: DataFrame, centres: np.ndarray, least: float, shard_rows: int, overlap: int, degree: int, beam: int) -> DataFrame:
    """a, b (a < b) of the links found between distinct vectors."""
    members = cut(in_clusters(reps, centres, overlap))
    # a cluster beyond the shard size is dealt to several shards
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n")).select("cluster", F.ceil(F.col("n") / shard_rows).alias("shards"))
    members = members.join(sizes, "cluster").withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")))

    def build(group: pa.Table) -> pa.Table:
        rep = group.column("rep").to_numpy()
        order = np.argsort(rep)
        graph = robust_graph(unit(stacked(group.column("embedding")))[order].astype(np.float32), degree, 3 * degree, 1.2)
        rep = rep[order]
        flat, keep = rep[graph], graph >= 0
        steps = np.concatenate([[0], np.cumsum(keep.sum(1))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(steps, flat[keep])
        return pa.table({"rep": rep, "near": lists})

    shards = members.select("rep", "embedding", "cluster", "shard").groupBy("cluster", "shard")
    graph = shards.applyInArrow(build, "rep long, near array<bigint>")
    graph = cut(graph.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    # every shard, once with its own rows as queries, once with those of each other shard of its cluster
    walks = members.join(graph, "rep").withColumn("visitor", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    nodes = walks.select("cluster", "shard", "visitor", "rep", "embedding", "near")
    queries = walks.where("shards > 1 AND visitor <> shard").select(
        "cluster", F.col("visitor").alias("shard"), F.col("shard").alias("visitor"), "rep", "embedding", F.lit(None).cast("array<bigint>").alias("near")
    )

    def search(group: pa.Table) -> pa.Table:
        own = group.column("near").is_valid().to_numpy()
        rep, vectors = group.column("rep").to_numpy(), unit(stacked(group.column("embedding")))
        order = np.argsort(rep[own])
        ids, x = rep[own][order], vectors[own][order]
        asking, q = (ids, x) if own.all() else (rep[~own], vectors[~own])
        if not len(ids) or not len(asking):
            return pa.table({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        near = group.column("near").filter(pa.array(own)).take(pa.array(order)).combine_chunks()
        count = np.diff(near.offsets.to_numpy())
        flat = near.flatten().to_numpy()
        local = np.searchsorted(ids, flat)
        local[(local >= len(ids)) | (ids[np.minimum(local, len(ids) - 1)] != flat)] = -1
        edges = np.full((len(ids), max(1, int(count.max(initial=1)))), -1)
        rows = np.repeat(np.arange(len(ids)), count)
        edges[rows, np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)] = local
        i, k = range_search(x.astype(np.float32), edges, q.astype(np.float32), least, beam)
        passed = np.concatenate([np.einsum("ij,ij->i", q[i[s : s + 65536]], x[k[s : s + 65536]]) >= least for s in range(0, len(i), 65536)] or [np.zeros(0, bool)])
        one, two = asking[i[passed]], ids[k[passed]]
        pairs = np.unique(np.column_stack([np.minimum(one, two), np.maximum(one, two)])[one != two], axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    found = nodes.unionByName(queries).groupBy("cluster", "shard", "visitor").applyInArrow(search, "a long, b long")
    return cut(found.distinct())


def audited_recall(reps: DataFrame, pairs: DataFrame, least: float, queries: int) -> float:
    """Share of the links of a bounded sample of vectors, held against all rows, that were found."""
    sample = reps.orderBy(F.xxhash64("rep", F.lit(3)), "rep").limit(queries).collect()
    if not sample:
        return 1.0
    ids = np.array([r["rep"] for r in sample])
    shared = reps.sparkSession.sparkContext.broadcast((ids, unit(np.array([r["embedding"] for r in sample], dtype=np.float64))))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rep = batch.column("rep").to_numpy()
            i, k = np.nonzero(unit(stacked(batch.column("embedding"))) @ q.T >= least)
            keep = rep[i] != own[k]
            one, two = rep[i][keep], own[k][keep]
            yield pa.record_batch([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], names=["a", "b"])

    truth = reps.select("rep", "embedding").mapInArrow(of_batches, "a long, b long").distinct()
    counts = truth.join(pairs.withColumn("found", F.lit(1)), ["a", "b"], "left").agg(F.count("*").alias("n"), F.count("found").alias("found")).first()
    return counts["found"] / counts["n"] if counts["n"] else 1.0


def near_vectors(
    vectors: DataFrame, least: float = 0.95, shard_rows: int = 2048, overlap: int = 2, degree: int = 24, beam: int = 48,
    sample: int = 16_384, audit: int = 256, wanted: float = 0.98, rounds: int = 3,
) -> DataFrame:
    """A row for each vector: vec_id, n_links, component_id, kept, audited_recall.

    Equal vectors are one row of the graph. Centres are fitted to at most `sample` vectors; each
    vector joins the shards of its `overlap` nearest centres, each shard, of about `shard_rows`
    rows, builds a robust-pruned graph, the lists of a vector from all its shards are united, and
    every vector searches its shards by range-expanding greedy walks from their medoids. A
    cluster beyond the shard size is dealt to several shards, which its vectors search one by
    one. Links are verified in double precision. The links of `audit` vectors are held against
    all rows; below a recall of `wanted`, beam and overlap are widened, `rounds` times at most.

    Null, zero and unusual vectors (null or non-finite components, or another length than most)
    link with nothing and are components of their own. Rows with the same vec_id are one vector
    if equal; each such row is returned. A null vec_id links with nothing and is kept. Other
    columns are ignored. An empty table gives none."""
    good = cut(usable(vectors))
    reps = cut(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("copies")))
    total = reps.count()
    ids = good.join(reps.select(F.col("embedding"), "rep"), "embedding").select("vec_id", "rep").distinct()
    pairs, recall = None, 1.0
    if total > 1:
        rows = reps.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("embedding").collect()
        basis = unit(np.array([r[0] for r in rows], dtype=np.float64))
        for k in range(rounds):
            centres = centroids(basis, int(np.clip(-(-total * overlap * 3 // (2 * shard_rows)), 1, 1024)))
            pairs = found_pairs(reps, centres, least, shard_rows, overlap + k, degree, beam << k)
            recall = audited_recall(reps, pairs, least, audit)
            if recall >= wanted:
                break
    if pairs is None:
        pairs = vectors.sparkSession.createDataFrame([], "a long, b long")
    both = pairs.union(pairs.select(F.col("b"), F.col("a"))).toDF("rep", "other")
    copies = reps.select("rep", "copies")
    links = both.join(copies.select(F.col("rep").alias("other"), "copies"), "other").groupBy("rep").agg(F.sum("copies").alias("linked"))
    classes = components(pairs).withColumnRenamed("node", "rep")
    summary = copies.join(links, "rep", "left").join(classes, "rep", "left").select(
        "rep", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component")
    )
    known = ids.join(summary, "rep").select(F.col("vec_id").alias("_id"), "links", "component")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(known, F.col("vec_id") == F.col("_id"), "left")
    component = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"), F.lit(recall).alias("audited_recall"),
    )
