"""Quality classifier: document evidence with empirical Bayes priors of sites and their paths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import SPACED, texts, unused, word_hashes, words
from shelfmark.llm.logistic import fit
from shelfmark.llm.toxicity import labelled_sample
from shelfmark.session import cut

_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, dtype=np.int64)
_DIGIT[48:58] = 1
_SIGN = np.zeros(256, dtype=np.int64)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_STOP = np.zeros(256, dtype=np.int64)
_STOP[[33, 44, 46, 63]] = 1
_FEATURES = 9
#: Columns that `classify` adds.
ADDED = ("evidence", "site", "prior", "score", "good")


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of capitals, digits, signs other than sentence marks, sentence marks, words that
    repeat, the commonest word, a word equal to its predecessor; damped mean word length and
    number of words. A row for each text of the block."""
    starts, ends, first = words(data, offsets, SPACED)
    size = np.maximum(np.diff(offsets), 1)

    def share(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[data])])
        return np.diff(total[offsets]) / size

    hashes, n = word_hashes(data, starts, ends), np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, owner))
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[1:] == owner[:-1])
    many = np.maximum(n, 1)
    distinct = np.bincount(owner[~same], minlength=len(n))
    run = np.diff(np.append(np.flatnonzero(~same), len(same)))
    commonest = np.zeros(len(n))
    np.maximum.at(commonest, owner[~same], run)
    twice = np.zeros(len(hashes), dtype=bool)
    twice[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    length = np.bincount(owner, weights=(ends - starts).astype(float), minlength=len(n)) / many
    return np.column_stack([
        share(_UPPER), share(_DIGIT), share(_SIGN - _STOP * _SIGN), share(_STOP), 1 - distinct / many,
        commonest / many, np.bincount(owner[twice], minlength=len(n)) / many, np.log1p(length), np.log1p(n),
    ])


def expanded(x: np.ndarray) -> np.ndarray:
    """The features, their squares and roots: a share may count at its low or its high end."""
    return np.column_stack([x, x**2, np.sqrt(x)])


def with_features(docs: DataFrame, name: str = "_features") -> DataFrame:
    """All columns of `docs` (with a string column text) and an array of features."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    place, names = docs.columns.index("text"), schema.names

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.record_batch([batch.column(place)], names=["text"])
            parts = [text_features(data, offsets) for _, data, offsets in texts(text, lower=False)]
            values = np.concatenate(parts) if parts else np.zeros((0, _FEATURES))
            steps = np.arange(0, values.size + 1, _FEATURES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(steps, values.ravel())], names=names)

    return docs.mapInArrow(of_batches, schema)


def learned_evidence(rows: DataFrame, labels: DataFrame, sample: int) -> tuple[float, np.ndarray]:
    """Intercept and slopes of log odds of good quality, by at most `sample` labelled rows."""
    known = rows.join(F.broadcast(labelled_sample(labels, "quality", sample)), "doc_id").select("_features", "quality").collect()
    x = expanded(np.array([r[0] for r in known]).reshape(-1, _FEATURES))
    intercept, slopes = fit(x, np.array([r[1] for r in known]))
    return intercept, np.zeros(x.shape[1]) if slopes is None else slopes


def log_odds(features: str, intercept: float, slopes: np.ndarray) -> Column:
    """The learned score as a column expression."""
    total = F.lit(float(intercept))
    for k in range(_FEATURES):
        x = F.col(features)[k]
        total = total + x * float(slopes[k]) + x * x * float(slopes[_FEATURES + k]) + F.sqrt(x) * float(slopes[2 * _FEATURES + k])
    return F.least(F.greatest(total, F.lit(-30.0)), F.lit(30.0))


def _strength(sites: DataFrame, mean: str) -> float:
    """How many rows a prior is worth: the beta-binomial's method of moments over sites, from
    sums alone. Sites that differ no more than chance make the prior strong (10,000 at most)."""
    share, m, n = F.col("good") / F.col("n"), F.col(mean), F.col("n")
    s = sites.where("n > 1").agg(
        F.sum(n * (share - m) ** 2).alias("between"), F.sum(n).alias("n"), F.count("*").alias("sites"),
        F.sum(n * m * (1 - m)).alias("within"),
    ).first()
    if not s["n"] or not s["within"]:
        return 20.0
    spread = s["between"] / s["n"] - s["within"] / s["n"] * s["sites"] / s["n"]
    variance = s["within"] / s["n"]
    return float(np.clip(variance / spread - 1 if spread > 0 else 1e4, 2.0, 1e4))


def site_posteriors(rows: DataFrame, levels: tuple[str, ...]) -> tuple[float, list[DataFrame]]:
    """The global share of good rows, and for each level a table of its keys with `posterior`.

    `rows` has the level columns, n and good (weights of evidence). Each level shrinks towards
    the one above it: the first towards the global share, a path towards its site. Sums are
    grouped from the finest level up, so no site, however large, meets in one task."""
    finest = cut(rows.groupBy(*levels).agg(F.sum("n").alias("n"), F.sum("good").alias("good")))
    total = finest.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = float(np.clip((total["good"] + 1) / (total["n"] + 2), 0.01, 0.99)) if total["n"] else 0.5
    out: list[DataFrame] = []
    for k in range(1, len(levels) + 1):
        keys = levels[:k]
        sites = finest.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        if out:
            above = out[-1].select(*[F.col(c).alias(f"_{c}") for c in keys[:-1]], F.col("posterior").alias("prior"))
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys[:-1]]
            sites = sites.join(above, same).select(*keys, "n", "good", "prior")
        else:
            sites = sites.withColumn("prior", F.lit(overall))
        sites = cut(sites)
        worth = _strength(sites, "prior")
        out.append(cut(sites.withColumn("posterior", (F.col("good") + worth * F.col("prior")) / (F.col("n") + worth))))
    return overall, out


def classify(
    docs: DataFrame, labels: DataFrame, levels: tuple[str, ...] = ("source", "lang"), sample: int = 40_000,
    unlabelled: float = 0.1,
) -> DataFrame:
    """All columns and rows of `docs` with evidence, site, prior, score, good.

    `evidence` is the classifier's log odds from the text alone, learned from at most `sample`
    labelled rows outside fold 0, less the log odds of the base rate. Levels are the columns of
    site and path, coarse to fine. All labelled rows outside fold 0 count in full, all other
    rows by the classifier's probability with weight `unlabelled`. score = logistic(evidence +
    log odds of the finest posterior), good = score >= 0.5. Null or empty texts are scored by
    their features (all zero), null levels form a site of their own, sites unseen cannot occur.
    Without labels the evidence is zero and all rows are good. Repeated rows get equal scores;
    repeated labels of a document count as the largest. An empty table gives none. Columns of
    `docs` named like a result are replaced."""
    docs = docs.drop(*ADDED).withColumn("text", F.col("text").cast("string"))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *levels)
    rows = cut(with_features(plain).drop("text"))
    intercept, slopes = learned_evidence(rows, labels, sample)
    quality = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    odds = log_odds("_features", intercept, slopes)
    guess = 1 / (1 + F.exp(-odds))
    weighed = rows.join(quality.where(fold != 0), "doc_id", "left").select(
        *levels, F.when(F.col("quality").isNull(), unlabelled).otherwise(1.0).alias("n"),
        F.when(F.col("quality").isNull(), unlabelled * guess).otherwise(F.col("quality").cast("double")).alias("good"),
    )
    overall, sites = site_posteriors(weighed, levels)
    base = float(np.log(overall / (1 - overall)))
    name, own = unused("features", docs.columns), {c: unused(f"_{c}", docs.columns) for c in (*levels, "posterior")}
    finest = sites[-1].select(*[F.col(c).alias(own[c]) for c in levels], F.col("prior").alias("site"), F.col("posterior").alias(own["posterior"]))
    evidence = log_odds(name, intercept, slopes) - base if slopes.any() else F.lit(0.0)
    scored = with_features(docs, name).withColumn("evidence", evidence)
    joined = scored.join(finest, [F.col(c).eqNullSafe(F.col(own[c])) for c in levels], "left")
    prior = F.least(F.greatest(F.coalesce(F.col(own["posterior"]), F.lit(overall)), F.lit(1e-4)), F.lit(1 - 1e-4))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(prior / (1 - prior)))))
    return joined.select(
        *docs.columns, "evidence", F.coalesce("site", F.lit(overall)).alias("site"), prior.alias("prior"),
        score.alias("score"), (score >= 0.5).alias("good"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents classified as good, with their columns as they are. Rows are never
    compared by doc_id, so repeated and null ids are judged by their texts."""
    aside = {c: unused(f"_{c}", docs.columns) for c in docs.columns if c.lower() in ADDED}
    judged = classify(docs.withColumnsRenamed(aside), labels, **options).where("good")
    return judged.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
