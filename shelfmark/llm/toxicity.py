"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.logistic import fit
from shelfmark.session import cut

# Characters that look like a Latin letter, each with that letter.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ғ": "f", "һ": "h", "н": "h", "і": "i", "ї": "i",
    "ј": "j", "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t",
    "ц": "u", "ѵ": "v", "ѡ": "w", "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ɑ": "a", "ɡ": "g", "ı": "i",
}
# Digits and signs written for letters.
WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i", "!": "i"}
# Phrases in which a word that may give offence stands without any.
EXCEPTIONS = ("idiot proof", "idiot board", "pond scum", "scum line", "stupid mistake of mine")

_FOLD = str.maketrans(LOOKALIKES | {chr(0xFF41 + k): chr(97 + k) for k in range(26)})
_SIGNS = str.maketrans(WRITTEN_FOR)
_SPELT = re.compile(r"(?:[^\W_]|[@$|!])+")
_HARD = re.compile(r"[0-9@$|!]")
_LETTER = re.compile(r"[^\W\d_]")
_REST = re.compile(r"[\W_]+")


def _respell(match: re.Match) -> str:
    word = match[0]
    if not _HARD.search(word):
        return word
    word = word.rstrip("!|")
    return word.translate(_SIGNS) if _LETTER.search(word) else word


def folded(text: str) -> str:
    """Lower case, look-alikes as Latin letters, digits and signs inside words as the letters
    they are written for, and one blank between words and at both ends."""
    text = text.lower().translate(_FOLD) if not text.isascii() else text.lower()
    if _HARD.search(text):
        text = _SPELT.sub(_respell, text)
    return f" {_REST.sub(' ', text)} "


#: Lengths of word beginnings that may enter the lexicon, beside whole words.
STEMS = (4, 5, 6, 7)
#: Terms a task counts before it hands its sums on.
_COUNTED = 300_000


def terms(text: str) -> set[str]:
    """Whole words (blank on both sides) and word beginnings (blank before) of folded text."""
    found: set[str] = set()
    for word in set(text.split()):
        if len(word) > 1:
            found.add(f" {word} ")
            found.update(f" {word[:k]}" for k in STEMS if len(word) >= k)
    return found


def term_counts(docs: DataFrame) -> DataFrame:
    """term, toxic, clean: in how many labelled texts of each kind a term stands. `docs` has text
    and toxic. Each task sums before anything is shuffled."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def sums() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array([c[n] for n in names], pa.int64()) for c in counts]
            for c in counts:
                c.clear()
            return pa.record_batch([pa.array(names, pa.string()), columns[1], columns[0]], names=["term", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[bool(toxic)].update(terms(folded(text or "")))
                if len(counts[0]) + len(counts[1]) > _COUNTED:
                    yield sums()
        yield sums()

    counted = docs.select("text", "toxic").mapInArrow(of_batches, "term string, toxic long, clean long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(docs: DataFrame, support: float, sure: float) -> dict[str, float]:
    """Weight of each term: its log odds ratio, smoothed, where that is `sure` or more and at
    least a share `support` of the toxic texts has it. A whole word that begins like an entry but
    is as frequent in clean texts enters with weight zero: the longer match hides the shorter, so
    it is an exception. The labelled texts, a bounded sample, bound the entries: a toxic text of
    T terms accounts for T / support of them at most."""
    totals = docs.groupBy().agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    if not totals["t"] or totals["t"] == totals["n"]:
        return {}
    toxic, clean = totals["t"], totals["n"] - totals["t"]
    least = max(3.0, support * toxic)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    counted = cut(term_counts(docs).withColumn("weight", odds))
    entries = counted.where((F.col("toxic") >= least) & (F.col("weight") >= sure))
    entries = {r["term"]: r["weight"] for r in entries.collect()}
    stems = [t for t in entries if not t.endswith(" ")]
    if stems:
        begins = reduce(Column.__or__, [F.substring("term", 1, k + 1).isin([t for t in stems if len(t) == k + 1] or [""]) for k in STEMS])
        harmless = counted.where(F.col("term").endswith(" ") & begins & (F.col("weight") < sure / 2) & (F.col("clean") >= 3))
        entries |= {r["term"]: 0.0 for r in harmless.collect()}
    return entries


def automaton(lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    entries = lexicon | {f" {folded(e).strip()} ": 0.0 for e in exceptions}
    for term, weight in entries.items():
        found.add_word(term, (len(term), weight, term))
    found.make_automaton()
    return found


def evidence(known: ahocorasick.Automaton, text: str) -> tuple[float, float, float, float]:
    """What the lexicon says of a text: number of words, summed weight of all places, largest
    weight, distinct terms. Where matches overlap from the same start or
    one lies inside another, the longer counts; exception phrases are such matches of weight 0."""
    line = folded(text)
    hits, covered = [], -1
    for end, (length, weight, term) in known.iter(line):
        hits.append((end - length + 1, -end, weight, term))
    if not hits:
        return float(line.count(" ") - 1), 0.0, 0.0, 0.0
    times: Counter = Counter()
    weights: dict[str, float] = {}
    for _, end, weight, term in sorted(hits):
        inside = -end - term.endswith(" ") <= covered
        covered = max(covered, -end - term.endswith(" "))
        if not inside and weight > 0:
            times[term] += 1
            weights[term] = weight
    total = sum(n * weights[t] for t, n in times.items())
    return float(line.count(" ") - 1), total, max(weights.values(), default=0.0), float(len(times))


def lexicon_evidence(docs: DataFrame, lexicon: dict[str, float], *kept: str) -> DataFrame:
    """doc_id, the integer columns `kept`, n_words, total, top, distinct for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = automaton(shared.value)
        for batch in batches:
            rows = [evidence(known, t or "") for t in batch.column("text").to_pylist()]
            values = np.array(rows, dtype=float).reshape(-1, 4).T
            yield pa.record_batch([batch.column(n) for n in ids] + [pa.array(v) for v in values], names=ids + found)

    ids, found = ["doc_id", *kept], ["n_words", "total", "top", "distinct"]
    rows = docs.select(*[F.col(n).cast("long").alias(n) for n in ids], F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of_batches, ", ".join([f"{n} long" for n in ids] + [f"{n} double" for n in found]))


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; 0 marks rows whose label is never learned from."""
    return F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 5


def labelled_sample(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """doc_id and label of at most `bound` labelled rows outside fold 0, in an order of hashes;
    several labels of a document count as the largest."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold_of() != 0))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias(label))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


FEATURES = ("presence", "strength", "density", "variety")


def features(rows: DataFrame) -> DataFrame:
    """The weight of the heaviest term, the summed weight damped, the same by length, and how
    many terms there are."""
    return rows.withColumns({
        "presence": F.col("top"), "strength": F.log1p("total"),
        "density": F.log1p(F.col("total") * 100 / F.greatest(F.col("n_words"), F.lit(20.0))),
        "variety": F.log1p("distinct"),
    })


def toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = 40_000, support: float = 0.004, sure: float = 2.5
) -> DataFrame:
    """A row for each document: doc_id, held_out, score, predicted, n_words, n_terms.

    Lexicon and score are learned from at most `sample` labelled rows outside fold 0, no word is
    known before: the lexicon from all of them, the logistic score from each half's evidence by the
    lexicon of the other, so that words which only copies share gain no weight. Everything else
    covers all rows. Null and
    empty texts have no evidence and get the score of that; without labels of both kinds
    there is no evidence, and all scores are low. Repeated rows get equal scores. A null doc_id is never held out. Only
    doc_id, text and the label are read. An empty table gives none."""
    chosen = cut(labelled_sample(labels, "toxic", sample))
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learn = cut(texts.join(F.broadcast(chosen), "doc_id").withColumn("half", half))
    known: list = []
    for part in (True, False):
        other = learn_lexicon(learn.where(F.col("half") != part), support, sure)
        own = learn.where(F.col("half") == part)
        known += features(lexicon_evidence(own, other, "toxic")).select(*FEATURES, "toxic").collect()
    intercept, slopes = fit(np.array([r[:-1] for r in known]).reshape(-1, len(FEATURES)), np.array([r[-1] for r in known]))
    rows = cut(features(lexicon_evidence(docs, learn_lexicon(learn, support, sure))))
    if slopes is None:
        intercept, slopes = -4.0, np.array([2.0, 0.0, 0.0, 0.0])
    logit = reduce(Column.__add__, [F.col(n) * float(s) for n, s in zip(FEATURES, slopes, strict=True)], F.lit(float(intercept)))
    score = 1 / (1 + F.exp(-logit))
    return rows.select(
        "doc_id", F.coalesce(fold_of() == 0, F.lit(False)).alias("held_out"), score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"), F.col("n_words").cast("long").alias("n_words"),
        F.col("distinct").cast("long").alias("n_terms"),
    )
