"""The operators as Spark jobs: brute force on small tables, and every odd input."""

import itertools
import os
import re
import time
import zlib
from collections import Counter
from contextlib import contextmanager
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import decontaminate, licenses, lines, packing, paragraphs, quality, simhash, toxicity, urls, vectors
from tests.llm.test_functions import low, plain_distance, plain_simhash

TOKENS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASHES = ["fp", "component_id", "key", "node", "class", "evidence", "good", "score", "prior", "_doc", "_gone", "_p",
           "_source", "matches", "n_words", "start", "half", "keys", "line_no", "slot", "size", "part", "_features", "a", "b"]
RNG = np.random.default_rng(11)
VOCABULARY = ["".join(RNG.choice(list("abcdefghij"), 5)) for _ in range(300)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCABULARY, n))


LONG = "\n".join(prose(40, 1000 + k) for k in range(1500))
ROWS = [
    (1, prose(60, 1) + "\n" + prose(30, 2), "en", "s", 10),
    (2, prose(60, 1) + "\n" + prose(30, 3), "en", "s", 10),
    (3, prose(60, 1) + "\n" + prose(30, 2), None, "s", None),
    (4, "", "en", None, 0), (5, None, None, None, None), (6, " \n\t", "en", "s", 3), (7, "One", "en", "t", 3),
    (None, prose(50, 4), "en", "s", 9), (None, None, None, None, None),
    (8, prose(50, 4), "en", "s", 9), (8, prose(50, 4), "en", "s", 9),
    (9, "You idiot, under the MIT License\nGNU general public license", "en", "s", 9),
    (10, LONG, "en", "s", len(LONG)), (11, prose(20, 5) + " " + prose(70, 6) + " " + prose(9, 7), "en", "t", 5),
    (12, prose(33, 8) + " " + prose(70, 6), "en", "t", 5), (13, "x" * 200_000, "de", "t", 1), (14, "日本語 " * 50, "ja", "t", 1),
    (15, "hello <|endoftext|> world", "en", "t", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    out = spark.createDataFrame(ROWS, DOCS).repartition(3)
    return out.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, int(k % 4 != 0), int(k == 9)) for k in range(1, 14)] + [(None, 1, 1), (3, None, None), (99, 0, 1), (3, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, prose(90, 6)), (2, "mit license"), (3, None), (4, ""), (None, "One"), (2, "mit license")]
    return spark.createDataFrame(rows, "item_id long, text string")


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def classes(nodes, near):
    """Smallest reachable node of each."""
    out = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in near:
            m = min(out[a], out[b])
            changed |= out[a] != m or out[b] != m
            out[a] = out[b] = m
    return out


def test_simhash(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    prints = {(r[0], plain_simhash(r[1] or "")) for r in ROWS}
    fps = {f for _, f in prints}
    near = [(a, b) for a, b in itertools.combinations(fps, 2) if bin(a ^ b).count("1") <= 3]
    of = classes(fps, near)
    first = {}
    for i, f in prints:
        if i is not None:
            first[of[f]] = min(i, first.get(of[f], i))
    wanted = sorted(((r[0] or -1), f"{plain_simhash(r[1] or ''):016x}", first[of[plain_simhash(r[1] or "")]]) for r in ROWS)
    assert sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in got) == wanted
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(first.values())
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_near_duplicates_go_by_row(spark):
    """Null and repeated ids: each row by its own text."""
    like, other, third = prose(80, 60), prose(80, 61), prose(80, 62)
    rows = [(3, like, "keep"), (None, like + " ", "go"), (None, other, "keep"), (5, like, "go"), (5, third, "keep"), (9, third, "go"),
            (None, prose(80, 63), "keep"), (None, prose(80, 63), "keep"), (7, None, "keep"), (8, "", "go"), (None, None, "go")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string").repartition(4).withColumn("digest", F.lit("mine"))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (tuple(r)[:3] for r in kept.collect()))) == sorted(repr(r) for r in rows if r[2] == "keep")


def test_near_duplicates_without_ids(spark):
    """Of texts that are near each other one stays, though no row has an id."""
    base = prose(200, 64)
    versions = [base, base.upper(), base + "\n", base.replace(" ", "  ")]
    docs = spark.createDataFrame([(None, t) for t in versions], "doc_id long, text string")
    prints = [plain_simhash(t) for t in versions]
    assert all(bin(a ^ b).count("1") <= 3 for a, b in itertools.combinations(prints, 2))
    assert simhash.drop_near_duplicates(docs).count() == 1


def test_contaminated_documents_with_clashing_columns(spark, benchmark):
    rows = [(1, prose(40, 70), 777, "mine", True), (2, prose(90, 6), 5, "mine", False), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, matches string, Contaminated boolean")
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.schema == docs.schema
    assert sorted(map(repr, (tuple(r) for r in kept.collect()))) == sorted(map(repr, [rows[0], rows[2]]))


def test_simhash_links_up_to_three_bits(spark):
    base = int(np.random.default_rng(1).integers(-(2**62), 2**62))
    masks = [0, 1, 1 | 1 << 33, 1 | 1 << 33 | 1 << 63, 0xF, 0xF << 40]
    values = [((base ^ m) + (1 << 63)) % (1 << 64) - (1 << 63) for m in masks]
    for distance in (1, 2, 3, 5):
        got = {r["node"]: r["component"] for r in simhash.near_classes(spark.createDataFrame([(v,) for v in values], "fp long"), distance).collect()}
        near = [(a, b) for a, b in itertools.combinations(values, 2) if bin((a ^ b) % (1 << 64)).count("1") <= distance]
        of = classes(values, near)
        assert {v: got.get(v, v) for v in values} == of


@contextmanager
def small_broadcasts(spark):
    """A table of 4 MB or more that Spark chooses to broadcast ends the job."""
    limit, before = "spark.sql.maxBroadcastTableSize", spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set(limit, "4m")
    try:
        yield
    finally:
        spark.conf.set(limit, before)


def test_keys_of_fingerprints_are_not_broadcast(spark):
    """5,000 fingerprints are a small table, their 64 keys each are not."""
    values = np.random.default_rng(71).integers(-(2**63), 2**63 - 1, 5000).tolist()
    near = {v ^ (1 << (k + 8)) ^ 4: v for k, v in enumerate(values[:50])}
    prints = spark.createDataFrame([(v,) for v in [*values, *near]], "fp long")
    with small_broadcasts(spark):
        got = {r["node"]: r["component"] for r in simhash.near_classes(prints).collect()}
    assert got == {x: min(pair) for pair in near.items() for x in pair}


def test_the_near_dedup_stage_broadcasts_no_keys(spark):
    import corpus_pipeline

    words = np.random.default_rng(72).integers(0, 10**9, (5000, 6)).astype(str).tolist()
    rows = [(k, "w" + " w".join(w), "en", "s", 60) for k, w in enumerate(words)]
    copies = [(5000 + k, t.upper(), "en", "t", 60) for k, t, *_ in rows[:50]]
    table = spark.createDataFrame([*rows, *copies], DOCS).repartition(4)
    with small_broadcasts(spark):
        kept = dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, table, "")
    # outside: for keys that may be null Spark takes memory by whole pages, however few rows go
    assert sorted(tuple(r) for r in kept.collect()) == rows


def test_packing(docs, empty):
    got = packing.pack(docs, TOKENS).collect()
    plain = Tokenizer.from_file(TOKENS)
    ids = {}
    for i, t, *_ in ROWS:
        ids.setdefault(i, []).append(np.array(plain.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4").tobytes())
    wanted = sorted((i or -1, len(x) // 4) for i, xs in ids.items() for x in xs)
    pieces = {}
    for r in got:
        whole = [x for x in ids[r["doc_id"]] if len(x) == 4 * r["doc_tokens"]][0]
        assert zlib.crc32(whole[4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"]
        pieces.setdefault((r["doc_id"] or -1, r["doc_tokens"]), []).append((r["start"], r["length"]))
    for (i, n), parts in pieces.items():
        copies = wanted.count((i, n))
        assert sum(length for _, length in parts) == copies * n
        assert len(set(parts)) * copies == len(parts)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(n for _, n in wanted) >= 0.97 * 2048 * (len(sequences) - 1)
    assert packing.pack(empty, TOKENS).count() == 0


def test_decontamination(docs, empty, benchmark):
    got = {(r["doc_id"], r["n_words"]): r for r in decontaminate.contamination(docs, benchmark).collect()}
    items = [("1", prose(90, 6)), ("2", "mit license")]
    for i, t, *_ in ROWS:
        line = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t or ""))
        if len(line) > 2000:
            continue
        hit, found = set(), set()
        for item, words in items + [("None", "one")]:
            words = words.split()
            size = min(10, len(words))
            runs = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
            for k in range(len(line) - size + 1):
                if tuple(line[k : k + size]) in runs:
                    hit |= set(range(k, k + size))
                    found.add(item)
        r = got[i, len(line)]
        assert (r["n_hit"], r["n_items"], r["contaminated"]) == (len(hit), len(found), bool(hit))
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {11, 12, 9, 7}.isdisjoint({r["doc_id"] for r in kept.collect()}) and kept.count() == len(ROWS) - 4
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert decontaminate.drop_contaminated(docs, benchmark.limit(0)).count() == len(ROWS)


def test_decontamination_in_blocks_of_tests(docs, benchmark, monkeypatch):
    one = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["items_sha256"]) for r in decontaminate.contamination(docs, benchmark).collect()}
    monkeypatch.setattr(decontaminate, "TEST_BYTES", 200)
    assert {(r["doc_id"], r["n_words"]): (r["n_hit"], r["items_sha256"]) for r in decontaminate.contamination(docs, benchmark).collect()} == one


def test_lines(spark, docs, empty):
    base = prose(12, 40)
    texts = [base, base + "x", "y" + base[:-1] + "xz", base[:10] + "--" + base[12:], base + "\n" + base + "\nshort\nshort", prose(12, 41)]
    rows = [(k, t) for k, t in enumerate(texts, 1)] + [(None, base), (20, None), (21, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    places = {(i, n): x.strip() for i, t in rows if i and t for n, x in enumerate(t.split("\n")) if len(x.strip()) >= 20}
    near = [(p, q) for p, q in itertools.combinations(places, 2) if plain_distance(places[p], places[q]) <= 2]
    of = classes(places, near)
    several = {p: of[p] for p in places if list(of.values()).count(of[p]) > 1}
    got = {(r["doc_id"], r["line_no"]): ((r["first_doc_id"], r["first_line_no"]), r["removed"]) for r in lines.repeated_lines(table).collect()}
    assert got == {p: (f, p != f) for p, f in several.items()}
    out = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(table).collect()}
    assert out[1] == base and out[2] == "" and out[5] == "short\nshort" and out[20] is None and out[None] == base
    kept = lines.drop_repeated_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert lines.repeated_lines(empty).count() == 0 and lines.drop_repeated_lines(empty).count() == 0


def test_equal_lines_of_any_length_repeat(spark):
    rows = [(1, "a\nlast one.\n\n日本語の文です。\nalone"), (2, " last one.\nlast one!\na"), (3, "日本語の文です。\n\n" + "long enough for the edit join")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["line_no"]): ((r["first_doc_id"], r["first_line_no"]), r["removed"]) for r in lines.repeated_lines(table, shortest=1).collect()}
    assert got == {(1, 0): ((1, 0), False), (1, 1): ((1, 1), False), (1, 3): ((1, 3), False),
                   (2, 0): ((1, 1), True), (2, 2): ((1, 0), True), (3, 0): ((1, 3), True)}
    out = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(table, shortest=1).collect()}
    assert out == {1: rows[0][1], 2: "last one!", 3: "\nlong enough for the edit join"}


def test_linking_is_complete_where_the_first_of_a_bucket_is_far(spark):
    from shelfmark.llm.common import linked

    values = [0, 100, 101, 102, 200, 201]
    buckets = spark.createDataFrame([("k", v) for v in values] + [("m", 300)], "key string, node long")
    got = {r["node"]: r["component"] for r in linked(buckets, lambda p: p.where(F.abs(p.a - p.b) <= 1)).collect()}
    assert got == {100: 100, 101: 100, 102: 100, 200: 200, 201: 200}


def test_keys_that_nodes_share_are_found_in_blocks(spark, monkeypatch):
    from shelfmark.llm import common

    rng = np.random.default_rng(4)
    rows = [(int(n) - 200, [int(k) << 50 for k in rng.integers(-4000, 4000, 3)] + [7] * (n % 2)) for n in rng.permutation(600)] + [(5, []), (6, None)]
    rows += rows[:40]
    nodes: dict = {}
    for n, keys in rows:
        for k in keys or []:
            nodes.setdefault(k, set()).add(n)
    wanted = sorted(sorted(v) for v in nodes.values() if len(v) > 1)

    def groups(pairs):
        found: dict = {}
        for k, n in pairs:
            found.setdefault(k, []).append(n)
        return sorted(sorted(v) for v in found.values())

    table = spark.createDataFrame(rows, "node long, keys array<bigint>").repartition(5)
    assert groups((r["key"], r["node"]) for r in common.shared_keys(table).collect()) == wanted
    # the same in small blocks; the common key sends two nodes of each to its part
    monkeypatch.setattr(common, "KEYS_AT_ONCE", 100)
    batches = [pa.record_batch([pa.array([n for n, _ in rows[k : k + 50]]), pa.array([x for _, x in rows[k : k + 50]], pa.list_(pa.int64()))], names=["node", "keys"])
               for k in range(0, len(rows), 50)]
    dealt = pa.Table.from_batches(list(common._dealt(iter(batches)))).sort_by("part")
    pairs = {(k, n) for b in common._met(iter(dealt.to_batches(max_chunksize=7))) for k, n in zip(*(c.to_pylist() for c in b.columns))}
    assert groups(pairs) == wanted
    sent = [k for p, ks in zip(dealt["part"].to_pylist(), dealt["keys"].to_pylist()) if p < 4096 for k in ks]
    assert max(sent.count(k) for k in set(sent)) <= 2 * len(batches)


def test_grams_are_counted_and_ranked_in_blocks(spark):
    from shelfmark.llm import common

    rng = np.random.default_rng(5)
    sets = {n: {int(k) for k in rng.zipf(1.3, 30) % 500} for n in range(-100, 100)}
    often = Counter(k for v in sets.values() for k in v)
    rows = spark.createDataFrame([(n, sorted(v)) for n, v in sets.items()], "node long, grams array<bigint>").repartition(5)
    of = {int(common.mixed(np.array([k], dtype=np.uint64)).view(np.int64)[0]): k for k in often}
    got = {r["node"]: r for r in common.counted_keys(rows).collect()}
    assert set(got) == set(sets)
    for n, v in sets.items():
        counts = [often[of[k]] for k in got[n]["grams"]]
        assert {of[k] for k in got[n]["grams"]} == v and counts == sorted(counts) and got[n]["n"] == len(v)
        assert got[n]["common"] == sum(c > 1 for c in counts) and abs(got[n]["weight"] - sum(counts) / len(v)) < 1e-9


def test_what_a_step_has_shuffled_or_kept_does_not_stay(spark):
    from shelfmark import session

    many = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    before = spark.conf.get(session.SHUFFLES_FREED, None)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return sum(x.startswith("shuffle_") for d in blocks.localDirsString() for _, _, names in os.walk(d) for x in names)

    had = files()
    once = session.cut(many)
    with session.scratch(spark) as keep:
        kept = keep(many)
        folder = os.path.dirname(urlparse(kept.inputFiles()[0]).path)
        for _ in range(50):  # they are deleted behind the action
            if files() <= had:
                break
            time.sleep(0.1)
        assert files() <= had
        assert kept.count() == once.count() == 10 and os.path.isdir(folder)
    assert not os.path.exists(folder) and spark.conf.get(session.SHUFFLES_FREED, None) == before
    assert once.agg(F.sum("count")).first()[0] == 1000


def test_paragraphs(docs, empty, spark):
    got = paragraphs.repeats(docs).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, 11, 12}
    passages = {r["doc_id"]: r for r in got if r["kind"] == "passage" and r["doc_id"] in (11, 12)}
    assert not passages[11]["removed"] and passages[12]["removed"]
    assert 20 <= passages[11]["start"] and passages[11]["end"] <= 90 and passages[11]["end"] - passages[11]["start"] >= 25
    assert passages[12]["start"] - passages[11]["start"] == 13
    # against all pairs of paragraphs
    words = prose(80, 60).split()
    texts = []
    for k in range(60):
        changed = list(words)
        for place in np.random.default_rng(k).choice(80, k % 5, replace=False):
            changed[place] = f"new{place if k % 2 else k}"
        texts.append(" ".join(changed[k % 3 :]))
    texts = list(dict.fromkeys(texts))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if paragraphs.similar(texts[a], texts[b], 0.8)]
    of = classes(range(len(texts)), near)
    found = {r["doc_id"]: r["first_doc_id"] for r in paragraphs.repeats(table).collect() if r["kind"] == "paragraph"}
    assert found == {k: f for k, f in of.items() if list(of.values()).count(f) > 1}
    kept = paragraphs.drop_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert paragraphs.repeats(empty).count() == 0


def test_passages_are_found_to_their_ends(spark):
    rows, wanted, kept = [], {}, {}
    for k in range(40):
        passage, lead = prose(50 + 2 * k, 500 + k), 7 + k
        rows += [(3 * k, prose(lead, 600 + k) + " " + passage + " " + prose(30, 700 + k)), (3 * k + 1, prose(33, 800 + k) + " " + passage)]
        wanted[3 * k + 1], kept[3 * k] = set(range(33, 83 + 2 * k)), set(range(lead, lead + 50 + 2 * k))
        if k % 2:
            # an earlier place that holds the middle alone does not hide the ends
            rows.append((-1 - k, " ".join(passage.split()[10:45])))
            wanted[3 * k] = None
    got = [r for r in paragraphs.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["kind"] == "passage"]

    def covered(doc_id, *removed):
        return {n for r in got if r["doc_id"] == doc_id and r["removed"] in removed for n in range(r["start"], r["end"])}

    for doc_id, places in wanted.items():
        assert places is None or covered(doc_id, True) == places
    for doc_id, places in kept.items():
        assert covered(doc_id, True, False) == places
        assert covered(doc_id, True) < places and (doc_id % 2 or not covered(doc_id, True))


def test_licenses(docs, empty):
    got = {(r["doc_id"], r["n_words"]): r for r in licenses.scan(docs).collect()}
    r = got[9, 10]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (2, 4, 7, "gpl,mit")
    assert {"gpl", "mit"} <= set(r["labels"].split(",")) and 0 < r["score"] <= 1
    assert got[5, 0]["labels"] == "" and got[5, 0]["first_word"] is None and got[5, 0]["score"] == 0
    for i, t, *_ in ROWS:
        assert (i, len(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t or "")))) in got
    assert licenses.scan(empty).count() == 0


def test_urls(spark):
    rows = [(1, "http://A.net/x?y#z"), (2, None), (3, "no url"), (4, "x://h"), (5, "s://big.com/a"), (6, "s://big.com"), (6, "s://big.com"),
            (None, "http://q.example.net/en/?"), (8, ""), (9, "a://b.net?x")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1)).withColumn("host", F.lit("c"))
    listed = spark.createDataFrame([("big.com",), (None,), ("",)], "host string")
    got = sorted([tuple(r) for r in urls.judge(pages, [urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/")], listed.where("host <> ''")).collect()], key=str)
    assert got == sorted([
        (1, "a.net", "/x", "net/", "block", False), (2, "", "", None, "allow", False), (3, "", "", None, "allow", False),
        (4, "h", "", None, "allow", False), (5, "big.com", "/a", None, "block", True), (6, "big.com", "", None, "block", True),
        (6, "big.com", "", None, "block", True), (None, "q.example.net", "/en/", "example.net/en/", "allow", False),
        (8, "", "", None, "allow", False), (9, "b.net", "", None, "allow", False),
    ], key=str)
    assert urls.judge(pages.limit(0), [], listed.limit(0)).count() == 0


def test_list_of_what_urls_say(spark):
    rows = ["http://m.Casino-Win.example.com/a", "http://m.casino-win.example.com/b", "http://casinos.net/", "http://alphabet.org/x", "http://a.com/best",
            "http://a.com/Free_Bets.html?x", "http://b.com/x?poker", None, "spam", "http://spamalot.com/pills/1#x"]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(rows)], "page_id long, url string").repartition(3)
    entries = {r["entry"] for r in urls.unwanted(pages).collect()}
    assert entries == {"m.casino-win.example.com", "casinos.net", "http://a.com/Free_Bets.html?x", "http://spamalot.com/pills/1#x"}
    judged = {r["page_id"]: (r["verdict"], r["listed"]) for r in urls.judge(pages, [urls.Rule("allow", "net/")], urls.unwanted(pages)).collect()}
    assert [k for k, (v, _) in sorted(judged.items()) if v == "block"] == [0, 1, 5, 9] and judged[2] == ("allow", True)
    assert urls.unwanted(pages.limit(0)).count() == 0


def test_urls_of_a_list_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(urls, "BLOCK_ENTRIES", 7)
    rows = spark.range(50).select(F.concat(F.lit("h"), "id").alias("host"), "id")
    got = urls.with_listed(rows, ("host",), rows.where("id % 3 = 0").select("host")).collect()
    assert all(r["listed"] == (r["id"] % 3 == 0) for r in got) and len(got) == 50


def test_quality(spark, docs, empty, labels):
    got = quality.classify(docs, labels)
    assert set(docs.columns) <= set(got.columns) and len(set(got.columns)) == len(got.columns) and got.count() == len(ROWS)
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in got.select(F.col("score")).collect())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert quality.keep_good(docs, no_labels(spark)).count() == len(ROWS)
    assert quality.classify(empty, labels).count() == 0
    same = {(r["doc_id"], r["score"]) for r in got.where("doc_id = 8").collect()}
    assert len(same) == 1


def test_site_posteriors_shrink(spark):
    rows = [("big", "p", 1000.0, 900.0), ("big", "q", 1.0, 0.0), ("bad", "p", 500.0, 50.0), ("one", "p", 1.0, 0.0), (None, None, 10.0, 9.0)]
    table = spark.createDataFrame(rows, "source string, lang string, n double, good double")
    overall, (sites, paths) = quality.site_posteriors(table, ("source", "lang"))
    site = {r["source"]: r["posterior"] for r in sites.collect()}
    path = {(r["source"], r["lang"]): r["posterior"] for r in paths.collect()}
    assert abs(overall - 959 / 1512) < 0.01
    assert site["bad"] < site["one"] < overall < site["big"]
    assert 0 < path["big", "q"] < path["big", "p"] and (None, None) in path


def test_toxicity(spark, docs, empty, labels):
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(ROWS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[9]["score"] == max(r["score"] for r in got)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
    assert toxicity.toxicity(empty, labels).count() == 0
    alone = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, no_labels(spark)).collect()}
    assert set(alone.values()) == {0}


def test_toxicity_held_out(spark):
    rng = np.random.default_rng(9)
    rows, marks = [], []
    for k in range(1500):
        toxic = k % 6 == 0
        line = list(rng.choice(VOCABULARY, 40))
        if toxic:
            line[rng.integers(40)] = "zorg" + str(rng.choice(VOCABULARY))
            line[rng.integers(40)] = "blargh"
        rows.append((k, " ".join(line)))
        marks.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = [r for r in toxicity.toxicity(docs, labels).collect() if r["held_out"]]
    assert len(got) > 200 and np.mean([r["predicted"] == (r["doc_id"] % 6 == 0) for r in got]) > 0.97


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    x = np.concatenate([base, base[:20] + rng.normal(size=(20, 8)) * 0.05, base[:3], base[5:6] * 1e200, base[6:7] * 1e-200])
    rows = [(k, v.tolist(), k % 2) for k, v in enumerate(x)]
    odd = [(200, None, 1), (201, [0.0] * 8, 1), (202, [float("nan")] + [1.0] * 7, 1), (203, [None] + [1.0] * 7, 1), (204, [1.0], 1),
           (205, [], None), (206, [float("inf")] * 8, 1), (None, base[0].tolist(), None), (7, base[7].tolist(), 1)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1))
    for shard_rows in (2048, 16):
        got = vectors.near_vectors(table, shard_rows=shard_rows)
        u = vectors.unit(x)
        near = [(a, b) for a, b in itertools.combinations(range(len(x)), 2) if u[a] @ u[b] >= 0.95]
        of = classes(range(len(x)), near)
        result = got.collect()
        assert len(result) == len(rows) + len(odd)
        found = {r["vec_id"]: r for r in result}
        if shard_rows == 2048:
            for k in range(len(x)):
                assert found[k]["n_links"] == sum(k in p for p in near)
                assert found[k]["component_id"] == of[k] and found[k]["kept"] == (of[k] == k)
        else:
            total = 2 * len(near)
            assert 0.9 * total <= sum(found[k]["n_links"] for k in range(len(x))) <= total
        for k in range(200, 207):
            assert (found[k]["n_links"], found[k]["component_id"], found[k]["kept"]) == (0, k, True)
        assert found[None]["n_links"] == 0 and found[None]["component_id"] is None and found[None]["kept"]
    assert vectors.near_vectors(table.limit(0)).count() == 0
    assert vectors.near_vectors(table.where("vec_id = 1")).first()["n_links"] == 0


def versions(n, seed, size):
    """Many versions of one line: words replaced, and single characters put in, left out or replaced."""
    rng = np.random.default_rng(seed)
    base, out = prose(size, seed), []
    for _ in range(n):
        line = base.split(" ")
        for _ in range(rng.integers(0, 3)):
            line[rng.integers(size)] = VOCABULARY[rng.integers(len(VOCABULARY))]
        line = " ".join(line)
        for _ in range(rng.integers(0, 3)):
            at, kind = rng.integers(len(line)), rng.integers(3)
            line = line[:at] + ("" if kind == 0 else "abcxyz"[rng.integers(6)]) + line[at + (kind != 1) :]
        out.append(line.strip())
    return out


def test_versions_of_a_line_link_as_by_brute_force(spark):
    found = versions(250, 80, 9) + versions(150, 81, 40) + [VOCABULARY[k] + prose(5, 900 + k) for k in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(found)], "doc_id long, text string").repartition(6)
    near = [(a, b) for a, b in itertools.combinations(range(len(found)), 2) if lines.within(found[a], found[b], 2)]
    of = classes(range(len(found)), near)
    sizes = {c: list(of.values()).count(c) for c in of.values()}
    got = {r["doc_id"]: r["first_doc_id"] for r in lines.repeated_lines(docs).collect()}
    assert got == {k: c for k, c in of.items() if sizes[c] > 1}
    assert len(set(of.values())) > 100


def test_versions_of_a_paragraph_link_as_by_brute_force(spark):
    found = versions(200, 82, 60) + versions(60, 83, 30)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(found)], "doc_id long, text string").repartition(6)

    def runs(t):
        w = t.split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    sets = [runs(t) for t in found]
    near = [(a, b) for a, b in itertools.combinations(range(len(found)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    of = classes(range(len(found)), near)
    rows = [r for r in paragraphs.repeats(docs).collect() if r["kind"] == "paragraph"]
    got = {r["doc_id"]: r["first_doc_id"] for r in rows}
    sizes = {c: list(of.values()).count(c) for c in of.values()}
    wanted = {k: c for k, c in of.items() if sizes[c] > 1}
    assert sum(got.get(k) == c for k, c in wanted.items()) >= 0.98 * len(wanted) and set(got) <= set(wanted)


def test_contexts_of_passages_are_compared_by_both_ways(spark, capsys, monkeypatch):
    """The words around a run are compared in place; only very common runs send a row a word."""
    rng = np.random.default_rng(9)
    parts = [prose(int(rng.choice([3, 12, 40, 70])), 900 + k) for k in range(8)]
    rows = [(k, " ".join(rng.choice(parts, rng.integers(1, 7)))) for k in range(80)] + [(3, parts[0] + " x " + parts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = paragraphs.anchor_rows(docs, 25).select("doc_id", "start")
    capsys.readouterr()
    paragraphs.reaches(docs, places, 25).explain()
    assert "posexplode(values" not in capsys.readouterr().out
    got = {tuple(map(str, r)) for r in paragraphs.repeated_passages(docs, 25).collect()}
    monkeypatch.setattr(paragraphs, "CONTEXTS", 2)
    assert got and got == {tuple(map(str, r)) for r in paragraphs.repeated_passages(docs, 25).collect()}
    monkeypatch.setattr(paragraphs, "CONTEXTS", 0)
    assert got == {tuple(map(str, r)) for r in paragraphs.repeated_passages(docs, 25).collect()}
