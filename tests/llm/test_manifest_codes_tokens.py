"""Manifest, vector codes and byte pairs: brute force, round trips, and every odd input."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from shelfmark.llm import bytepairs, codebooks, merkle, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "\n".join(f"line {k} of a very long text" for k in range(20_000))
ODD = [
    (7, "a\nb", "en", "s", 3), (7, "a\nb", "en", "s", 3), (7, "other", "en", "s", 5), (None, "no id", None, "s", None),
    (None, None, None, None, None), (3, "", "", "", 0), (3, None, "en", None, 1), (4, LONG, "en", "lone", len(LONG)),
    (-5, "é\n\n日本", "fr", "s", 6),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def climb(level):
    """Root of digests, and each one's siblings as (left, right), level by level."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, k in enumerate(at):
            run = k - k % 3
            paths[i].append(("".join(level[run:k]), "".join(level[k + 1 : run + 3])))
        level, at = [sha("".join(level[k : k + 3])) for k in range(0, len(level), 3)], [k // 3 for k in at]
    return level[0], paths


def plain_manifest(rows):
    trees = {}
    for i, text, lang, source, n in rows:
        lost = i is not None and text is not None and zlib.crc32(str(i).encode()) % 2 == 0
        claim = sha(told(i, source, lang, n, text.replace("\n", "") if lost else text))
        trees.setdefault(source, []).append((i is not None, i or 0, sha(told(i, source, lang, n, text)), claim, i))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    lows = []
    for s in names:
        trees[s].sort()
        lows.append(climb([x[2] for x in trees[s]]))
    root, tops = climb([r for r, _ in lows]) if lows else (None, [])
    out = []
    for s, (subroot, paths), top in zip(names, lows, tops, strict=True):
        for (_, _, leaf, claim, i), path in zip(trees[s], paths, strict=True):
            node = claim
            for left, right in path + top:
                node = sha(left + node + right)
            out.append((i, leaf, subroot, root, sha("".join(a + b for a, b in path + top)), node, node == root))
    return out


def op11_rows(docs):
    lost = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    altered = F.when(lost, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return [tuple(r) for r in merkle.verified(docs, altered).collect()]


@pytest.mark.parametrize("block", ["as it is", "small"])
def test_manifest(spark, monkeypatch, block):
    if block == "small":  # more rounds of blocks
        monkeypatch.setattr(merkle, "LEVELS", 2)
        monkeypatch.setattr(merkle, "BLOCK", 9)
    many = [(k, f"text {k}\n", "en", "hot" if k % 3 else f"src{k % 40}", k) for k in range(700)]
    rows = ODD + many
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    docs = docs.select("*", *[F.lit("clash").alias(c) for c in ("tree", "key", "leaf", "id", "row", "place", "n", "tie", "root", "path", "_slice")])
    assert sorted(op11_rows(docs), key=repr) == sorted(plain_manifest(rows), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 81, 82, 243, 244])
def test_manifest_of_one_tree(spark, n):
    rows = [(k, "a\nb", None, "one", 3) for k in range(n)]
    assert sorted(op11_rows(spark.createDataFrame(rows, DOCS))) == sorted(plain_manifest(rows))


def test_manifest_of_copies_and_of_many_trees(spark):
    copies = [(1, "same", "en", "s", 4)] * 300
    assert sorted(op11_rows(spark.createDataFrame(copies, DOCS))) == sorted(plain_manifest(copies))
    trees = [(k, "x", "en", f"s{k}", 1) for k in range(200)]
    assert sorted(op11_rows(spark.createDataFrame(trees, DOCS))) == sorted(plain_manifest(trees))


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """[(id, vector)] to (codes, errors, codebooks), every entry looked at."""
    kept = sorted(((i is None, i or 0, v), v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v))
    wide = max(max(-(-len(v) // parts) for _, v in kept), 1)
    x = np.zeros((len(kept), parts * wide), dtype=object)
    for r, (_, v) in enumerate(kept):
        x[r, : len(v)] = [int(np.floor(256.0 * c)) for c in v]
    x = x.reshape(-1, parts, wide)
    books = x[:entries].copy()

    def assign():
        out = []
        for p in range(parts):
            far = [[sum((a - b) ** 2 for a, b in zip(q, e, strict=True)) for e in books[:, p]] for q in x[:, p]]
            out.append([min((d, k) for k, d in enumerate(row)) for row in far])
        return out

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for k in range(len(books)):
                mine = [x[r, p] for r in range(len(x)) if near[p][r][1] == k]
                if mine:
                    books[k, p] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    near = assign()
    found = [("".join(f"{near[p][r][1]:02x}" for p in range(parts)), sum(near[p][r][0] for p in range(parts))) for r in range(len(x))]
    text = ",".join(str(c) for p in range(parts) for e in books[:, p] for c in e)
    return [(k[1] if not k[0] else None, *f) for (k, _), f in zip(kept, found, strict=True)], hashlib.sha256(text.encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int"


def test_codes(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(0, 0.3, (150, 32)).astype(np.float32).round(2)
    vectors[40:70] = vectors[40]  # copies, and so ties
    rows = [(int(k), [float(c) for c in v]) for k, v in enumerate(vectors)]
    rows += [(3, rows[5][1]), (3, None), (None, rows[8][1]), (900, [float("nan")] * 32), (901, [None] * 32), (902, [float("inf")] + [0.0] * 31)]
    table = spark.createDataFrame([(i, v, [None, 1, 2][k % 3]) for k, (i, v) in enumerate(rows)], VECTORS).repartition(4)
    table = table.select("*", *[F.lit("mine").alias(c) for c in ("code", "Error", "label_error")])
    coded, books = codebooks.codes(table)
    wanted, digest = plain_codes(rows)
    got = coded.collect()
    assert books.sha256() == digest
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in got), key=repr) == sorted(wanted, key=repr)
    assert {r["_code"] for r in got} == {r["_Error"] for r in got} == {"mine"}
    sums = {}
    for r in got:
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    grouped = codebooks.with_group_error(coded).collect()
    assert len(grouped) == len(got) and all(r["label_error"] == sums[r["label"]] and r["_label_error"] == "mine" for r in grouped)


def test_codes_of_odd_tables(spark):
    lengths = [(1, [0.5] * 20), (2, []), (3, [0.1]), (4, [-0.3] * 33), (None, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, 0) for i, v in lengths], VECTORS)
    coded, books = codebooks.codes(table)
    wanted, digest = plain_codes(lengths)
    assert books.sha256() == digest
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in coded.collect()), key=repr) == sorted(wanted, key=repr)
    for rows in ([], [(1, None, 0), (2, [float("nan")], None)]):
        coded, books = codebooks.codes(spark.createDataFrame(rows, VECTORS))
        assert books is None and coded.columns == ["vec_id", "embedding", "label", "code", "error"] and coded.count() == 0
        assert codebooks.with_group_error(coded).count() == 0
    vast = spark.createDataFrame([(k, [(-1.0) ** k * 3e38] * 16, 0) for k in range(70)], VECTORS)
    assert all(r["error"] == 0 for r in codebooks.codes(vast)[0].collect())


def test_search_finds_the_lowest_of_the_nearest():
    rng = np.random.default_rng(2)
    for spread in (1, 2, 5, 300):
        books = codebooks.Codebooks(rng.integers(-spread, spread + 1, (3, 64, 5)))
        queries_ = rng.integers(-spread - 1, spread + 2, (2000, 5))
        for part in range(3):
            far = ((queries_[:, None] - books.entries[part]) ** 2).sum(2)
            index, near = books.nearest(part, queries_)
            assert (index == far.argmin(1)).all() and (near == far.min(1)).all()


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library(library, monkeypatch):
    encoder = bytepairs.Encoder(RANKS, public_tokenizers.PATTERN)
    # a row of ids is lawful if its pairs are, provided that each id is what its own bytes give
    assert all(len(encoder.merges._merged_by_heap(token)) == 1 for token in encoder.merges.ranks)
    chance = random.Random(7)
    kinds = ["ab", "a'rels tvmd", "ab \n\t  ", "01 9a", " \n", "'r e", "éa日   x", "xyz{}!'s ", " 'll'", "the in er re "]
    for chars, width in ((8, 1), (9, 3), (40, 8), (2048, 64)):
        monkeypatch.setattr(bytepairs, "LEAF_CHARS", chars)
        monkeypatch.setattr(bytepairs, "LEAF_BYTES", width)
        for _ in range(700):
            kind = chance.choice(kinds)
            text = "".join(chance.choice(kind) for _ in range(chance.randint(0, 260)))
            got = np.frombuffer(b"".join(encoder.ids([text])), dtype="<u4").tolist()
            assert got == library.encode_ordinary(text), text
            assert encoder.merges.decoded(got) == text.encode()


def test_words_without_an_end(library):
    encoder = bytepairs.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in ("x" * 30_000, "ab" * 20_000, " " * 30_000, "日本" * 9_000, "7" * 30_000, "\n" * 9_000 + "a" * 9_000):
        assert np.frombuffer(b"".join(encoder.ids([text])), dtype="<u4").tolist() == library.encode_ordinary(text)


def test_encode_and_decode(spark, library):
    rows = ODD + [(50, "<|endoftext|> is plain text", "en", "s", 1), (51, " \n\t ", "en", "s", 1), (52, "x" * 5000 + "日本語 " * 900, "ja", "t", 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3).select("*", F.lit("a").alias("ids"), F.lit("b").alias("Decoded"))
    both = bytepairs.decode(bytepairs.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert both.columns == ["doc_id", "lang", "source", "n_chars", "_ids", "_decoded", "ids", "decoded"]
    got = sorted((repr(r["doc_id"]), np.frombuffer(r["ids"], dtype="<u4").tolist(), bytes(r["decoded"])) for r in both.collect())
    assert got == sorted((repr(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows)
    empty = spark.createDataFrame([], DOCS)
    assert bytepairs.decode(bytepairs.encode(empty, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_query_of_byte_pairs(spark, library):
    data = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in queries.QUERIES["op13_byte_bpe"](spark, data).collect())
    wanted = []
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        ids = library.encode_ordinary(r["text"] or "")
        wanted.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), sha(r["text"] or "")))
    assert got == sorted(wanted)
