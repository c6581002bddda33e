"""The registered queries on the given tables: SQL where there is any, else the contract."""

import os
import zlib

import pytest

import __spark_entry__
import corpus_pipeline
from shelfmark.llm import queries
from tests.compare import differences, duck

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")

COLUMNS = {
    "op1_embedding_near_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op2_simhash_near_dedup": {"doc_id", "fingerprint", "component_id"},
    "op3_url_filters": {"page_id", "host", "path", "rule", "verdict"},
    "op4_benchmark_decontamination": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op5_line_dedup": {"doc_id", "line_no", "first_doc_id", "removed"},
    "op6_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op7_quality_classifier": {"doc_id", "score", "good"},
    "op8_license_scan": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op9_substring_dedup": {"doc_id", "start", "end", "first_doc_id", "removed"},
    "op10_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op11_merkle_manifest": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    "op12_vector_codes": {"vec_id", "code", "error", "label_error", "codebooks_sha256"},
    "op13_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
}


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) == set(COLUMNS)
    registered = __spark_entry__.queries()
    assert set(COLUMNS) | {"pipeline"} <= set(registered)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    assert COLUMNS[name] <= set(df.columns)
    if name in queries.CHECKS:
        assert differences(duck(DATA), df, queries.CHECKS[name]) == ""
    else:
        assert df.count() > 0


def test_no_equal_line_of_any_length_is_left_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    places = {}
    for r in docs.collect():
        for n, x in enumerate((r["text"] or "").split("\n")):
            if x.strip():
                places.setdefault(x.strip(), []).append((r["doc_id"], n))
    wanted = {p: sorted(ps)[0] for x, ps in places.items() if len(x) < 20 and len(ps) > 1 for p in ps}
    got = {(r["doc_id"], r["line_no"]): (r["first_doc_id"], r["first_line_no"]) for r in queries.QUERIES["op5_line_dedup"](spark, DATA).collect()}
    assert wanted and all(got.get(p) == first for p, first in wanted.items())


def test_pipeline_stages_take_effect(spark, tmp_path):
    """Each stage against the plain rule on its own input."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = ({r["doc_id"]: r["text"] for r in before.collect()}, docs)
        if name != "packing":
            assert docs.columns == columns
    before, after = kept["quality classifier"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    stay = {r["doc_id"] for r in after.collect()}
    held_out = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((i in stay) == bool(labels[i]) for i in held_out) >= 0.9 * len(held_out)
    before, after = kept["line dedup"]
    texts = [r["text"] for r in after.collect()]
    lines = [x.strip() for t in texts for x in t.split("\n") if len(x.strip()) >= 20]
    assert len(texts) == len(before) and len(lines) == len(set(lines))
    before, after = kept["simhash near-dedup"]
    assert 0 < after.count() <= len(before)
    before, after = kept["benchmark decontamination"]
    assert 0 < after.count() <= len(before)
    before, after = kept["packing"]
    pieces = after.collect()
    assert {r["doc_id"] for r in pieces} == set(before)
    fill = {}
    for r in pieces:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048
