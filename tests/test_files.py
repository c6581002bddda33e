"""Readers, sinks, snapshot store and streams."""

import os
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import links, profiling
from shelfmark.operators.changes import KEYS, classify_change
from shelfmark.schema import PRODUCT_COLUMNS, SNAPSHOT_COLUMNS, fill_missing_columns, template_defaults
from shelfmark.session import new_folder
from shelfmark.sources import readers, sinks
from shelfmark.sources.keyed import KeyedTable
from shelfmark.sources.visited import VisitedUrls
from shelfmark.sources.snapshots import read_snapshot, write_batch
from shelfmark.streaming import jobs
from tests.test_ordered import SCHEMA, observations, replay


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def column(df, name="url"):
    return [r[name] for r in df.collect()]


def test_schema_contract():
    assert len(PRODUCT_COLUMNS) == len(set(PRODUCT_COLUMNS)) == 35
    assert SNAPSHOT_COLUMNS[0] == "seller_product_url" and len(SNAPSHOT_COLUMNS) == 36


def test_entrypoints(spark, tmp_path):
    path = write(tmp_path, "e.csv", "url\nhttps://a/1\n\nhttps://a/2\n")
    assert sorted(column(readers.read_entrypoints(spark, path, "s"))) == ["https://a/1", "https://a/2"]
    empty = write(tmp_path, "empty.csv", "url\n")
    assert column(readers.read_entrypoints(spark, empty, "https://start/")) == ["https://start/"]
    bare = write(tmp_path, "bare.csv", "Link\n https://a/1 ,x\nURL\nhttps://a/2\n")
    assert sorted(column(readers.read_entrypoints_headerless(spark, bare))) == ["https://a/1", "https://a/2"]


def test_entrypoints_absent_or_with_more_columns(spark, tmp_path):
    assert column(readers.read_entrypoints(spark, str(tmp_path / "none.csv"), "https://start/")) == ["https://start/"]
    more = write(tmp_path, "more.csv", "id,url\n1,https://a/1\n2,\n")
    assert column(readers.read_entrypoints(spark, more, "https://start/")) == ["https://a/1"]
    other = write(tmp_path, "other.csv", "id,link\n1,https://a/1\n")
    assert column(readers.read_entrypoints(spark, other, "https://start/")) == ["https://start/"]


def test_columns_by_name_over_files(spark, tmp_path):
    (tmp_path / "two").mkdir()
    write(tmp_path, "two/a.csv", "product_name,current_price\nAlpha,10\nBeta,20\n")
    write(tmp_path, "two/b c.csv", "current_price,product_name,extra\n30,Gamma,x\n")
    rows = readers.read_products(spark, str(tmp_path / "two")).orderBy("seq").collect()
    assert [(r["seq"], r["product_name"], r["current_price"], r["extra"]) for r in rows] == [
        (0, "Alpha", "10", None), (1, "Beta", "20", None), (2, "Gamma", "30", "x")]


def test_url_list_without_url_column(spark, tmp_path):
    path = write(tmp_path, "u.csv", "link,x\n https://a/1,1\n ,2\n")
    assert column(readers.read_url_list(spark, path)) == ["https://a/1"]
    both = write(tmp_path, "b.csv", "first,url\nhttps://f/1,\nhttps://f/2,https://a/2\n")
    assert sorted(column(readers.read_url_list(spark, both))) == ["https://a/2", "https://f/1"]


def test_products_with_trailing_commas_and_line_breaks(spark, tmp_path):
    path = write(tmp_path, "p.csv", 'product_name,current_price,\n"a ""q""\nb",5,\nc,,\n')
    df = readers.read_products(spark, path, multi_line=True)
    assert df.columns == ["seq", "current_price", "product_name"] or df.columns == [
        "seq", "product_name", "current_price"]
    rows = {r["seq"]: (r["product_name"], r["current_price"]) for r in df.collect()}
    assert rows == {0: ('a "q"\nb', "5"), 1: ("c", None)}


def test_failures_over_several_lines(spark, tmp_path):
    path = write(tmp_path, "f.txt", "[2026-03-17 01:26:50]  https://a/1  |  Parser returned None\n"
                 "[2026-03-17 01:26:52] https://a/2 | Message: gone\nfrom below\n\tlib [0x1]\n"
                 "[2026-03-18 00:00:00]  https://a/3  |  x | y\n")
    got = {r["url"]: (str(r["ts"]), r["reason"]) for r in readers.read_failures(spark, path).collect()}
    assert got["https://a/1"] == ("2026-03-17 01:26:50", "Parser returned None")
    assert got["https://a/2"][1] == "Message: gone\nfrom below\n\tlib [0x1]"
    assert got["https://a/3"][1] == "x | y"


def test_failure_lines_that_open_with_a_bracket(spark, tmp_path):
    path = write(tmp_path, "g.txt", "lost\n[2026-03-17 01:26:50] https://a/1 | Error\n[0x1] frame\n[0x2] frame\n"
                 "[2026-03-17 01:26:51] https://a/2 | x\n")
    got = {r["url"]: r["reason"] for r in readers.read_failures(spark, path).collect()}
    assert got == {"https://a/1": "Error\n[0x1] frame\n[0x2] frame", "https://a/2": "x"}


def test_failures_round_trip(spark):
    path = new_folder(spark, "failures")
    df = spark.createDataFrame([("https://a/1", "None"), ("https://a/2", "IndexError: x")], "url string, reason string")
    sinks.append_failures(df, path)
    sinks.append_failures(df.limit(1), path)
    assert readers.read_failures(spark, path).count() == 3


def test_empty_export_writes_no_file(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a",)], "product_name string")
    assert not sinks.export_csv(df.limit(0), path) and not os.path.exists(path)
    assert sinks.export_csv(df, path) and os.path.exists(path)


def test_csv_keeps_blanks_and_line_breaks(spark):
    path = new_folder(spark, "blanks")
    values = [" a ", 'say "x"', "line\nbreak", "comma, here"]
    sinks.export_csv(spark.createDataFrame([(v,) for v in values], "product_name string"), path)
    assert sorted(column(readers.read_products(spark, path, multi_line=True), "product_name")) == sorted(values)


def test_chunk_files_hold_exact_slices(spark, tmp_path):
    path = str(tmp_path / "chunks")
    sinks.write_chunks(spark.range(23).select(F.col("id").alias("seq")).repartition(5), path, size=5)
    sizes = {}
    for folder in os.listdir(path):
        if folder.startswith("part="):
            files = [f for f in os.listdir(f"{path}/{folder}") if f.endswith(".csv")]
            lines = [open(f"{path}/{folder}/{f}").read().split() for f in files]
            assert len(files) == 1
            sizes[int(folder[5:])] = [int(x) for x in lines[0][1:]]
    assert sizes == {k + 1: list(range(5 * k, min(5 * k + 5, 23))) for k in range(5)}


def test_columns_filled(spark):
    df = spark.createDataFrame([(1, "x")], "seq int, product_name string")
    filled = fill_missing_columns(df, ("seq",))
    assert filled.columns == ["seq", *PRODUCT_COLUMNS] and filled.first()["currency"] is None
    assert template_defaults(df).first()["currency"] == "BDT"


def test_snapshot_table(spark):
    folder = new_folder(spark, "table")
    assert read_snapshot(spark, folder) is None

    def batch(*rows):
        return spark.createDataFrame(rows, "seq long, seller_product_url string, product_name string")

    def state(before=None):
        return {r["seller_product_url"]: r["product_name"] for r in read_snapshot(spark, folder, before).collect()}

    write_batch(batch((0, "a", "1"), (1, "b", "1"), (2, "a", "2")), folder, 0)
    assert state() == {"a": "2", "b": "1"}
    write_batch(batch((3, "b", "3")), folder, 1)
    write_batch(batch((3, "b", "4")), folder, 1)
    assert state() == {"a": "2", "b": "4"} and state(before=1) == {"a": "2", "b": "1"}
    wanted = batch((0, "b", "x"), (1, "z", "x")).withColumn("seller_name", F.lit(None).cast("string"))
    assert column(read_snapshot(spark, folder, items=wanted), "product_name") == ["4"]
    write_batch(batch((9, "c", "5"), (10, None, "x")), folder, 2)
    assert state() == {"a": "2", "b": "4", "c": "5"}
    write_batch(batch((0, "a", "repeated")), folder, 0)
    assert state() == {"a": "repeated", "b": "4", "c": "5"}


@pytest.mark.parametrize("job", ["state", "batch"])
def test_streams_equal_replay_and_resume(spark, job):
    rows = observations(11, n=600)
    landing, out, checkpoint = (new_folder(spark, n) for n in ("landing", "out", "checkpoint"))
    for begin in (0, 300):
        part = spark.createDataFrame(rows[begin:begin + 300], SCHEMA)
        part.repartition(3).write.mode("append").parquet(landing)
        stream = readers.stream_table(spark, landing, SCHEMA)
        if job == "state":
            jobs.changes_of_stream(stream, out, checkpoint).awaitTermination()
        else:
            jobs.ingest_stream(stream, out, checkpoint).awaitTermination()
    got = spark.read.parquet(f"{out}/log").collect()
    assert {r["seq"]: r["kind"] for r in got} == replay(rows)
    assert len(got) == len(rows)


def test_pagination_cutoff(spark):
    listing = spark.createDataFrame([
        ("s", 1, "a"), ("s", 2, "b"), ("s", 3, "a"), ("s", 4, "c"),       # page 3 adds nothing
        ("t", 1, "a"), ("t", 2, "b"), ("t", 3, "c"),
        ("u", 1, "a"), ("u", 1, "b")], "source_url string, page_num int, product_url string")
    got = sorted((r["source_url"], r["product_url"]) for r in links.pagination_cutoff(listing).collect())
    assert got == [("s", "a"), ("s", "b"), ("t", "a"), ("t", "b"), ("t", "c"), ("u", "a"), ("u", "b")]
    pages = spark.createDataFrame([
        ("s", 1, "s1", "s2"), ("s", 2, "s2", "s3"), ("s", 3, "s3", "s4"), ("s", 4, "s4", None),
        ("t", 1, "t1", "t2"), ("t", 2, "t2", "t2"), ("t", 3, "t3", None), ("u", 1, "u1", None)],
        "source_url string, page_num int, page_url string, next_url string")
    got = sorted((r["source_url"], r["product_url"]) for r in links.pagination_cutoff(listing, pages).collect())
    assert got == [("s", "a"), ("s", "b"), ("t", "a"), ("t", "b"), ("u", "a"), ("u", "b")]


def test_pending_keeps_duplicates(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "url string")
    done = spark.createDataFrame([(" a ",), ("",), ("c",)], "seller_product_url string")
    assert sorted(column(links.pending_urls(urls, done))) == ["b", "b"]


def test_entrypoint_yield(spark):
    found = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "b"), (2, "c"), (3, "a")], "entry long, url string")
    got = sorted(tuple(r) for r in links.entrypoint_yield(found).select("entry", "found", "new", "duplicates").collect())
    assert got == [(1, 2, 2, 0), (2, 2, 1, 1), (3, 1, 0, 1)]


def seen_rows(spark, *rows):
    return spark.createDataFrame(rows, "seller string, url string, value long")


def test_keyed_table_reads_the_buckets_of_its_keys_only(spark):
    rows = [(f"s{s}", f"u{u}", 0) for s in range(6) for u in range(200)]
    table = KeyedTable(new_folder(spark, "keyed"), seen_rows(spark, rows[0]).schema, ("seller", "url"), 4, 8)
    assert table.latest(spark) is None and table.latest(spark, items=seen_rows(spark, rows[0])) is None
    for batch in range(3):
        table.write(seen_rows(spark, *[(s, u, batch) for s, u, _ in rows]), batch)
    batch = seen_rows(spark, *[("s1", f"u{u}", 9) for u in range(40)], ("s1", "unseen", 9), (None, None, 9))
    wanted = table.buckets_of(batch)
    assert len(wanted) < 32

    def buckets(df):
        return {int(f.split("bucket=")[1].split("/")[0]) for f in df.inputFiles()}

    got = table.latest(spark, before=2, items=batch)
    assert buckets(got) <= set(wanted)
    assert sorted(map(tuple, got.collect())) == sorted(("s1", f"u{u}", 1) for u in range(40))
    before = len(table.versions(spark).inputFiles())
    table.fold(spark, 2)
    folded = table.versions(spark)
    assert len(folded.inputFiles()) < before
    assert buckets(table.latest(spark, items=batch)) <= set(wanted)
    assert sorted(map(tuple, table.latest(spark, before=2).collect())) == sorted((s, u, 1) for s, u, _ in rows)
    table.write(seen_rows(spark, ("s1", "u1", 7)), 2)  # repeated: its other rows are gone
    got = {(r["seller"], r["url"]): r["value"] for r in table.latest(spark).collect()}
    assert got == {(s, u): 7 if (s, u) == ("s1", "u1") else 1 for s, u, _ in rows}
    table.fold(spark, 2)
    table.fold(spark, 3)
    assert {(r["seller"], r["url"]): r["value"] for r in table.latest(spark).collect()} == got
    assert all("/base/" in f for f in table.versions(spark).inputFiles())


def test_a_fold_that_was_cut_off_reads_as_one(spark):
    table = KeyedTable(new_folder(spark, "cut"), seen_rows(spark, ("a", "b", 0)).schema, ("seller", "url"))
    table.write(seen_rows(spark, ("s", "a", 0), ("s", "b", 0)), 0)
    kept = f"{new_folder(spark, 'kept')}"
    spark.read.parquet(f"{table.folder}/recent/batch=0").write.partitionBy("bucket").parquet(kept)
    table.fold(spark, 1)
    spark.read.parquet(kept).write.partitionBy("bucket").parquet(f"{table.folder}/recent/batch=0")
    assert sorted(map(tuple, table.latest(spark).collect())) == [("s", "a", 0), ("s", "b", 0)]


def test_stream_of_changes_with_folds(spark):
    """Six micro-batches, folded after each second one."""
    rows = [(k - 2000, *r[1:]) for k, r in enumerate(observations(5, n=1200))]  # positions below zero
    source, out, checkpoint = (new_folder(spark, n) for n in ("source", "out", "checkpoint"))
    for k in range(6):
        spark.createDataFrame(rows[200 * k : 200 * k + 200], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = readers.stream_table(spark, source, spark.read.parquet(source).schema)
        jobs.changes_of_stream(stream, out, checkpoint, compare=["product_name", "current_price"],
                               fold_every=2).awaitTermination()
    got = {r["seq"]: r["kind"] for r in spark.read.parquet(f"{out}/log").collect()}
    assert got == replay(rows)
    state = KeyedTable(f"{out}/seen", spark.read.parquet(f"{out}/seen/base").drop("batch", "bucket").schema, KEYS)
    assert {f.split("/seen/")[1].split("/bucket")[0] for f in state.versions(spark).inputFiles()} <= {
        "base", "recent/batch=4", "recent/batch=5"}


def test_known_versions_lead_whatever_the_positions(spark):
    known = spark.createDataFrame([(7, "s", "u", "n", "1")], SCHEMA)
    items = spark.createDataFrame([(-5, "s", "u", "n", "1"), (-4, "s", "u", "n", "2"), (None, "s", "v", "n", "1")], SCHEMA)
    got = {r["seq"]: r["kind"] for r in classify_change(items, known, compare=["product_name", "current_price"]).collect()}
    assert got == {-5: "duplicate", -4: "update", None: "new"}


def test_a_span_needs_a_time(spark):
    links = spark.createDataFrame([("a",)], "url string")
    with pytest.raises(ValueError):
        jobs.distinct_urls_of_stream(links, within="1 day")


def test_every_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "many").mkdir()
    for k in range(40):
        names = ["product_name", "current_price", "note"][: 2 + k % 2]
        if k % 3:
            names.reverse()
        write(tmp_path, f"many/{k:02}.csv", ",".join(names) + "\n\n" + ",".join(f"{n[0]}{k}" for n in names) + "\r\n")
    df = readers.read_products(spark, str(tmp_path / "many"))
    assert df.columns == ["seq", "product_name", "current_price", "note"]
    got = sorted(map(tuple, df.collect()))
    assert got == [(k, f"p{k}", f"c{k}", f"n{k}" if k % 2 else None) for k in range(40)]


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_csv_files_are_read_once(spark, tmp_path):
    path = write(tmp_path, "p.csv", "product_name,current_price\nAlpha,10\n")
    records = readers._records(spark, path, False)
    assert scans(records) == 1
    assert scans(readers.read_products(spark, path)) == 0  # only what was written after that one scan


def test_cells_of_any_form(spark, tmp_path):
    path = write(tmp_path, "odd.csv", '﻿a,B,b,a,,"x,""y"""\n1,,"",4,5,"p,q"\n 7 ,"8""",9\n1,2,3,4,5,6,7\n,\n')
    df = readers.read_products(spark, path)
    assert df.columns == ["seq", "a", "B", "b", "a.1", 'x,"y"']
    assert sorted(map(tuple, df.collect())) == [
        (0, "1", None, "", "4", "p,q"), (1, " 7 ", '8"', "9", None, None), (2, "1", "2", "3", "4", "6"), (3, None, None, None, None, None)]
    lines = write(tmp_path, "lines.csv", 'a,b\r\n"x\r\ny, ""z""",2\r\n\r\n3,"4"\r\n')
    assert sorted((r["seq"], r["a"], r["b"]) for r in readers.read_products(spark, lines, multi_line=True).collect()) == [
        (0, 'x\r\ny, "z"', "2"), (1, "3", "4")]
    (tmp_path / "bare").mkdir()
    empty = write(tmp_path, "bare/none.csv", "")
    assert readers.read_products(spark, empty).columns == ["seq"] and readers.read_products(spark, empty).count() == 0
    assert readers.read_url_list(spark, empty).count() == 0


def test_long_cells_and_many_quotes(spark, tmp_path):
    path = write(tmp_path, "long.csv", 'a,b\n"' + 'x""' * 200_000 + '",1\n' + '"' * 50_001 + ",2\n")
    rows = readers.read_products(spark, path).orderBy("seq").collect()
    assert rows[0]["a"] == 'x"' * 200_000 and rows[0]["b"] == "1"


def test_url_lists_with_their_own_first_columns(spark, tmp_path):
    (tmp_path / "lists").mkdir()
    write(tmp_path, "lists/a.csv", "id,url\nhttps://f/1,https://a/1\nhttps://f/2,\n")
    write(tmp_path, "lists/b.csv", "link,id\nhttps://b/1,3\n")
    assert sorted(column(readers.read_url_list(spark, str(tmp_path / "lists")))) == [
        "https://a/1", "https://b/1", "https://f/2"]


def test_log_entries_over_many_slices(spark):
    """Entries longer than a slice, lines before the first one, positions with gaps."""
    rng = random.Random(3)
    lines, entries = ["lost", "lost too"], []
    for k in range(300):
        more = [f"  frame {k} {j}" for j in range(rng.choice([0, 0, 1, 2, 90]))]
        entries.append((f"https://a/{k}", "\n".join([f"Error {k}", *more])))
        lines += [f"[2026-03-17 01:26:50] https://a/{k} | Error {k}", *more]
    df = spark.createDataFrame([(7 * i, x) for i, x in enumerate(lines)], "seq long, line string").repartition(5)
    got = sorted((r["url"], r["reason"]) for r in readers.parse_failures(df).collect())
    assert got == sorted(entries)
    none = spark.createDataFrame([], "seq long, line string")
    assert readers.parse_failures(none).count() == 0


def test_visited_urls_stay_where_they_lie(spark, tmp_path):
    visited = VisitedUrls(spark, "visited_of_test", str(tmp_path / "visited"), buckets=4)
    found = spark.createDataFrame([(f"https://a/{k % 50}",) for k in range(200)] + [(None,)], "url string")
    assert visited.unvisited(found).count() == 50 and visited.pending(found).count() == 201
    try:
        visited.add(found.filter("url < 'https://a/3'"), 0)
        visited.add(spark.createDataFrame([("https://a/9",), (None,), ("https://a/9",)], "url string"), 1)
        visited.add(spark.createDataFrame([("https://a/9",)], "url string"), 1)
        done = {f"https://a/{k}" for k in range(50) if f"https://a/{k}" < "https://a/3"} | {"https://a/9"}
        fresh = visited.unvisited(found)
        visited_side = fresh._jdf.queryExecution().executedPlan().toString().rsplit("Sort [", 1)[1]
        assert "Bucketed: true" in visited_side and "Exchange" not in visited_side
        assert {r["url"] for r in fresh.collect()} == {f"https://a/{k}" for k in range(50)} - done
        pending = visited.pending(found)
        assert sorted(r["url"] or "" for r in pending.collect()) == sorted(
            [u for u in (f"https://a/{k % 50}" for k in range(200)) if u not in done] + [""])
    finally:
        spark.sql("drop table if exists visited_of_test")


def test_sketches_of_batches_unite(spark):
    rows = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("a"), F.lit(None).cast("string").alias("b"), "id")
    folder = new_folder(spark, "sketches")
    for batch in (0, 1, 2, 1):
        sinks.write_sketches(profiling.distinct_sketches(rows.filter(F.col("id") % 3 == batch), ["a", "b", "id"]), folder, batch)
    got = profiling.united_nunique(spark.read.parquet(folder), ["a", "b", "id"]).first()
    assert abs(got["a"] - 1000) <= 50 and got["b"] == 0 and abs(got["id"] - 3000) <= 150
    assert profiling.united_nunique(profiling.distinct_sketches(rows.limit(0), ["a"]), ["a"]).first()["a"] == 0
