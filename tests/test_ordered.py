"""Order-dependent operators against plain replays, with slices small enough to matter."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import changes, ordered
from shelfmark.plans.ingest import apply_stop_rules, ingest_run
from shelfmark.session import cut, new_folder
from shelfmark.sources import sinks

SCHEMA = "seq long, seller_name string, seller_product_url string, product_name string, current_price string"


def observations(seed, n=3000, sellers=3, urls=40, hot=True):
    """One URL and one seller hold more than a third of all rows."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        if hot and rng.random() < 0.4:
            seller, url = 0, 0
        else:
            seller = rng.randrange(sellers)
            url = rng.randrange(urls)
        price = str(rng.choice([100, 100, 100, 100, 200])) + rng.choice(["", " "])
        rows.append((seq, f"s{seller}", f"https://s{seller}/{url}", "name", price))
    return rows


def replay(rows, known=()):
    """Kind per row, as one process with a dictionary would say."""
    seen, kinds = dict(known), {}
    for seq, seller, url, name, price in sorted(rows):
        value = (name.strip(), price.strip())
        kinds[seq] = "new" if (seller, url) not in seen else (
            "duplicate" if seen[seller, url] == value else "update")
        seen[seller, url] = value
    return kinds


def replay_any(rows):
    """As ``replay``, for rows whose seller may be None."""
    return replay([(seq, s or "", *rest) for seq, s, *rest in rows])


def replay_stop(rows, kinds, max_duplicates, max_items):
    """Rows each seller's run sees before it stops."""
    kept = []
    for seller in {r[1] for r in rows}:
        in_a_row = count = 0
        for row in sorted(r for r in rows if r[1] == seller):
            kept.append(row[0])
            if kinds[row[0]] == "duplicate":
                in_a_row += 1
                if max_duplicates is not None and in_a_row >= max_duplicates:
                    break
            else:
                in_a_row, count = 0, count + 1
                if max_items and count >= max_items:
                    break
    return sorted(kept)


@pytest.mark.parametrize("slices", [None, 40])
@pytest.mark.parametrize("spread", [1, 1_700_000_123])
def test_classify_equals_replay(spark, slices, spread):
    """Also with positions as sparse as timestamps, and a hot key without a seller."""
    rows = [(seq * spread, None if s == "s0" else s, *rest) for seq, s, *rest in observations(1)]
    df = cut(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = changes.classify_change(df, slices=slices)
    assert {r["seq"]: r["kind"] for r in got.collect()} == replay_any(rows)
    assert got.columns == df.columns + ["kind"]


@pytest.mark.parametrize("spread", [1, 1_700_000_123])
def test_slices_are_even_for_any_positions(spark, spread):
    rows = [(seq * spread, *rest) for seq, *rest in observations(1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    sizes = [r["count"] for r in ordered.in_slices(df, ["seller_name", "seller_product_url", "seq"], 10)
             .groupBy("_slice").count().collect()]
    assert 8 <= len(sizes) <= 10 and max(sizes) < 2 * len(rows) / 10


@pytest.mark.parametrize("slices", [None, 25])
def test_classify_with_known_versions(spark, slices):
    rows = observations(2, n=800)
    known = {("s0", "https://s0/0"): ("name", "100"), ("s1", "https://s1/3"): ("name", "7")}
    stored = spark.createDataFrame(
        [(s, u, n, p) for (s, u), (n, p) in known.items()],
        "seller_name string, seller_product_url string, product_name string, current_price string")
    df = spark.createDataFrame(rows, SCHEMA)
    got = changes.classify_change(df, stored, slices=slices)
    assert {r["seq"]: r["kind"] for r in got.collect()} == replay(rows, known)


def test_rows_without_url_are_set_apart(spark):
    df = spark.createDataFrame([(0, "s", None, "a", "1"), (1, "s", " ", "a", "1"), (2, "s", "u", "a", "1"),
                                (3, "s", "", "a", "1")], SCHEMA)
    keyed, keyless = changes.split_keyed(df)
    assert sorted(r["seq"] for r in keyless.collect()) == [0, 3]
    assert sorted(r["seq"] for r in keyed.collect()) == [1, 2]


@pytest.mark.parametrize("duplicates,items", [(3, 0), (8, 0), (1000, 100), (6, 40), (10 ** 9, 0), (1, 1), (None, 40), (None, None), (0, 0)])
def test_stop_rules_equal_replay(spark, duplicates, items):
    rows = observations(3, n=1500)
    kinds = replay(rows)
    df = spark.createDataFrame([(*r, kinds[r[0]]) for r in rows], SCHEMA + ", kind string").repartition(4)
    stops = changes.stop_points(df, duplicates, items, slices=20)
    got = sorted(r["seq"] for r in changes.until_stop(df, stops).collect())
    assert got == replay_stop(rows, kinds, duplicates, items)
    assert sorted(r["seq"] for r in apply_stop_rules(df, duplicates, items).collect()) == got
    assert sum(r["n_left_out"] for r in changes.left_out(df, stops).collect()) == len(rows) - len(got)


def test_row_index_is_dense_and_ordered(spark):
    rng = random.Random(4)
    rows = [(src, seq) for src in (0, 1) for seq in rng.sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "src int, seq long").repartition(6)
    got = ordered.row_index(df, lead=["src"], slices=14).collect()
    assert [(r["src"], r["seq"]) for r in sorted(got, key=lambda r: r["row_index"])] == sorted(rows)
    assert sorted(r["row_index"] for r in got) == list(range(1, 1401))


@pytest.mark.parametrize("n,size", [(10, 4), (8, 4), (1, 4), (0, 4)])
def test_chunks_are_full_but_the_last(spark, n, size):
    df = spark.range(n).select((F.col("id") * 7).alias("seq"))
    parts = [r["count"] for r in sinks.with_chunk(df, size).groupBy("part").count().orderBy("part").collect()]
    assert parts == [size] * (n // size) + ([n % size] if n % size else [])


def test_take_while(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, None), (3, "a")], "seq int, v string").repartition(3)
    assert sorted(r["seq"] for r in ordered.take_while(df, F.col("v").isNotNull()).collect()) == [0, 1]
    assert ordered.take_while(df, F.lit(True)).count() == 4
    assert ordered.take_while(df, F.col("v") == "z").count() == 0


def test_first_rows_limit_before_the_shuffle(spark):
    df = spark.createDataFrame(observations(5), SCHEMA)
    plan = ordered.first_rows(df, ["seller_product_url"], [F.col("seq")])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_whole_row_replace(spark):
    first = spark.createDataFrame([(0, "u", "a", "Yes"), (1, "v", "b", "No")],
                                  "seq long, seller_product_url string, product_name string, in_stock string")
    second = spark.createDataFrame([(2, "u", "c"), (3, "u", "d")],
                                   "seq long, seller_product_url string, product_name string")
    snapshot = changes.as_snapshot(changes.latest_per_url(first))
    merged = changes.upsert_snapshot(snapshot, second)
    assert merged.columns == snapshot.columns and len(merged.columns) == 36
    got = {r["seller_product_url"]: (r["product_name"], r["in_stock"]) for r in merged.collect()}
    assert got == {"u": ("d", None), "v": ("b", "No")}


def test_two_sellers_with_one_url(spark):
    rows = [(0, "a", "u", "n", "1"), (1, "b", "u", "n", "2")]
    folder = new_folder(spark, "sellers")
    assert ingest_run(spark.createDataFrame(rows, SCHEMA), folder, 0).count() == 2
    again = spark.createDataFrame([(seq + 2, *rest) for seq, *rest in rows], SCHEMA)
    assert ingest_run(again, folder, 1).count() == 0


def test_repeated_ingest_run_changes_nothing(spark):
    rows = observations(6, n=400)
    half = len(rows) // 2
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (rows[:half], rows[half:]))
    folder = new_folder(spark, "repeat")

    def state():
        log = spark.read.parquet(f"{folder}/log")
        return sorted((r["seq"], r["kind"]) for r in log.collect())

    ingest_run(first, folder, 0)
    ingest_run(second, folder, 1)
    before = state()
    assert before == sorted((s, k) for s, k in replay(rows).items() if k != "duplicate")
    ingest_run(second, folder, 1)
    assert state() == before
