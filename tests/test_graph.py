import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import P, SUPPORT_ROWS, one, table, tweets
from threadlens import Params
from threadlens.operators import graph as gr


def test_brand_filter_keeps_whole_conversations(spark):
    df = tweets(spark, SUPPORT_ROWS)
    assert {r["tweet_id"] for r in gr.filter_brand(df, P).collect()} == set("123456")
    report = one(gr.brand_filter_report(df, P))
    assert (report["original_rows"], report["filtered_rows"], report["brand_messages"]) == (8, 6, 3)
    assert report["retention_pct"] == 75.0 and report["rounds"] == 1


def test_unknown_brand_names_the_known_ones(spark):
    with pytest.raises(ValueError, match="OtherCo"):
        gr.filter_brand(tweets(spark, SUPPORT_ROWS), Params(brand="Nobody"))


def test_expansion_directions_and_round_limit(spark):
    # a chain of customers hangs on one brand message; x only lists a kept row
    rows = [("b", "AcmeSupport", 0, "hi", None, None)]
    rows += [(f"c{i}", "u", i, "t", None, "b" if i == 1 else f"c{i - 1}") for i in range(1, 15)]
    rows += [("x", "u", 50, "t", "c1", None), ("c99", "u", 51, "t", None, None)]
    df = tweets(spark, rows)
    kept = {r["tweet_id"] for r in gr.filter_brand(df, P).collect()}
    assert kept == {"b"} | {f"c{i}" for i in range(1, 15)} and "x" not in kept
    assert one(gr.brand_filter_report(df, P))["converged"]
    ten = Params(brand=P.brand, max_expansion_rounds=10)
    kept = {r["tweet_id"] for r in gr.filter_brand(df, ten).collect()}
    assert kept == {"b"} | {f"c{i}" for i in range(1, 12)}  # seed reaches c1, ten rounds more
    assert not one(gr.brand_filter_report(df, ten))["converged"]
    listed = tweets(
        spark,
        [*rows[:2], ("c2", "u", 3, "t", " y ,nothing", "c1"), ("y", "u", 60, "t", None, None)],
    )
    assert "y" in {r["tweet_id"] for r in gr.filter_brand(listed, P).collect()}


def test_threads(spark):
    df = gr.filter_brand(tweets(spark, SUPPORT_ROWS), P)
    threads = table(gr.build_threads(df, P), "tweet_id")
    assert {k: v["conversation_id"] for k, v in threads.items()} == {
        **dict.fromkeys("1234", "conv_000000"), **dict.fromkeys("56", "conv_000001")}
    assert [threads[k]["role"] for k in "123456"] == ["customer", "brand"] * 3
    assert [threads[k]["depth"] for k in "1234"] == [0, 1, 2, 3]


def brute_force_threads(rows, max_depth):
    parent = {r[0]: r[5].strip() if r[5] else None for r in rows}
    out = {}
    for node in parent:
        path, current = 0, node
        while parent[current] in parent and path <= max_depth:
            current, path = parent[current], path + 1
        if path <= max_depth and parent[current] not in parent:
            out[node] = (current, path)
    return out


def test_depth_cap_cycles_and_orphans_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"n{i:03d}", "u", i, "t", None, f"n{rng.randrange(max(0, i - 3), i):03d}" if i % 25 else None) for i in range(200)]
    rows += [(f"q{i}", "u", i, "t", None, f" q{i - 1} " if i else None) for i in range(30)]
    rows += [("z1", "u", 1, "t", None, "z2"), ("z2", "u", 2, "t", None, "z1"), ("z3", "u", 3, "t", None, "z1")]
    rows += [("o1", "u", 5, "t", None, "missing"), ("o2", "u", None, None, None, "o1")]
    rng.shuffle(rows)
    for depth in (0, 3, 20):
        want = brute_force_threads(rows, depth)
        members = gr.thread_members(tweets(spark, rows), depth).collect()
        assert {r["tweet_id"]: (r["root_id"], r["depth"]) for r in members} == want
    threads = gr.build_threads(tweets(spark, rows), P)
    assert threads.filter("tweet_id LIKE 'q%'").count() == 21
    assert threads.filter("tweet_id LIKE 'z%'").count() == 0
    assert threads.filter("text IS NULL").count() == 0
    again = gr.build_threads(tweets(spark, rows).repartition(7), P)
    assert sorted(map(str, threads.collect())) == sorted(map(str, again.collect()))


def test_numbering_follows_root_time(spark):
    rows = [(f"r{i}", "u", 100 - i, "t", None, None) for i in range(50)] + [("late", "u", None, "t", None, None)]
    got = table(gr.build_threads(tweets(spark, rows), P), "tweet_id")
    assert got["r49"]["conversation_id"] == "conv_000000"
    assert got["r0"]["conversation_id"] == "conv_000049"
    assert got["late"]["conversation_id"] == "conv_000050"


def test_duplicate_ids_keep_the_latest(spark):
    rows = [("1", "u", 0, "old", None, None), ("1", "u", 9, "new", None, None), ("2", "u", 3, "t", None, "1")]
    got = gr.build_threads(tweets(spark, rows), P).collect()
    assert sorted((r["tweet_id"], r["text"]) for r in got) == [("1", "new"), ("2", "t")]


def test_histogram_keeps_empty_classes(spark):
    sizes = spark.createDataFrame([(f"c{n}", i) for n in (1, 2, 9, 25) for i in range(n)], "conversation_id string, i int").withColumn("role", F.lit("brand"))
    got = table(gr.thread_length_histogram(sizes), "length")
    assert {k: v["conversations"] for k, v in got.items()} == {"1": 1, "2": 1, "3": 0, "4": 0, "5-9": 1, "10-19": 0, "20+": 1}


def test_thread_depth_limit_is_reported_and_can_be_lifted(spark):
    rows = [(f"c{i:02d}", "u", i, "t", None, f"c{i - 1:02d}" if i else None) for i in range(30)]
    rows += [("x", "u", 50, "t", None, "y"), ("y", "u", 51, "t", None, "x")]  # a reply cycle
    df = tweets(spark, rows)
    assert one(gr.thread_depth_report(df, P)) == {"messages": 32, "placed": 21, "dropped": 11}
    deep = Params(brand=P.brand, max_thread_depth=None)
    assert one(gr.thread_depth_report(df, deep)) == {"messages": 32, "placed": 30, "dropped": 2}
    assert gr.build_threads(df, deep).agg(F.max("depth")).first()[0] == 29
