"""Hot groups must give the same results as windows, whatever the bound."""

import random

import pytest
from pyspark.sql import functions as F

from threadlens.operators import ordering as od


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(400):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(60)}"
        data.append((f"t{i:04d}", key, rng.randrange(50), rng.choice("ab")))
    data.append(("tx", None, 1, "a"))
    return spark.createDataFrame(data, "id string, k string, ts int, role string").repartition(5)


def collected(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_numbered_is_a_dense_total_order(rows):
    got = od.numbered(rows, ["ts", "id"], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(401))
    assert [(r["ts"], r["id"]) for r in got] == sorted((r["ts"], r["id"]) for r in got)


@pytest.mark.parametrize("bound", [5, 50])
def test_sequence_and_previous(rows, bound):
    plain, hot = od.find_hot_groups(rows, "k", 10**6), od.find_hot_groups(rows, "k", bound)
    assert plain.table is None and hot.table is not None
    order = ["ts", "id"]
    a = od.with_sequence(rows, "k", order, plain)
    b = od.with_sequence(rows, "k", order, hot)
    assert collected(a, "id", "seq") == collected(b, "id", "seq")
    a = od.with_previous(rows, "k", order, "role", plain, lags=2)
    b = od.with_previous(rows, "k", order, "role", hot, lags=2)
    assert collected(a, "id", "prev1", "prev2") == collected(b, "id", "prev1", "prev2")


@pytest.mark.parametrize("bound", [5, 50])
def test_group_filters_and_joins(rows, bound):
    plain, hot = od.find_hot_groups(rows, "k", 10**6), od.find_hot_groups(rows, "k", bound)
    for min_rows in (2, 6, 1000):
        a = od.drop_short_groups(rows, "k", min_rows, plain)
        b = od.drop_short_groups(rows, "k", min_rows, hot)
        assert collected(a, "id") == collected(b, "id")
    totals = rows.filter("k IS NOT NULL").groupBy("k").agg(F.sum("ts").alias("s"))
    a = od.join_groups(rows, totals, "k", "id", plain)
    b = od.join_groups(rows, totals, "k", "id", hot)
    assert collected(a, "id", "s") == collected(b, "id", "s")
    assert b.count() == 400


def test_first_per_key_prunes_before_the_shuffle(rows):
    first = od.first_per_key(rows, ["k"], od.nulls_last(["ts", "id"]))
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r["ts"], r["id"])):
        want.setdefault(r["k"], r["id"])
    assert {r["k"]: r["id"] for r in first.collect()} == want
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
