"""Tables bucketed by conversation: same rows, no shuffle by conversation."""

import re

import pytest
from pyspark.sql import functions as F

from threadlens import Params
from threadlens.operators import conversations as cv
from threadlens.operators import features as ft
from threadlens.operators import graph as gr
from threadlens.operators import signals as sg
from threadlens.operators.ordering import HotGroups, find_hot_groups
from threadlens.sources import bucketed
from threadlens.sources.tables import materialize, materialize_by

P = Params()
NO_HOT = HotGroups(None, 10**9)


def messages(spark):
    rows = [(f"conv_{i % 40 if i % 3 else 0:06d}", f"t{i:04d}", f"a{i % 7}", "brand" if i % 4 == 1 else "customer", i, f"text {i} not working") for i in range(600)]
    df = spark.createDataFrame(rows, "conversation_id string, tweet_id string, author_id string, role string, n int, text string")
    return df.withColumn("created_at", F.timestamp_seconds("n")).drop("n").repartition(5)


def shuffles(df, column="conversation_id") -> list[str]:
    """Keys of the shuffles in the plan before and after adaptive execution."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if k.startswith(column)]


@pytest.mark.parametrize("bound", [10**9, 50])
def test_rows_and_hot_conversations(spark, bound):
    df = messages(spark)
    table = bucketed.write_processed_buckets(df, "processed_buckets", 6, find_hot_groups(df, "conversation_id", bound))
    assert table.columns == ["conversation_id", "tweet_id", "author_id", "role", "created_at", "text"]
    assert bucketed.is_bucketed(spark, "processed_buckets") == 6
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, df.select(*table.columns).collect()))
    # written again the table has the rows once
    again = bucketed.write_processed_buckets(df.limit(10), "processed_buckets", 3)
    assert again.count() == 10 and bucketed.is_bucketed(spark, "processed_buckets") == 3
    with pytest.raises(ValueError):
        bucketed.write_processed_buckets(df, "a; drop", 3)


def test_conversation_operators_read_it_without_a_shuffle(spark):
    df = messages(spark)
    table = bucketed.write_processed_buckets(df, "shuffle_free", 6)
    for operator in (
        gr.thread_stats,
        lambda m: cv.role_switches(m, P, NO_HOT),
        lambda m: sg.conversation_signals(m, P, NO_HOT),
    ):
        plain, lying = operator(df), operator(table)
        assert shuffles(plain) and shuffles(lying) == []
        assert sorted(map(tuple, lying.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_term_weights_of_bucketed_counts_need_no_shuffle_by_document(spark):
    docs = spark.createDataFrame([(i, f"late parcel {i % 5} refund {'late ' * (i % 3)}") for i in range(60)], "doc_id bigint, text string")
    plain = materialize(ft.doc_terms(docs), "terms")
    lying = materialize_by(ft.doc_terms(docs), "doc_id", "terms")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, lying.collect()))
    vocab = ft.fit(lying, 60, 50, sublinear=True, index=True)
    key = lambda df: sorted(map(str, df.collect()))
    for make in (ft.weights, ft.sparse_rows):
        one, two = make(plain, vocab), make(lying, vocab)
        assert key(one.select(*[F.round(c, 9) if c == "weight" else c for c in one.columns if c != "values"])) == (
            key(two.select(*[F.round(c, 9) if c == "weight" else c for c in two.columns if c != "values"]))
        )
        assert shuffles(one, "doc_id") and shuffles(two, "doc_id") == []
