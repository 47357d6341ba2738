"""Registered queries: keys, reference SQL on the smallest tables, scoring run."""

import dataclasses
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog import adapter as ad
from catalog import queries as Q
from threadlens.plans.evaluate import evaluate, judge
from threadlens.plans.scoring import Scorer, fit_scorer, score_messages
from threadlens.sources import seeds

QUICK = [
    "profile_raw", "reply_edges", "build_threads_events", "brand_conversations_events", "clean_text",
    "quality_filtered", "quality_removals", "conversation_table", "conversation_signals", "role_switches",
    "preprocess_conversations", "cleaning_samples", "text_length_stats", "top_bigrams", "retrieve_topk", "dense_topk", "escalation_decisions",
    "build_judge_prompt", "parse_judge_json", "annotation_validation", "system_comparison", "cohen_kappa",
]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in ("conversations", "documents", "benchmark", "labels", "embeddings", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    fix = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v + 0.0 if isinstance(v, float) else v)
    return sorted(tuple(fix(r[i]) for i in order) for r in rows)


def test_keys():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and set(Q.QUERIES) <= set(queries)
    unchecked = set(Q.QUERIES) - set(oracles)
    assert unchecked == {
        "train_classifier", "classify_messages", "theme_clusters", "theme_terms",
        "theme_examples", "score_messages", "inference_json", "predictions"}


@pytest.mark.parametrize("name", QUICK)
def test_reference_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.collect(), df.columns) == canonical(result.fetchall(), columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "conversation_id" and df.count() > 0


def test_scoring_run(spark, sf):
    p = ad.PARAMS
    training = seeds.training_rows(spark).select(F.col("conversation_id").alias("doc_id"), "text", F.col("primary_intent").alias("label"))
    evidence = seeds.evidence_rows(spark).withColumnRenamed("conversation_id", "doc_id")
    scorer = fit_scorer(training, evidence, p)
    incoming = seeds.evaluation_rows(spark).select(F.col("conversation_id").alias("doc_id"), F.col("customer_text").alias("text"))
    incoming = incoming.union(spark.createDataFrame([("blank", "  ")], "doc_id string, text string"))
    scored = score_messages(incoming, scorer).collect()
    assert sorted(r["doc_id"] for r in scored) == sorted([f"eval_{i:03d}" for i in range(30)] + ["blank"])
    blank = next(r for r in scored if r["doc_id"] == "blank")
    assert blank["evidence"] is None and blank["predicted_intent"] == "general_inquiry" and blank["escalation_decision"] == "AUTO_HANDLE"
    for r in scored:
        if r["evidence"]:
            scores = [e["similarity_score"] for e in r["evidence"]]
            assert len(scores) == p.top_k and scores == sorted(scores, reverse=True)
    # every part can be replaced
    other = Scorer(
        classify=lambda m: m.select("doc_id", F.lit("order_status").alias("predicted_intent"), F.lit(0.99).alias("confidence")),
        retrieve=scorer.retrieve, decide=scorer.decide, reply=scorer.reply,
    )
    assert {r["predicted_intent"] for r in score_messages(incoming, other).collect()} == {"order_status"}


def test_evaluation_run(spark, sf):
    wide = Q.predictions(spark, sf)
    assert len(wide.columns) == 17 and wide.count() == wide.select("conversation_id").distinct().count() > 0
    assert evaluate(wide)["comparison"].count() == 3
    human = wide.select("conversation_id", *[F.lit(4).alias(f"human_{d}") for d in ad.DIMENSIONS], F.lit(4.0).alias("human_overall"))
    tables = judge(wide, human, ad.PARAMS)
    assert tables["agreement_by_dimension"].count() == 5 and tables["judged"].count() == wide.count()


@pytest.mark.parametrize("name", ["conversation_table", "conversation_signals", "role_switches", "build_threads_events"])
def test_hot_group_bound_does_not_change_results(spark, sf, monkeypatch, name):
    want = sorted(map(str, Q.QUERIES[name](spark, sf).collect()))
    small = dataclasses.replace(ad.PARAMS, hot_group_rows=3)
    monkeypatch.setattr(ad, "PARAMS", small)
    monkeypatch.setattr(Q, "P", small)
    assert sorted(map(str, Q.QUERIES[name](spark, sf).collect())) == want
