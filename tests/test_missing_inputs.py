"""Inputs that are absent or empty, and number and time texts."""

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from threadlens import Params
from threadlens.functions import text as tx
from threadlens.operators import language as lg
from threadlens.operators import retrieval as rt
from threadlens.plans import results, scoring
from threadlens.sources import readers, writers
from threadlens.sources.schemas import ANNOTATION_COLUMNS

P = Params(brand_handle="@Acme")


def test_validation_of_a_file_that_is_not_there(spark, tmp_path):
    path = str(tmp_path / "none")
    missing = results.validate_file(spark, path, P).first()
    assert (missing.is_valid, missing.total_records, missing.error) == (False, 0, f"File not found: {path}")
    row = spark.createDataFrame([("c1", "order_status", "False", "none", "high", "", "1")], ", ".join(f"{c} string" for c in ANNOTATION_COLUMNS))
    more = spark.createDataFrame([("c2", "billing_issue", "False", "none", "high", "", "1")], row.schema)
    writers.append_annotations(row.unionByName(more), path, "b1")
    found = results.validate_file(spark, path, P)
    assert found.columns == results.validate_file(spark, path + "x", P).columns
    found = found.first()
    assert (found.total_records, found.error, found.intents) == (2, None, "billing_issue=1, order_status=1")


def test_nearest_baseline_without_a_corpus(spark):
    asked = spark.createDataFrame([(1, "I will sue you"), (2, " ")], "query_id bigint, text string")
    corpus = spark.createDataFrame([], "doc_id bigint, text string, label string, reply string")
    got = rt.nearest_baseline(asked, corpus, P).orderBy("query_id").collect()
    want = rt.constant_baseline(asked, P).orderBy("query_id").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_numbers_and_times_as_text(spark):
    rows = [(1234567, 1234.5, Decimal("9999.999"), datetime(2024, 2, 3, 4, 5, 6, 789, tzinfo=timezone.utc)), (None, None, None, None)]
    df = spark.createDataFrame(rows, "n bigint, x double, d decimal(10,3), at timestamp")
    got = df.select(*[tx.grouped_number(F.col(c)) for c in "nxd"], tx.utc_iso(F.col("at"))).collect()
    assert tuple(got[0]) == ("1,234,567", "1,234.50", "10,000.00", "2024-02-03T04:05:06.000789+00:00")
    assert tuple(got[1]) == (None,) * 4


def test_emoji_usage_in_one_pass(spark):
    texts = ["🙂🙂 fine 🚚", "none", None, "🚚", ""]
    df = spark.createDataFrame([("customer", t) for t in texts] + [("brand", "🔥")], "role string, text string")
    got = lg.emoji_usage(df).first()
    assert (got.messages_with_emoji, got.total_unique_emojis) == (2, 2)
    none = lg.emoji_usage(df.filter("role = 'nobody'")).first()
    assert tuple(none) == (0, 0.0, 0)


def test_evaluation_and_evidence_sources(spark):
    p = Params(brand="Acme", brand_handle="@Acme")
    sources = lambda df: {r.source for r in df.collect()}
    golden = spark.createDataFrame([("c1", "order_status", "True", "own text")], "conversation_id string, primary_intent string, escalation string, customer_text string")
    talks = spark.createDataFrame([("c1", "opening", "[CUSTOMER] opening\n[BRAND] we help", 0)], "conversation_id string, opening_message string, full_conversation string, part int")
    table = readers.evaluation_table(spark, golden, talks)
    assert [tuple(r) for r in table.collect()] == [("c1", "opening", "order_status", "True", "conversations")]
    other = talks.withColumn("conversation_id", F.lit("c9"))
    assert readers.evaluation_table(spark, golden, other).first()[1:] == ("own text", "order_status", "True", "golden")
    for none in (None, golden.limit(0), golden.drop("primary_intent")):
        assert sources(readers.evaluation_table(spark, none, talks)) == {"starter"}
    assert readers.evaluation_table(spark, None, None).count() == 30
    messages = spark.createDataFrame(
        [("c1", "1", "customer", 1, "hello"), ("c1", "2", "brand", 2, "hi"), ("c2", "3", "customer", 3, "alone")],
        "conversation_id string, tweet_id string, role string, created_at int, text string",
    )
    found = readers.evidence_table(spark, talks.drop("part"), messages, p)
    assert [tuple(r) for r in found.collect()] == [("c1", "opening", "we help", "index")]
    plain = talks.selectExpr("conversation_id", "'q' AS customer_text", "'a' AS brand_reply")
    assert sources(readers.evidence_table(spark, plain, messages, p)) == {"index"}
    assert [tuple(r) for r in readers.evidence_table(spark, None, messages, p).collect()] == [("c1", "hello", "hi", "messages")]
    for index, rows in ((None, None), (plain.limit(0), messages.filter("role = 'brand'"))):
        assert sources(readers.evidence_table(spark, index, rows, p)) == {"starter"}


def test_scorer_from_built_in_rows(spark):
    scorer = scoring.scorer_from_sources(spark, None, None, None, P)
    asked = readers.evaluation_table(spark, None, None).selectExpr("conversation_id AS doc_id", "customer_text AS text")
    scored = scoring.score_messages(asked, scorer).collect()
    assert len(scored) == 30 and all(r.generated_reply for r in scored)
