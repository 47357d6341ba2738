from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.fixtures import P, SUPPORT_ROWS, one, tweets
from threadlens.operators.profile import null_report, profile_raw
from threadlens.plans.preprocess import export, preprocess
from threadlens.sources import readers, writers
from threadlens.sources.schemas import require_columns
from threadlens.sources.tables import materialize

CSV = '''tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id
007,AcmeSupport,False,Tue Oct 31 22:10:47 +0000 2017,"Hi, ""you""
there",8,
8,ann,True,2017-10-31 22:11:45,  spaced  ,"9, 10",007
9,bob,maybe,not a date,x,,8
'''


def test_raw_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV, encoding="utf-8")
    rows = {r["tweet_id"]: r for r in readers.scan_messages(spark, str(path)).withColumn("sec", F.unix_seconds("created_at")).collect()}
    assert set(rows) == {"007", "8", "9"} and rows["007"]["text"] == 'Hi, "you"\nthere'
    assert rows["007"]["sec"] == int(datetime(2017, 10, 31, 22, 10, 47, tzinfo=timezone.utc).timestamp())
    assert [rows[k]["inbound"] for k in ("007", "8", "9")] == [False, True, None]
    assert rows["9"]["sec"] is None and rows["8"]["response_tweet_id"] == "9, 10"
    (tmp_path / "bad.csv").write_text("tweet_id,text\n1,a\n")
    with pytest.raises(ValueError, match="in_response_to_tweet_id"):
        readers.scan_messages(spark, str(tmp_path / "bad.csv"))


def test_profile(spark):
    df = tweets(spark, SUPPORT_ROWS)
    got = one(profile_raw(df))
    assert (got["total_rows"], got["inbound_rows"], got["unique_authors"], got["null_response_tweet_id"]) == (8, 4, 6, 4)
    assert {r["column_name"]: r["null_pct"] for r in null_report(df).collect()}["response_tweet_id"] == 50.0


@pytest.mark.parametrize(
    "document, want",
    [
        ('["a", "b"]', ["a", "b"]),
        ('[{"id": 1, "text": "a"}, {"text": "b"}, {"id": 3}]', ["a", "b", ""]),
        ('{"messages": ["a", {"text": "b"}]}', ["a", "b"]),
        ('["{not json", "[x]"]', ["{not json", "[x]"]),
    ],
)
def test_batch_json_layouts(spark, tmp_path, document, want):
    (tmp_path / "m.json").write_text(document, encoding="utf-8")
    got = readers.scan_message_json(spark, str(tmp_path / "m.json")).orderBy("position").collect()
    assert [r["text"] for r in got] == want


def test_annotation_progress(spark, tmp_path):
    path = str(tmp_path / "progress")
    assert readers.scan_annotations(spark, path).count() == 0
    row = spark.createDataFrame([("c1", "order_status", "True", "none", "high", 'a "note", ok', "2024")], "conversation_id string, primary_intent string, escalation string, escalation_reason string, confidence string, annotator_notes string, annotated_at string")
    for batch in ("first", "second", "second"):
        writers.append_annotations(row, path, batch)
    back = readers.scan_annotations(spark, path)
    assert back.count() == 2 and back.first()["annotator_notes"] == 'a "note", ok'
    assert back.columns == [*row.columns, "row_id"]


def test_fallbacks(spark):
    a, empty = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([], "x int")
    assert readers.with_fallback(None, empty, a).count() == 1
    with pytest.raises(ValueError):
        readers.with_fallback(empty, None)
    assert readers.training_table(spark, None, None).count() == 60
    golden = spark.createDataFrame([(f"c{i}", "text", "order_status") for i in range(10)], "conversation_id string, customer_text string, primary_intent string")
    assert readers.training_table(spark, golden, None).count() == 10
    few = readers.training_table(spark, golden.limit(9), None)
    assert few.count() == 60 and {r["source"] for r in few.collect()} == {"starter"}
    assert readers.training_table(spark, golden.limit(9), None, min_records=9).count() == 9


def test_training_rule_counts_golden_records_before_the_join(spark):
    golden = spark.createDataFrame([(f"c{i}", "order_status") for i in range(12)], "conversation_id string, primary_intent string")
    talks = spark.createDataFrame([(f"c{i}", "hello", 0) for i in range(6)], "conversation_id string, opening_message string, part int")
    rows = readers.training_table(spark, golden, talks).collect()
    assert len(rows) == 6 and {(r["text"], r["source"]) for r in rows} == {("hello", "conversations")}


def test_preprocess_end_to_end(spark, tmp_path):
    result = preprocess(tweets(spark, SUPPORT_ROWS), P)
    assert result.messages.count() == 6 and result.conversations.count() == 2
    summary = one(result.summary)
    assert (summary["raw_total_rows"], summary["final_total_messages"], summary["retention_rate"]) == (8, 6, 75.0)
    assert summary["removed_duplicates"] == 0 and summary["std_length"] == 1.41
    export(result, str(tmp_path / "out"))
    back = readers.scan_processed(spark, str(tmp_path / "out/processed_conversations"))
    assert back.columns[:4] == ["conversation_id", "tweet_id", "author_id", "role"] and back.count() == 6
    assert readers.scan_conversations(spark, str(tmp_path / "out/annotation_ready")).count() == 2
    assert '"final_total_messages":6' in spark.read.text(str(tmp_path / "out/preprocessing_summary")).first()[0]
    writers.write_processed(result.messages, str(tmp_path / "m.csv"), "csv")
    assert readers.scan_processed(spark, str(tmp_path / "m.csv")).filter("created_at IS NOT NULL").count() == 6


def test_materialized_tables_live_in_the_shared_folder(spark):
    table = materialize(spark.range(3).toDF("x"), "probe")
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in table.inputFiles())
    with pytest.raises(ValueError):
        require_columns(table, ["y"])
