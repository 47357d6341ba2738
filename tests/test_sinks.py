"""Append tables under retries, order of their rows, and the result files."""

from datetime import datetime

import pytest

from tests.fixtures import P, SUPPORT_ROWS, tweets
from threadlens.operators import conversations as cv
from threadlens.plans import results
from threadlens.plans.preprocess import preprocess
from threadlens.sources import readers, writers
from threadlens.sources.schemas import ANNOTATION_COLUMNS


def records(spark, ids, note="n"):
    rows = [(f"c{i}", "order_status", "False", "none", "high", f'{note} "{i}",\nnext line', str(i)) for i in ids]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ANNOTATION_COLUMNS))


def test_a_batch_that_is_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "log")
    writers.append_batch(spark.range(0, 5).toDF("x"), path, "b-1")
    writers.append_batch(spark.range(5, 9).toDF("x"), path, "b_2")
    kept = {f for f in spark.read.parquet(path).inputFiles() if "b-1" in f}
    writers.append_batch(spark.range(5, 8).toDF("x"), path, "b_2")
    got = {(r.x, r.batch) for r in readers.scan_log(spark, path, ["x"]).collect()}
    assert got == {(i, "b-1" if i < 5 else "b_2") for i in range(8)}
    # other batches keep their files
    assert kept == {f for f in spark.read.parquet(path).inputFiles() if "b-1" in f}
    writers.append_batch(spark.range(0).toDF("x"), path, "b_2")
    assert {r.batch for r in readers.scan_log(spark, path, ["x"]).collect()} == {"b-1"}
    for name in ("", "a/b", "x y", "b=1"):
        with pytest.raises(ValueError):
            writers.append_batch(spark.range(1).toDF("x"), path, name)


def test_audit_batches(spark, tmp_path):
    path, at = str(tmp_path / "audit"), datetime(2024, 5, 6)
    rows = spark.createDataFrame([("m1", "refund"), ("m2", None)], "message_id string, intent string")
    for _ in range(2):
        writers.append_audit(rows, path, "run-1", at)
    writers.append_audit(rows.limit(1), path, "run-2")
    got = readers.scan_log(spark, path, ["message_id", "intent", "logged_at"]).collect()
    assert sorted((r.message_id, r.batch) for r in got) == [("m1", "run-1"), ("m1", "run-2"), ("m2", "run-1")]
    assert {r.logged_at for r in got if r.batch == "run-1"} == {at}


def test_row_numbers_do_not_depend_on_packing(spark, tmp_path):
    path = str(tmp_path / "progress")
    for k, batch in enumerate(("z-first", "a-second", "m-third")):
        writers.append_annotations(records(spark, range(k * 40, k * 40 + 40)).coalesce(1), path, batch)
    seen = []
    for size in ("128m", "2k", "300"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = readers.scan_annotations(spark, path).collect()
        seen.append(sorted((r.row_id, r.conversation_id, r.annotator_notes) for r in rows))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] == seen[1] == seen[2]
    # in the order of writing, whatever the batches are called
    assert [(i, f"c{i}") for i in range(120)] == [r[:2] for r in seen[0]]


def test_result_files(spark, tmp_path):
    out = str(tmp_path / "out")
    run = preprocess(tweets(spark, SUPPORT_ROWS), P)
    results.export_overview(run.messages, P, out)
    counts = cv.overview_counts(run.messages)
    back = readers.scan_json(spark, f"{out}/overview_counts", counts.schema)
    assert back.collect() == counts.collect()
    assert len(readers.scan_json(spark, f"{out}/turn_structure", cv.turn_structure(run.messages).schema).collect()) == 1
    golden = records(spark, [3, 1, 2]).unionByName(records(spark, [1], "later").withColumn("annotated_at", writers.F.lit("9")))
    results.export_golden(golden.withColumn("row_id", writers.F.monotonically_increasing_id()), out)
    rows = readers.scan_annotations(spark, f"{out}/golden").orderBy("row_id").collect()
    assert [r.conversation_id for r in rows] == ["c1", "c2", "c3"] and rows[0].annotator_notes.startswith("later")


def test_evaluation_files(spark, tmp_path):
    out = str(tmp_path / "out")
    row = {"conversation_id": "c1", "customer_text": 'my "card", twice', "true_intent": "billing_issue", "true_escalation": "True", "reference_reply": "ok"}
    for system in ("b1", "b2", "agent"):
        row |= {f"{system}_intent": "billing_issue", f"{system}_confidence": 0.5, f"{system}_escalation": "ESCALATE", f"{system}_reply": "We are sorry, please DM us"}
    predictions = spark.createDataFrame([row])
    results.export_evaluation(predictions, None, P, out)
    assert readers.read_csv(spark, f"{out}/predictions").first()["customer_text"] == 'my "card", twice'
    comparison = spark.read.json(f"{out}/evaluation/comparison").collect()
    assert {r.system: r.intent_accuracy for r in comparison} == {"baseline_1_trivial": 1.0, "baseline_2_simple": 1.0, "ai_agent_final": 1.0}
    assert spark.read.json(f"{out}/judge/summary").first()["total_replies_judged"] == 1
    assert not (tmp_path / "out/judge/cohen_kappa").exists()
