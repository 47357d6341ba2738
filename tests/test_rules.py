"""Escalation rules, replies, prompts, judging, annotations."""

import pytest
from pyspark.sql import functions as F

from tests.fixtures import P, one, table
from threadlens.functions import prompts
from threadlens.operators import annotations as an
from threadlens.operators import decisions as de
from threadlens.operators import judging as ju
from threadlens.params import REPLY_TEMPLATES
from threadlens.sources.schemas import human_score_errors

CASES = [
    ("Where is my order", "order_status", 0.92, "AUTO_HANDLE", 0.92, "High confidence intent 'order_status' eligible for automated response"),
    ("Something vague", "order_status", 0.40, "ESCALATE", 0.90, "Low intent classification confidence (0.40 < threshold 0.65)"),
    ("cannot sign in", "account_access", 0.95, "ESCALATE", 0.95, "Intent 'account_access' involves sensitive operations and requires human verification"),
    ("A lawsuit, an attorney and FRAUD", "general_inquiry", 0.90, "ESCALATE", 0.95, "Detected Payment Dispute escalation keyword: 'fraud'"),
    ("the cracked screen and my lawyer", "product_issue", 0.9, "ESCALATE", 0.95, "Detected Damaged Product escalation keyword: 'cracked screen'"),
    ("this is a scam, police!", "general_inquiry", 0.9, "ESCALATE", 0.98, "Detected high-risk legal/fraud term: 'scam'"),
    ("lawsuit", "billing_issue", 0.1, "ESCALATE", 0.90, "Low intent classification confidence (0.10 < threshold 0.65)"),
    ("fine", "order_status", 0.65, "AUTO_HANDLE", 0.65, "High confidence intent 'order_status' eligible for automated response"),
]


def test_escalation_rules(spark):
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "i int, text string, predicted_intent string, confidence double")
    got = table(de.decide(df, P), "i")
    for i, (*_, decision, score, reason) in enumerate(CASES):
        assert (got[i]["escalation_decision"], got[i]["escalation_confidence"], got[i]["escalation_reason"]) == (decision, score, reason)


EVIDENCE = "array<struct<customer_text:string,brand_reply:string,score:double>>"


def test_reply_and_prompts(spark):
    rows = [
        (0, "refund_request", [("c", "reuse me", 0.75), ("d", "no", 0.9)]),
        (1, "refund_request", [("c", "too far", 0.74)]),
        (2, "mystery", [("c", "", 0.99)]),
        (3, "mystery", None),
    ]
    df = spark.createDataFrame(rows, f"i int, intent string, ev {EVIDENCE}")
    got = [r["r"] for r in df.select("i", de.select_reply(F.col("intent"), F.col("ev"), P).alias("r")).orderBy("i").collect()]
    assert got == ["reuse me", REPLY_TEMPLATES["refund_request"], REPLY_TEMPLATES["general_inquiry"], REPLY_TEMPLATES["general_inquiry"]]
    text = [r["p"] for r in df.select("i", prompts.reply_prompt(F.lit("hi 100%"), F.col("intent"), F.col("ev"), "Acme", "@Acme").alias("p")).orderBy("i").collect()]
    assert 'Example 2 (Similarity: 0.90):\n  Customer: "d"\n  Brand Reply: "no"' in text[0] and '"hi 100%"' in text[0]
    assert "No specific historical resolution evidence retrieved." in text[3]
    judge = [r["p"] for r in df.select("i", prompts.judge_prompt(F.lit("m"), F.col("intent"), F.col("ev"), F.lit(None).cast("string"), F.lit("r"), "@Acme").alias("p")).orderBy("i").collect()]
    assert '- Ex 1: Customer: "c" | Brand: "too far"' in judge[1] and 'Ground Truth):\n"N/A"' in judge[1]
    assert prompts.rubric_text("@Acme").count("  Score ") == 25 and "official @Acme social" in judge[0]


def test_heuristic_judge(spark):
    replies = [("We apologize! Please DM us your details.",), ("Thank you, order noted.",), ("x",), ("y" * 281,), (None,)]
    got = ju.judge_replies(spark.createDataFrame(replies, "generated_reply string"), P).collect()
    dims = ["groundedness", "correctness", "empathy", "actionability", "brand_tone", "overall_score"]
    assert [tuple(r[d] for d in dims) for r in got] == [
        (5, 5, 5, 5, 5, 5.0), (4, 5, 4, 4, 5, 4.4), (4, 4, 3, 3, 5, 3.8), (4, 5, 3, 3, 4, 3.8), (4, 4, 3, 3, 5, 3.8)]


def test_score_validation(spark):
    ok = spark.createDataFrame([("5", "4", "3", "2", "1"), ("6", "x", None, " 3 ", "0")], "groundedness string, correctness string, empathy string, actionability string, brand_tone string")
    first, second = ju.validate_scores(ok).collect()
    assert first["errors"] == []
    assert second["errors"] == [
        "Score for 'groundedness' must be between 1 and 5 (got 6)",
        "Score for 'correctness' must be an integer (got x)",
        "Missing required dimension score: 'empathy'",
        "Score for 'brand_tone' must be between 1 and 5 (got 0)",
    ]
    assert "Missing required dimension score: 'brand_tone'" in ju.validate_scores(ok.drop("brand_tone")).first()["errors"]


def test_judge_json(spark):
    raw = ['```json\n{"groundedness": 2, "strengths": ["a", "b"]}\n```', '{"overall_score": 3.25, "empathy": 1, "weaknesses": ["w"]}', "oops", "{}"]
    got = ju.parse_judge_json(spark.createDataFrame([(r,) for r in raw], "raw string")).collect()
    assert [r["parsed"] for r in got] == [True, True, False, True]
    assert (got[0]["groundedness"], got[0]["correctness"], got[0]["overall_score"], got[0]["strengths"]) == (2, 4, 3.6, ["a", "b"])
    assert (got[1]["overall_score"], got[1]["empathy"], got[1]["weaknesses"]) == (3.25, 1, ["w"])
    assert got[3]["reasoning"] == "Evaluated against 5-dimension rubric." and got[3]["strengths"] == ["Grounded in evidence"]


SCHEMA = "row_id bigint, conversation_id string, primary_intent string, escalation string, escalation_reason string, confidence string, annotator_notes string, annotated_at string"


def records(spark, rows):
    full = [(i, c, intent, e, reason, conf, "", f"2024-01-01T00:00:{i:02d}") for i, (c, intent, e, reason, conf) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def test_annotation_validation(spark):
    good = records(spark, [("conv_1", "order_status", "False", "none", "high"), ("conv_2", "billing_issue", "True", "refund_payment", "medium")])
    result = one(an.annotation_validation(good, P))
    assert (result["is_valid"], result["total_records"], result["valid_records"], result["invalid_records"]) == (True, 2, 2, 0)
    assert result["warnings"] == "Only 2 valid records. Target is 150-250 for the golden dataset."
    bad = records(spark, [("", "order_status", "no", "none", "high"), ("a", "bogus", "yes", None, "low"), ("a", " ", "yes", "weird", None), (None, "order_status", "no", "weird", "high")])
    errors = {}
    for r in an.annotation_errors(bad).collect():
        errors.setdefault(r["row_id"], []).append(r["error"])
    assert errors[0] == errors[3] == ["conversation_id is empty"]
    assert errors[1][0].startswith("Invalid intent 'bogus'") and errors[1][1] == "escalation_reason is required when escalation is True"
    assert errors[2][0] == "primary_intent is empty" and errors[2][1].startswith("Invalid confidence ''") and errors[2][2].startswith("Invalid escalation_reason 'weird'")
    assert [(r["conversation_id"], r["records"], r["first_row"]) for r in an.duplicate_annotations(bad).collect()] == [("a", 2, 1)]
    duplicate = records(spark, [("a", "order_status", "no", "none", "high")] * 2)
    result = one(an.annotation_validation(duplicate, P))
    assert (result["is_valid"], result["valid_records"], result["duplicate_ids"]) == (False, 2, 1)


def test_golden_export(spark):
    df = records(spark, [
        ("conv_2", "refund_request", "no", "none", "high"),
        ("conv_1", "order_status", "no", "none", "high"),
        ("conv_1", "billing_issue", "yes", "bogus", "unsure"),
        ("conv_3", "order_status", "no", "none", "high"),
        ("conv_3", "unknown", "no", "none", "high"),
        (" ", "order_status", "no", "none", "high"),
    ]).repartition(3)
    got = [(r["conversation_id"], r["primary_intent"]) for r in an.golden_export(df).collect()]
    assert got == [("conv_1", "billing_issue"), ("conv_2", "refund_request")]
    assert an.golden_export(df).columns[0] == "conversation_id" and "row_id" not in an.golden_export(df).columns
    assert an.golden_export(df, validate_only=True) is None


def test_queue_and_human_schema(spark):
    conversations = spark.createDataFrame([(f"conv_{i}",) for i in range(5)], "conversation_id string")
    done = records(spark, [("conv_1", "order_status", "no", "none", "high"), (None, "order_status", "no", "none", "high")])
    assert [r[0] for r in an.annotation_queue(conversations, done).collect()] == ["conv_0", "conv_2", "conv_3", "conv_4"]
    assert [r[0] for r in an.annotation_queue(conversations, done, 2).collect()] == ["conv_0", "conv_2"]
    assert len(human_score_errors(conversations)) == 6


def test_audit_and_record(spark):
    df = spark.createDataFrame([("m1", 'say "no" ' + "z" * 50, "order_status", 0.876543, "ESCALATE", "why", "reply", [("order_status", 0.876543)])],
                               "doc_id string, text string, predicted_intent string, confidence double, escalation_decision string, escalation_reason string, generated_reply string, candidates array<struct<intent:string,prob:double>>")
    audit = one(de.audit_rows(df))
    assert audit["conf"] == 0.88 and audit["msg"] == "say 'no' " + "z" * 31 + "..."
    ev = df.withColumn("evidence", F.expr("cast(null as array<struct<rank:int,conversation_id:string,customer_text:string,brand_reply:string,similarity_score:double,score:double>>)"))
    record = one(de.scoring_record(ev))["record"]
    assert '"confidence":0.8765' in record and '"retrieved_examples":[]' in record
