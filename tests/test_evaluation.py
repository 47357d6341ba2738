import math

import pytest

from tests.fixtures import one, table
from threadlens.operators import evaluation as ev
from threadlens.params import SCORE_DIMENSIONS


def labels(spark, pairs):
    return spark.createDataFrame([(str(i), t, p) for i, (t, p) in enumerate(pairs)], "id string, t string, p string")


def test_intent_metrics(spark):
    df = labels(spark, [("order_status", "order_status"), ("order_status", "refund_request"), ("refund_request", "refund_request"), ("account_access", "account_access")])
    got = one(ev.intent_metrics(df, "t", "p"))
    assert (got["accuracy"], got["precision_macro"], got["recall_macro"], got["f1_macro"]) == (0.75, 0.8333, 0.8333, 0.7778)
    assert (got["precision_weighted"], got["recall_weighted"], got["f1_weighted"]) == (0.875, 0.75, 0.75)
    assert (got["total_samples"], got["classes"]) == (4, 3)
    cells = {(r["true_label"], r["pred_label"]): r["count"] for r in ev.confusion_matrix(df, "t", "p").collect()}
    names = ["account_access", "order_status", "refund_request"]
    assert [[cells[a, b] for b in names] for a in names] == [[1, 0, 0], [0, 1, 1], [0, 0, 1]]
    empty = one(ev.intent_metrics(df.filter("false"), "t", "p"))
    assert empty["accuracy"] == 0.0 and empty["total_samples"] == 0


def test_labels_never_predicted_count_as_zero(spark):
    got = table(ev.per_class_metrics(labels(spark, [("a", "b"), ("a", "a")]), "t", "p"), "label")
    assert (got["b"]["support"], got["b"]["recall"], got["b"]["precision"], got["b"]["f1"]) == (0, 0.0, 0.0, 0.0)


def test_escalation_metrics(spark):
    got = one(ev.escalation_metrics(labels(spark, [("True", "ESCALATE"), ("True", "AUTO_HANDLE"), ("no", "yes"), (None, "0")]), "t", "p"))
    assert [got[k] for k in ("tp", "fn", "fp", "tn")] == [1, 1, 1, 1]
    assert (got["accuracy"], got["f1"], got["false_positive_rate"], got["false_negative_rate"]) == (0.5, 0.5, 0.5, 0.5)
    none = one(ev.escalation_metrics(labels(spark, [("no", "no")]), "t", "p"))
    assert (none["precision"], none["recall"], none["f1"], none["false_negative_rate"]) == (0.0, 0.0, 0.0, 0.0)


def rated(spark, human, judge):
    """The same scores in every dimension."""
    h = spark.createDataFrame([(str(i), *[x] * 5, float(x)) for i, x in enumerate(human)], "conversation_id string, " + ", ".join(f"human_{d} int" for d in SCORE_DIMENSIONS) + ", human_overall double")
    j = spark.createDataFrame([(str(i), *[x] * 5, float(x)) for i, x in enumerate(judge)], "conversation_id string, " + ", ".join(f"{d} int" for d in SCORE_DIMENSIONS) + ", overall_score double")
    return ev.paired_scores(h, j)


@pytest.mark.parametrize(
    "human, judge, plain, quadratic",
    [
        ([5, 3, 5, 4], [5, 3, 4, 4], 0.6364, 0.8),
        ([5, 3, 5, 3], [5, 3, 3, 3], 0.5, 0.5),
        ([1, 2, 5, 5], [1, 5, 5, 2], 0.2, 0.6364),
        ([4, 5], [5, 5], 0.0, 0.0),
        ([5, 5], [5, 5], math.nan, math.nan),
    ],
)
def test_kappa(spark, human, judge, plain, quadratic):
    got = table(ev.cohen_kappa(rated(spark, human, judge)), "dimension")["empathy"]
    assert got["cohen_kappa_unweighted"] == pytest.approx(plain, nan_ok=True)
    assert got["cohen_kappa_quadratic"] == pytest.approx(quadratic, nan_ok=True)


def test_agreement(spark):
    pairs = rated(spark, [4, 5, 1], [5, 5, 4])
    got = table(ev.agreement_by_dimension(pairs), "dimension")["correctness"]
    assert (got["exact_match_pct"], got["within_1_pct"], got["mae"], got["mean_score_difference"]) == (33.33, 66.67, 1.3333, 1.3333)
    overall = one(ev.agreement_overall(pairs))
    assert (overall["sample_count"], overall["overall_exact_match_pct"], overall["overall_within_1_pct"]) == (3, 33.33, 66.67)
    cells = {(r["human"], r["judge"]): r["count"] for r in ev.agreement_matrix(pairs).collect()}
    assert len(cells) == 25 and sum(cells.values()) == 3 and cells[4, 5] == 1
    bins = {(r["rater"], r["bin"]): r["count"] for r in ev.score_histogram(pairs).collect()}
    assert len(bins) == 16 and bins["human", 7] == 1 and bins["judge", 7] == 2 and bins["human", 0] == 1
    assert ev.paired_scores(pairs.select("conversation_id"), pairs.filter("false").select("conversation_id")).count() == 0


def wide(spark, rows):
    schema = "conversation_id string, customer_text string, true_intent string, true_escalation boolean, agent_intent string, agent_escalation string, b1_intent string, b1_escalation string, b2_intent string, b2_escalation string"
    return spark.createDataFrame([(f"c{i}", "text", *r, "a", "AUTO_HANDLE", "b", "ESCALATE") for i, r in enumerate(rows)], schema)


def test_failures_and_comparison(spark):
    df = wide(spark, [("a", True, "a", "ESCALATE"), ("a", True, "b", "AUTO_HANDLE"), ("b", False, "b", "ESCALATE"), ("b", True, "a", "AUTO_HANDLE"), ("a", False, "b", "AUTO_HANDLE")])
    cases = ev.failure_cases(df).collect()
    assert [(c["category"].split()[0], c["conversation_id"]) for c in cases] == [("Escalation", "c1"), ("Escalation", "c2"), ("Intent", "c1"), ("Intent", "c3")]
    assert cases[0]["expected_output"] == "Intent: `a`, Escalation: `ESCALATE`"
    got = table(ev.system_comparison(df), "system")
    assert len(got) == 3 and got["baseline_1_trivial"]["intent_accuracy"] == 0.6 and got["baseline_2_simple"]["false_positive_rate"] == 1.0
