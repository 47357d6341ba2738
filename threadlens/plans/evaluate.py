"""Evaluation run: three systems on labelled messages, rubric scores, agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators import evaluation as ev
from threadlens.operators import retrieval as rt
from threadlens.operators.judging import dimension_ranking, judge_replies, judge_summary
from threadlens.params import Params
from threadlens.plans.scoring import Scorer, score_messages


def predict_all(golden: DataFrame, corpus: DataFrame, scorer: Scorer, p: Params) -> DataFrame:
    """Wide prediction table: constant and nearest-neighbour baselines, full system.

    ``golden`` has conversation_id, customer_text, primary_intent, escalation and
    brand_reply; ``corpus`` (doc_id, text, label, reply) serves the neighbour
    baseline.
    """
    queries = golden.select(F.col("conversation_id").alias("query_id"), F.col("customer_text").alias("text"))

    def prefixed(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            F.col("query_id").alias("conversation_id"),
            F.col("predicted_intent").alias(f"{prefix}_intent"),
            F.col("confidence").alias(f"{prefix}_confidence"),
            F.col("escalation_decision").alias(f"{prefix}_escalation"),
            F.col("generated_reply").alias(f"{prefix}_reply"),
        )

    scored = score_messages(queries.withColumnRenamed("query_id", "doc_id"), scorer)
    base = golden.select(
        "conversation_id",
        "customer_text",
        F.col("primary_intent").alias("true_intent"),
        F.col("escalation").alias("true_escalation"),
        F.col("brand_reply").alias("reference_reply"),
    )
    return (
        base.join(prefixed(rt.constant_baseline(queries, p), "b1"), "conversation_id")
        .join(prefixed(rt.nearest_baseline(queries, corpus, p), "b2"), "conversation_id")
        .join(prefixed(scored.withColumnRenamed("doc_id", "query_id"), "agent"), "conversation_id")
    )


def evaluate(predictions: DataFrame) -> dict[str, DataFrame]:
    """Metric tables of a wide prediction table."""
    long = ev.long_predictions(predictions)
    return {
        "intent_metrics": ev.intent_metrics(long, "true_intent", "pred_intent", ["system"]),
        "escalation_metrics": ev.escalation_metrics(
            long, "true_escalation", "pred_escalation", ["system"]
        ),
        "confusion_matrix": ev.confusion_matrix(predictions, "true_intent", "agent_intent"),
        "comparison": ev.system_comparison(predictions),
        "failures": ev.failure_cases(predictions),
    }


def judge(predictions: DataFrame, human: DataFrame | None, p: Params) -> dict[str, DataFrame]:
    """Rubric scores of the full system's replies, and agreement with human scores."""
    judged = judge_replies(predictions, p, "agent_reply")
    out = {
        "judged": judged,
        "summary": judge_summary(judged),
        "ranking": dimension_ranking(judged),
    }
    if human is not None:
        pairs = ev.paired_scores(human, judged)
        out["agreement_by_dimension"] = ev.agreement_by_dimension(pairs)
        out["cohen_kappa"] = ev.cohen_kappa(pairs)
        out["agreement_overall"] = ev.agreement_overall(pairs)
        out["agreement_matrix"] = ev.agreement_matrix(pairs)
        out["score_histogram"] = ev.score_histogram(pairs)
    return out
