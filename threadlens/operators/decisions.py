"""Escalation rules, reply selection and the batch scoring record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens import params as P
from threadlens.functions import text as tx


def escalation_rules(message: Column, intent: Column, confidence: Column, p: P.Params) -> Column:
    """Struct (decision, confidence, reason) of the first rule that applies.

    Order: low confidence, sensitive intent, trigger keywords in table order,
    high-risk terms, otherwise automatic handling.
    """
    low = F.lower(message)

    def outcome(decision: str, score: Column, reason: Column) -> Column:
        return F.struct(
            F.lit(decision).alias("decision"), score.alias("confidence"), reason.alias("reason")
        )

    threshold = F.lit(p.confidence_threshold)
    rules = F.when(
        confidence < threshold,
        outcome(
            "ESCALATE",
            F.lit(0.90),
            F.format_string(
                "Low intent classification confidence (%.2f < threshold %.2f)", confidence, threshold
            ),
        ),
    ).when(
        intent.isin(p.sensitive_intents),
        outcome(
            "ESCALATE",
            F.lit(0.95),
            F.format_string(
                "Intent '%s' involves sensitive operations and requires human verification", intent
            ),
        ),
    )
    for category, keywords in p.trigger_keywords.items():
        for keyword in keywords:
            reason = f"Detected {tx.title_of(category)} escalation keyword: '{keyword}'"
            rules = rules.when(
                F.contains(low, F.lit(keyword.lower())),
                outcome("ESCALATE", F.lit(0.95), F.lit(reason)),
            )
    for term in P.HIGH_RISK_TERMS:
        reason = f"Detected high-risk legal/fraud term: '{term}'"
        rules = rules.when(
            F.contains(low, F.lit(term)), outcome("ESCALATE", F.lit(0.98), F.lit(reason))
        )
    return rules.otherwise(
        outcome(
            "AUTO_HANDLE",
            F.round(confidence, 2),
            F.format_string("High confidence intent '%s' eligible for automated response", intent),
        )
    )


def decide(scored: DataFrame, p: P.Params, message: str = "text") -> DataFrame:
    """Add decision columns to rows with a message, predicted_intent and confidence."""
    rule = escalation_rules(
        F.col(message), F.col("predicted_intent"), F.col("confidence"), p
    )
    return (
        scored.withColumn("_d", rule)
        .withColumns(
            {
                "escalation_decision": F.col("_d.decision"),
                "escalation_confidence": F.round("_d.confidence", 4),
                "escalation_reason": F.col("_d.reason"),
            }
        )
        .drop("_d")
    )


def template_reply(intent: Column) -> Column:
    """The stock reply for an intent; unknown intents get the general one."""
    templates = F.create_map(*[F.lit(x) for pair in P.REPLY_TEMPLATES.items() for x in pair])
    return F.coalesce(
        F.try_element_at(templates, intent), F.lit(P.REPLY_TEMPLATES["general_inquiry"])
    )


def select_reply(intent: Column, evidence: Column, p: P.Params) -> Column:
    """Reply of the best evidence when it is close enough, else a template."""
    best = F.get(evidence, F.lit(0))
    reuse = (best["score"] >= p.reuse_similarity) & (best["brand_reply"] != "")
    return F.when(reuse, best["brand_reply"]).otherwise(template_reply(intent))


def scoring_record(scored: DataFrame) -> DataFrame:
    """The nested result record of a scored message as JSON text."""
    record = F.struct(
        F.col("text").alias("customer_message"),
        "predicted_intent",
        F.round("confidence", 4).alias("confidence"),
        F.transform(
            "candidates",
            lambda c: F.struct(c["intent"].alias("intent"), F.round(c["prob"], 4).alias("prob")),
        ).alias("top_3_candidates"),
        F.transform(
            F.coalesce("evidence", F.expr("cast(array() as array<struct<rank:int,conversation_id:string,customer_text:string,brand_reply:string,similarity_score:double,score:double>>)")),
            lambda e: F.struct(
                e["conversation_id"].alias("conversation_id"),
                e["customer_text"].alias("customer_text"),
                e["brand_reply"].alias("brand_reply"),
                e["similarity_score"].alias("similarity_score"),
            ),
        ).alias("retrieved_examples"),
        "generated_reply",
        "escalation_decision",
        "escalation_reason",
    )
    return scored.select("doc_id", F.to_json(record).alias("record"))


def audit_rows(scored: DataFrame) -> DataFrame:
    """One log row per scored message: decision data and a short snippet."""
    return scored.select(
        F.col("doc_id").alias("message_id"),
        F.col("predicted_intent").alias("intent"),
        F.round("confidence", 2).alias("conf"),
        F.col("escalation_decision").alias("esc"),
        tx.snippet(tx.ustrip(F.col("text"))).alias("msg"),
    )
