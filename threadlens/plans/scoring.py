"""Batch scoring: classify, retrieve evidence, decide, reply."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions import text as tx
from threadlens.operators import classify as cl
from threadlens.operators import retrieval as rt
from threadlens.operators.decisions import decide, select_reply
from threadlens.operators.stages import ADDED
from threadlens.params import Params
from threadlens.sources import readers
from threadlens.sources.tables import materialize

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Scorer:
    """Fitted parts of the scoring job; each one can be replaced.

    ``classify`` maps (doc_id, text) to (doc_id, predicted_intent, confidence,
    candidates); ``retrieve`` maps (query_id, text) to (query_id, evidence);
    ``decide`` and ``reply`` add columns to the joined table.
    """

    classify: Step
    retrieve: Step
    decide: Step
    reply: Step


def fit_scorer(training: DataFrame, evidence: DataFrame, p: Params) -> Scorer:
    """Train on (doc_id, text, label); index evidence (doc_id, customer_text, brand_reply)."""
    return scorer_of(cl.train(training, p), evidence, p)


def scorer_from_sources(
    spark: SparkSession, golden: DataFrame | None, conversations: DataFrame | None, messages: DataFrame | None, p: Params
) -> Scorer:
    """Train and index on what there is; built-in rows stand in for what is missing."""
    training = readers.training_table(spark, golden, conversations, p.min_training_records)
    evidence = readers.evidence_table(spark, None, messages, p).withColumnRenamed("conversation_id", "doc_id")
    return fit_scorer(cl.training_columns(training), evidence, p)


def written_evidence(evidence: DataFrame) -> DataFrame:
    """(doc_id, customer_text, brand_reply) as a written table; ids are text."""
    ids = F.col("doc_id").cast("string").alias("doc_id")
    return materialize(evidence.select(ids, "customer_text", "brand_reply"), "evidence")


def scorer_of(
    model: cl.IntentModel | Transformer, evidence: DataFrame, p: Params, written: bool = False
) -> Scorer:
    """Scoring with a model that is there already, fitted or of given weights.

    Any ML transformer will do that adds predicted_intent, confidence and candidates to
    rows (doc_id, text), so a saved pipeline can be put in.
    With ``written`` the evidence is a ``written_evidence`` already and not written again.
    """
    if isinstance(model, Transformer):
        classify = lambda rows: model.transform(rows).select("doc_id", *ADDED)
    else:
        classify = lambda rows: cl.classify(rows, model)
    corpus = evidence if written else written_evidence(evidence)
    index = rt.build_index(
        corpus.select("doc_id", F.coalesce("customer_text", F.lit("")).alias("text")),
        p.retrieval_features,
        p.ngram_max,
    )

    def retrieve(queries: DataFrame) -> DataFrame:
        return rt.evidence_list(rt.search(queries, index, p.top_k), corpus)

    return Scorer(
        classify=classify,
        retrieve=retrieve,
        decide=lambda df: decide(df, p),
        reply=lambda df: df.withColumn(
            "generated_reply", select_reply(F.col("predicted_intent"), F.col("evidence"), p)
        ),
    )


def score_messages(messages: DataFrame, scorer: Scorer) -> DataFrame:
    """One scored row per (doc_id, text) message."""
    # three joins on the message id: written once so that each reads the same rows
    stripped = materialize(
        messages.select("doc_id", tx.ustrip(F.coalesce("text", F.lit(""))).alias("text")), "requests"
    )
    # written, so that the tasks that count terms do not hold the texts of the evidence too
    predictions = materialize(scorer.classify(stripped), "predictions")
    evidence = scorer.retrieve(stripped.withColumnRenamed("doc_id", "query_id")).select(
        F.col("query_id").alias("doc_id"), "evidence"
    )
    joined = stripped.join(predictions, "doc_id").join(evidence, "doc_id", "left")
    return joined.transform(scorer.decide).transform(scorer.reply)
