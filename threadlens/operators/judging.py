"""Rubric scoring of replies: heuristic scores, score checks, parsed judge output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens import params as P
from threadlens.functions import text as tx

# Stock texts of the heuristic judge and defaults for missing fields.
HEURISTIC_REASONING = (
    "Heuristic evaluation based on support language patterns, DM actionability, "
    "and Twitter character constraints."
)
HEURISTIC_STRENGTHS = ["Concise response", "Includes action steps for customer"]
DEFAULT_SCORE = 4
DEFAULT_REASONING = "Evaluated against 5-dimension rubric."
DEFAULT_STRENGTHS = ["Grounded in evidence"]


def heuristic_scores(reply: Column, p: P.Params) -> dict[str, Column]:
    """Scores 3..5 per dimension from wording and length of a reply."""
    low, length = F.lower(reply), F.length(reply)
    return {
        "groundedness": F.when(tx.contains_any(low, P.GROUNDED_WORDS), 5).otherwise(4),
        "correctness": F.when(length > 10, 5).otherwise(4),
        "empathy": F.when(tx.contains_any(low, P.EMPATHY_STRONG), 5)
        .when(tx.contains_any(low, P.EMPATHY_POLITE), 4)
        .otherwise(3),
        "actionability": F.when(tx.contains_any(low, P.ACTION_STRONG), 5)
        .when(tx.contains_any(low, P.ACTION_WEAK), 4)
        .otherwise(3),
        "brand_tone": F.when(length <= p.max_reply_length, 5).otherwise(4),
    }


def judge_replies(replies: DataFrame, p: P.Params, reply: str = "generated_reply") -> DataFrame:
    """Add the five scores, their mean and the judge's stock remarks."""
    scored = replies.withColumns(
        heuristic_scores(F.coalesce(F.col(reply), F.lit("")), p)
    )
    total = sum((F.col(d) for d in P.SCORE_DIMENSIONS), F.lit(0))
    return scored.withColumns(
        {
            "overall_score": F.round(total / F.lit(5.0), 2),
            "reasoning": F.lit(HEURISTIC_REASONING),
            "strengths": F.array(*[F.lit(s) for s in HEURISTIC_STRENGTHS]),
            "weaknesses": F.expr("cast(array() as array<string>)"),
        }
    )


def score_errors(values: dict[str, Column | None]) -> Column:
    """Array of problems with text scores; a missing column is passed as None.

    Scores must be integers from 1 to 5.
    """
    checks = []
    for name in P.SCORE_DIMENSIONS:
        value = values.get(name)
        if value is None:
            checks.append(F.lit(f"Missing required dimension score: '{name}'"))
            continue
        whole = tx.ustrip(value).try_cast("int")
        checks.append(
            F.when(value.isNull(), F.lit(f"Missing required dimension score: '{name}'"))
            .when(
                whole.isNull(),
                F.concat(F.lit(f"Score for '{name}' must be an integer (got "), value, F.lit(")")),
            )
            .when(
                ~whole.between(1, 5),
                F.concat(F.lit(f"Score for '{name}' must be between 1 and 5 (got "), value, F.lit(")")),
            )
        )
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def validate_scores(scores: DataFrame) -> DataFrame:
    """Add ``errors`` to a table with text score columns."""
    columns = {d: F.col(d) for d in P.SCORE_DIMENSIONS if d in scores.columns}
    return scores.withColumn("errors", score_errors(columns))


def parse_judge_json(replies: DataFrame, raw: str = "raw") -> DataFrame:
    """Scores from a judge's JSON answer; code fences are dropped.

    Missing fields get their defaults, a missing overall score the mean of the
    dimensions.  Rows that are not JSON objects have ``parsed = false`` and are
    scored with the defaults.
    """
    stripped = tx.ustrip(F.col(raw))
    body = F.when(
        F.startswith(stripped, F.lit("```json")),
        tx.ustrip(F.replace(F.replace(stripped, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))),
    ).otherwise(stripped)
    fields = ", ".join(f"{d} string" for d in [*P.SCORE_DIMENSIONS, "overall_score", "reasoning"])
    schema = f"{fields}, strengths array<string>, weaknesses array<string>"
    parsed = replies.withColumn("_j", F.from_json(body, schema, {"mode": "PERMISSIVE"}))
    # a malformed answer parses to a struct of nulls, an empty object likewise
    ok = F.coalesce(F.try_parse_json(body).isNotNull(), F.lit(False)) & F.startswith(body, F.lit("{"))
    scores = {
        d: F.coalesce(
            F.col(f"_j.{d}").try_cast("double").cast("int"), F.lit(DEFAULT_SCORE)
        )
        for d in P.SCORE_DIMENSIONS
    }
    total = sum((F.col(d) for d in P.SCORE_DIMENSIONS), F.lit(0))
    return (
        parsed.withColumns({"parsed": ok, **scores})
        .withColumns(
            {
                "overall_score": F.coalesce(
                    F.col("_j.overall_score").try_cast("double"), total / F.lit(5.0)
                ),
                "reasoning": F.coalesce("_j.reasoning", F.lit(DEFAULT_REASONING)),
                "strengths": F.coalesce(
                    "_j.strengths", F.array(*[F.lit(s) for s in DEFAULT_STRENGTHS])
                ),
                "weaknesses": F.coalesce("_j.weaknesses", F.expr("cast(array() as array<string>)")),
            }
        )
        .drop("_j")
    )


def judge_summary(judged: DataFrame) -> DataFrame:
    """One row: replies judged and mean scores, from exact integer sums."""
    total = sum((F.col(d) for d in P.SCORE_DIMENSIONS), F.lit(0)).cast("bigint")
    return judged.agg(
        F.count("*").alias("total_replies_judged"),
        F.round(F.sum(total) / (F.lit(5.0) * F.count("*")), 2).alias("average_overall_score"),
        *[F.round(F.avg(d), 2).alias(f"average_{d}") for d in P.SCORE_DIMENSIONS],
    )


def dimension_ranking(judged: DataFrame) -> DataFrame:
    """Dimensions from strongest to weakest mean; ties keep the rubric's order."""
    pairs = ", ".join(
        f"{i}L, '{P.DIMENSION_LABELS[d]}', average_{d}" for i, d in enumerate(P.SCORE_DIMENSIONS)
    )
    return (
        judge_summary(judged)
        .selectExpr(f"stack(5, {pairs}) AS (position, dimension, mean)")
        .orderBy(F.desc("mean"), "position")
        .select("position", "dimension", "mean")
    )
