"""Evaluation metrics: classification, escalation, rater agreement, failures.

Labels are reduced to counts per (system, true, predicted) first; everything else
is arithmetic on those small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens import params as P
from threadlens.functions import text as tx


def _ratio(a, b):
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def confusion_counts(df: DataFrame, true: str, pred: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    return df.groupBy(*by, F.col(true).alias("true_label"), F.col(pred).alias("pred_label")).agg(
        F.count("*").alias("count")
    )


def confusion_matrix(df: DataFrame, true: str, pred: str) -> DataFrame:
    """(true_label, pred_label, count) for every pair of known labels, zeros included.

    The grid is built from the label set inside one array, so only the labels
    themselves are paired.
    """
    counts = confusion_counts(df, true, pred)
    labels = counts.select(F.explode(F.array("true_label", "pred_label")).alias("l")).agg(
        F.sort_array(F.collect_set("l")).alias("labels")
    )
    grid = labels.select(F.explode("labels").alias("true_label"), "labels").select(
        "true_label", F.explode("labels").alias("pred_label")
    )
    return grid.join(counts, ["true_label", "pred_label"], "left").select(
        "true_label", "pred_label", F.coalesce("count", F.lit(0)).alias("count")
    )


def per_class_metrics(
    df: DataFrame, true: str, pred: str, by: list[str] | None = None
) -> DataFrame:
    """Per label: support, precision, recall, F1 (0 where undefined)."""
    by = by or []
    counts = confusion_counts(df, true, pred, by)
    sides = counts.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("true_label").alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p")),
                F.struct(F.col("pred_label").alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p")),
            )
        ).alias("s"),
        "count",
        (F.col("true_label") == F.col("pred_label")).cast("int").alias("hit"),
    )
    marginals = sides.groupBy(*by, F.col("s.label").alias("label")).agg(
        F.sum(F.col("s.t") * F.col("count")).alias("support"),
        F.sum(F.col("s.p") * F.col("count")).alias("predicted"),
        F.sum(F.col("s.t") * F.col("hit") * F.col("count")).alias("hits"),
    )
    return marginals.select(
        *by,
        "label",
        "support",
        "predicted",
        "hits",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2.0 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
    )


def intent_metrics(
    df: DataFrame, true: str, pred: str, by: list[str] | None = None
) -> DataFrame:
    """Accuracy and macro / weighted precision, recall and F1; zeros for no rows."""
    by = by or []
    classes = per_class_metrics(df, true, pred, by)
    n = F.sum("support")

    def weighted(c):
        return F.round(F.coalesce(F.sum(F.col(c) * F.col("support")) / F.nullif(n, F.lit(0)), F.lit(0.0)), 4)

    def macro(c):
        return F.round(F.coalesce(F.avg(c), F.lit(0.0)), 4)

    return classes.groupBy(*by).agg(
        F.round(F.coalesce(F.sum("hits") / F.nullif(n, F.lit(0)), F.lit(0.0)), 4).alias("accuracy"),
        macro("precision").alias("precision_macro"),
        weighted("precision").alias("precision_weighted"),
        macro("recall").alias("recall_macro"),
        weighted("recall").alias("recall_weighted"),
        macro("f1").alias("f1_macro"),
        weighted("f1").alias("f1_weighted"),
        F.coalesce(n, F.lit(0)).alias("total_samples"),
        F.count("*").alias("classes"),
    )


def escalation_metrics(
    df: DataFrame, true: str, pred: str, by: list[str] | None = None
) -> DataFrame:
    """Binary metrics of escalation labels, with false positive/negative rates."""
    by = by or []
    t, p = tx.is_escalation(F.col(true)), tx.is_escalation(F.col(pred))
    counts = df.groupBy(*by).agg(
        F.count_if(~t & ~p).alias("tn"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(t & p).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def rate(a, b):
        return F.round(_ratio(a, b), 4)

    return counts.select(
        *by, "tn", "fp", "fn", "tp",
        rate(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        rate(tp, tp + fp).alias("precision"),
        rate(tp, tp + fn).alias("recall"),
        rate(2.0 * tp, 2 * tp + fp + fn).alias("f1"),
        rate(fp, fp + tn).alias("false_positive_rate"),
        rate(fn, fn + tp).alias("false_negative_rate"),
    )


# Systems compared, as (name, column prefix).
SYSTEMS = [
    ("baseline_1_trivial", "b1"),
    ("baseline_2_simple", "b2"),
    ("ai_agent_final", "agent"),
]


def long_predictions(wide: DataFrame) -> DataFrame:
    """One row per (system, message) from the wide prediction table."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("system"),
                F.col(f"{prefix}_intent").alias("pred_intent"),
                F.col(f"{prefix}_escalation").alias("pred_escalation"),
            )
            for name, prefix in SYSTEMS
        ]
    )
    return wide.select(
        "conversation_id", "true_intent", "true_escalation", F.explode(entries).alias("e")
    ).select("conversation_id", "true_intent", "true_escalation", "e.*")


def system_comparison(wide: DataFrame) -> DataFrame:
    """Six headline metrics per system."""
    long = long_predictions(wide)
    intents = intent_metrics(long, "true_intent", "pred_intent", ["system"]).select(
        "system", F.col("accuracy").alias("intent_accuracy"), F.col("f1_macro").alias("intent_f1_macro")
    )
    escalations = escalation_metrics(long, "true_escalation", "pred_escalation", ["system"]).select(
        "system",
        F.col("accuracy").alias("escalation_accuracy"),
        F.col("f1").alias("escalation_f1"),
        "false_positive_rate",
        "false_negative_rate",
    )
    return intents.join(escalations, "system")


# -- rater agreement ---------------------------------------------------------


def paired_scores(human: DataFrame, judge: DataFrame) -> DataFrame:
    return human.join(judge, "conversation_id")


def _score_counts(pairs: DataFrame) -> DataFrame:
    """(dimension, h, j, n): at most 25 rows per dimension for scores 1..5."""
    entries = F.array(
        *[
            F.struct(
                F.lit(d).alias("dimension"),
                F.col(f"human_{d}").cast("int").alias("h"),
                F.col(d).cast("int").alias("j"),
            )
            for d in P.SCORE_DIMENSIONS
        ]
    )
    return pairs.select(F.explode(entries).alias("e")).groupBy("e.dimension", "e.h", "e.j").agg(
        F.count("*").alias("n")
    )


def agreement_by_dimension(pairs: DataFrame) -> DataFrame:
    """Per dimension: means, exact and within-one agreement, errors."""
    diff = (F.col("j") - F.col("h")).cast("bigint")
    total = F.sum("n")

    def mean(x, digits):
        return F.round(F.sum(x * F.col("n")) / total, digits)

    def share(hit):
        return F.round(F.sum(F.when(hit, F.col("n")).otherwise(0)) * 100.0 / total, 2)

    return _score_counts(pairs).groupBy("dimension").agg(
        mean(F.col("h"), 2).alias("human_mean"),
        mean(F.col("j"), 2).alias("judge_mean"),
        share(diff == 0).alias("exact_match_pct"),
        share(F.abs(diff) <= 1).alias("within_1_pct"),
        mean(F.abs(diff), 4).alias("mae"),
        mean(diff, 4).alias("mean_score_difference"),
    )


def cohen_kappa(pairs: DataFrame) -> DataFrame:
    """Unweighted and quadratic kappa per dimension.

    Quadratic weights use the rank of a score among the scores that occur in the
    dimension.  NaN when chance agreement leaves nothing to disagree about.
    """
    counts = _score_counts(pairs)
    # score labels are few: each dimension's marginals fit one small array
    sides = counts.select(
        "dimension",
        F.explode(
            F.array(
                F.struct(F.col("h").alias("l"), F.col("n").alias("hn"), F.lit(0).cast("bigint").alias("jn")),
                F.struct(F.col("j").alias("l"), F.lit(0).cast("bigint").alias("hn"), F.col("n").alias("jn")),
            )
        ).alias("s"),
    )
    margins = sides.groupBy("dimension", F.col("s.l").alias("l")).agg(
        F.sum("s.hn").alias("hn"), F.sum("s.jn").alias("jn")
    ).withColumn("r", F.row_number().over(Window.partitionBy("dimension").orderBy("l")))
    tables = margins.groupBy("dimension").agg(
        F.collect_list(F.struct("l", "r", "hn", "jn")).alias("m"), F.sum("hn").alias("total")
    )
    # expected disagreement over all pairs of labels of one dimension
    def expected(weight):
        row = lambda a: F.aggregate(
            "m", F.lit(0.0), lambda acc, b: acc + weight(a, b) * a["hn"] * b["jn"]
        )
        return F.aggregate("m", F.lit(0.0), lambda acc, a: acc + row(a))

    differs = lambda a, b: (a["r"] != b["r"]).cast("double")
    squared = lambda a, b: F.pow((a["r"] - b["r"]).cast("double"), 2)
    expectations = tables.select(
        "dimension", "total", expected(differs).alias("e1"), expected(squared).alias("e2")
    )
    ranks = margins.select("dimension", "l", "r")
    observed = (
        counts.join(ranks.select("dimension", F.col("l").alias("h"), F.col("r").alias("rh")), ["dimension", "h"])
        .join(ranks.select("dimension", F.col("l").alias("j"), F.col("r").alias("rj")), ["dimension", "j"])
        .groupBy("dimension")
        .agg(
            F.sum(F.when(F.col("rh") != F.col("rj"), F.col("n")).otherwise(0)).alias("o1"),
            F.sum(F.pow((F.col("rh") - F.col("rj")).cast("double"), 2) * F.col("n")).alias("o2"),
        )
    )

    def kappa(o, e):
        value = 1.0 - F.col(o) * F.col("total") / F.nullif(F.col(e), F.lit(0.0))
        return F.coalesce(F.round(value, 4), F.lit(float("nan")))

    return observed.join(expectations, "dimension").select(
        "dimension",
        kappa("o1", "e1").alias("cohen_kappa_unweighted"),
        kappa("o2", "e2").alias("cohen_kappa_quadratic"),
    )


def agreement_overall(pairs: DataFrame) -> DataFrame:
    """One row on the overall scores; rounding to whole scores is half-even."""
    h, j = F.col("human_overall").cast("double"), F.col("overall_score").cast("double")
    # rounding each difference removes float noise before summing
    diff = F.round(j - h, 9)

    def share(hit):
        return F.round(F.count_if(hit) * 100.0 / F.nullif(F.count("*"), F.lit(0)), 2)

    return pairs.agg(
        F.count("*").alias("sample_count"),
        F.round(F.avg(h), 2).alias("human_overall_mean"),
        F.round(F.avg(j), 2).alias("judge_overall_mean"),
        F.round(F.avg(F.abs(diff)), 4).alias("overall_mae"),
        F.round(F.avg(diff), 4).alias("overall_mean_difference"),
        share(F.rint(h) == F.rint(j)).alias("overall_exact_match_pct"),
        share(F.abs(diff) <= 1.0).alias("overall_within_1_pct"),
    )


def agreement_matrix(pairs: DataFrame) -> DataFrame:
    """5 x 5 counts of whole overall scores; scores outside 1..5 are left out."""
    cells = pairs.sparkSession.range(25).select(
        F.expr("CAST(id DIV 5 + 1 AS BIGINT)").alias("human"),
        F.expr("CAST(id % 5 + 1 AS BIGINT)").alias("judge"),
    )
    counts = pairs.groupBy(
        F.rint("human_overall").cast("bigint").alias("human"),
        F.rint("overall_score").cast("bigint").alias("judge"),
    ).agg(F.count("*").alias("found"))
    return cells.join(counts, ["human", "judge"], "left").select(
        "human", "judge", F.coalesce("found", F.lit(0)).alias("count")
    )


def score_histogram(pairs: DataFrame) -> DataFrame:
    """Eight bins over [1, 5], the last one closed, for both raters."""
    sides = F.array(
        F.struct(F.lit("human").alias("rater"), F.col("human_overall").cast("double").alias("x")),
        F.struct(F.lit("judge").alias("rater"), F.col("overall_score").cast("double").alias("x")),
    )
    bins = F.least(F.floor((F.col("s.x") - 1.0) / 0.5), F.lit(7))
    counts = (
        pairs.select(F.explode(sides).alias("s"))
        .filter(F.col("s.x").between(1.0, 5.0))
        .groupBy(F.col("s.rater").alias("rater"), bins.alias("bin"))
        .agg(F.count("*").alias("found"))
    )
    grid = pairs.sparkSession.range(16).select(
        F.expr("CASE WHEN id < 8 THEN 'human' ELSE 'judge' END").alias("rater"),
        F.expr("id % 8").alias("bin"),
    )
    return grid.join(counts, ["rater", "bin"], "left").select(
        "rater", "bin", (1.0 + F.col("bin") * 0.5).alias("low"), F.coalesce("found", F.lit(0)).alias("count")
    )


# -- failures ----------------------------------------------------------------


def failure_cases(wide: DataFrame, escalation_cases: int = 2, total: int = 4) -> DataFrame:
    """A short report of failures: escalation mismatches first, then intents.

    At most ``escalation_cases`` escalation mismatches, then intent mismatches
    until ``total`` cases, each in id order.
    """
    true_esc = tx.is_escalation(F.col("true_escalation"))
    agent_esc = tx.is_escalation(F.col("agent_escalation"))
    expected_esc = F.when(true_esc, "ESCALATE").otherwise("AUTO_HANDLE")
    escalations = (
        wide.filter(true_esc != agent_esc)
        .orderBy("conversation_id")
        .limit(escalation_cases)
        .select(
            F.lit(0).alias("kind"),
            F.lit("Escalation Policy Misclassification").alias("category"),
            "conversation_id",
            "customer_text",
            F.format_string("Intent: `%s`, Escalation: `%s`", "agent_intent", "agent_escalation").alias("predicted_output"),
            F.format_string("Intent: `%s`, Escalation: `%s`", F.col("true_intent"), expected_esc).alias("expected_output"),
        )
    )
    intents = (
        wide.filter(F.col("true_intent") != F.col("agent_intent"))
        .orderBy("conversation_id")
        .limit(total)
        .select(
            F.lit(1).alias("kind"),
            F.lit("Intent Taxonomy Overlap / Disambiguation").alias("category"),
            "conversation_id",
            "customer_text",
            F.format_string("Intent: `%s`", "agent_intent").alias("predicted_output"),
            F.format_string("Intent: `%s`", "true_intent").alias("expected_output"),
        )
    )
    return (
        escalations.unionByName(intents)
        .orderBy("kind", "conversation_id")
        .limit(total)
        .drop("kind")
    )
