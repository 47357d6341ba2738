"""Annotation table: validation, golden export, work queue.

``annotated_at`` and a tie-breaking ``row_id`` define which of several records of
a conversation is the latest.  A missing id counts as an empty id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens import params as P
from threadlens.functions import text as tx
from threadlens.operators.common import beside
from threadlens.operators.ordering import first_per_key
from threadlens.sources.schemas import ANNOTATION_COLUMNS, select_known


def _empty(col: Column) -> Column:
    return tx.is_blank(col)


def _pylist(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def record_errors() -> Column:
    """Array of problems of one annotation record."""
    intent, reason, confidence = (
        F.col(c) for c in ("primary_intent", "escalation_reason", "confidence")
    )
    escalated = tx.is_escalation(F.col("escalation"))
    no_reason = _empty(reason) | (reason == "none")
    known_reasons = [r for r in P.ESCALATION_REASONS if r != "none"]
    checks = [
        F.when(_empty(F.col("conversation_id")), F.lit("conversation_id is empty")),
        F.when(_empty(intent), F.lit("primary_intent is empty")).when(
            ~intent.isin(P.INTENTS),
            F.concat(F.lit("Invalid intent '"), intent, F.lit(f"'. Valid: {_pylist(P.INTENTS)}")),
        ),
        F.when(
            confidence.isNull() | ~confidence.isin(P.CONFIDENCE_LEVELS),
            F.concat(
                F.lit("Invalid confidence '"),
                F.coalesce(confidence, F.lit("")),
                F.lit(f"'. Valid: {_pylist(P.CONFIDENCE_LEVELS)}"),
            ),
        ),
        F.when(
            escalated & no_reason, F.lit("escalation_reason is required when escalation is True")
        ).when(
            escalated & ~reason.isin(P.ESCALATION_REASONS),
            F.concat(
                F.lit("Invalid escalation_reason '"), reason, F.lit(f"'. Valid: {_pylist(known_reasons)}")
            ),
        ),
    ]
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def with_errors(records: DataFrame) -> DataFrame:
    return records.withColumn("errors", record_errors())


def annotation_errors(records: DataFrame) -> DataFrame:
    """One row per problem of a record: (row_id, error)."""
    return with_errors(records).select("row_id", F.explode("errors").alias("error"))


def duplicate_annotations(records: DataFrame) -> DataFrame:
    """Ids that occur more than once, with their count and first row."""
    return (
        records.groupBy("conversation_id")
        .agg(F.count("*").alias("records"), F.min("row_id").alias("first_row"))
        .filter("records > 1")
    )


def annotation_validation(records: DataFrame, p: P.Params) -> DataFrame:
    """One row: totals, validity, warning texts and label counts of the whole table.

    A duplicated id makes the table invalid, not its rows.
    """
    invalid = F.size("errors") > 0
    totals = with_errors(records).agg(
        F.count("*").alias("total_records"),
        F.count_if(~invalid).alias("valid_records"),
        F.count_if(invalid).alias("invalid_records"),
        F.coalesce(F.sum(F.size("errors").cast("bigint")), F.lit(0)).alias("record_errors"),
        F.count_if(_empty(F.col("conversation_id"))).alias("empty_ids"),
        F.count_if(F.col("confidence") == "low").alias("low_confidence"),
    )
    duplicates = duplicate_annotations(records).agg(F.count("*").alias("duplicate_ids"))
    valid = F.col("valid_records")
    warnings = [
        F.when(
            F.col("empty_ids") > 0,
            F.concat(F.col("empty_ids").cast("string"), F.lit(" records have empty conversation_id")),
        ),
        F.when(
            F.col("low_confidence") > 0,
            F.concat(
                F.col("low_confidence").cast("string"),
                F.lit(" records have low confidence — consider review"),
            ),
        ),
        F.when(
            valid < p.min_golden_records,
            F.concat(
                F.lit("Only "),
                valid.cast("string"),
                F.lit(" valid records. Target is 150-250 for the golden dataset."),
            ),
        ),
    ]
    # labels are a closed set, others are errors; the listing is one entry per label
    listed = F.sort_array(F.collect_list(F.concat_ws("=", "primary_intent", F.col("count").cast("string"))))
    intents = label_distribution(records).agg(F.array_join(listed, ", ").alias("intents"))
    return beside(beside(totals, duplicates), intents).select(
        ((F.col("record_errors") == 0) & (F.col("duplicate_ids") == 0)).alias("is_valid"),
        "total_records",
        "valid_records",
        "invalid_records",
        "record_errors",
        "duplicate_ids",
        F.concat_ws("; ", *warnings).alias("warnings"),
        F.lit(None).cast("string").alias("error"),
        "intents",
    )


def not_found(spark, path: str) -> DataFrame:
    """The validation result of a table that is not there."""
    columns = (
        "is_valid boolean, total_records bigint, valid_records bigint, invalid_records bigint, record_errors bigint, "
        "duplicate_ids bigint, warnings string, error string, intents string"
    )
    return spark.createDataFrame([(False, 0, 0, 0, 0, 0, "", f"File not found: {path}", "")], columns)


def label_distribution(records: DataFrame, label: str = "primary_intent") -> DataFrame:
    """(label, count, pct) of the non-null labels; pct is of all records."""
    total = records.agg(F.count("*").alias("n"))
    counts = records.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("count"))
    return counts.withColumn("_n", total.scalar()).select(
        label, "count", tx.percentage(F.col("count"), F.col("_n")).alias("pct")
    )


def golden_records(records: DataFrame) -> DataFrame:
    """Latest record per id; then invalid intents and empty ids are removed.

    The order of the steps matters: an id whose latest record has an invalid
    intent disappears.  Invalid confidences and reasons are kept.
    """
    latest = first_per_key(
        records, ["conversation_id"], [F.col("annotated_at").desc_nulls_last(), F.desc("row_id")]
    )
    return latest.filter(F.col("primary_intent").isin(P.INTENTS)).filter(
        ~_empty(F.col("conversation_id"))
    )


def golden_export(records: DataFrame, validate_only: bool = False) -> DataFrame | None:
    """The golden table in its column order, sorted by id; None for validation only."""
    if validate_only:
        return None
    return select_known(golden_records(records), ANNOTATION_COLUMNS).orderBy("conversation_id")


def annotated_ids(records: DataFrame) -> DataFrame:
    return records.select("conversation_id").filter("conversation_id IS NOT NULL").distinct()


def annotation_queue(
    conversations: DataFrame, records: DataFrame, limit: int | None = None
) -> DataFrame:
    """Conversations without a record, by id, at most ``limit`` of them."""
    todo = conversations.join(annotated_ids(records), "conversation_id", "left_anti").orderBy(
        "conversation_id"
    )
    return todo if limit is None else todo.limit(limit)


def golden_with_text(golden: DataFrame, conversations: DataFrame) -> DataFrame:
    """Golden labels with the opening message of their conversation as ``text``.

    Only the first part of a conversation's row is needed for its opening message.
    """
    openings = conversations
    if "part" in conversations.columns:
        openings = conversations.filter("part = 0")
    return golden.join(
        openings.select("conversation_id", F.col("opening_message").alias("text")), "conversation_id"
    )
