"""Result files: golden labels, predictions, metrics, judged replies, overview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.operators import annotations as an
from threadlens.params import Params
from threadlens.plans.evaluate import evaluate, judge
from threadlens.plans.explore import explore
from threadlens.sources import readers, writers
from threadlens.sources.tables import materialize

#: Tables of the overview file, one JSON object each.
OVERVIEW = [
    "overview_counts",
    "thread_length_stats",
    "role_balance",
    "text_length_stats",
    "temporal_span",
    "participation",
    "turn_structure",
]


def validate_file(spark: SparkSession, path: str, p: Params) -> DataFrame:
    """Validation of the annotation table at ``path``, or the one row that says it is not there."""
    records = readers.scan_annotations(spark, path)
    if records.isEmpty() and not readers.exists(spark, path):
        return an.not_found(spark, path)
    return an.annotation_validation(records, p)


def export_golden(records: DataFrame, folder: str, fmt: str = "csv") -> None:
    """The valid latest annotation of every conversation, sorted by id."""
    writers.write_golden(an.golden_records(records), f"{folder.rstrip('/')}/golden", fmt)


def export_overview(messages: DataFrame, p: Params, folder: str) -> None:
    """Descriptive tables of one row as JSON, the others are tables of their own."""
    tables = explore(messages, p)
    for name in OVERVIEW:
        writers.write_json(tables[name], f"{folder.rstrip('/')}/{name}")


def export_evaluation(
    predictions: DataFrame, human: DataFrame | None, p: Params, folder: str
) -> None:
    """Predictions as CSV with header, every metric and judge table as JSON lines.

    ``human`` scores are optional; without them there are no agreement files.
    """
    folder = folder.rstrip("/")
    # every file below reads the same rows
    written = materialize(predictions, "predictions")
    writers.write_table(written, f"{folder}/predictions", "csv")
    for name, table in evaluate(written).items():
        writers.write_json(table, f"{folder}/evaluation/{name}")
    for name, table in judge(written, human, p).items():
        writers.write_json(table, f"{folder}/judge/{name}")
