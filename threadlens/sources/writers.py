"""Sinks: processed messages, conversations, golden labels, metrics, audit log."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.sources.schemas import (
    ANNOTATION_COLUMNS,
    CONVERSATION_COLUMNS,
    PROCESSED_COLUMNS,
    select_known,
)


#: Column that names the batch a row of an append table came with.
BATCH = "batch"
CSV_LAYOUT = {
    "header": True,
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet by default; CSV with header and doubled quotes as exchange format."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.options(**CSV_LAYOUT)
    writer.format(fmt).save(path)


def append_batch(df: DataFrame, path: str, batch: str, fmt: str = "parquet") -> None:
    """Add the rows of one batch to a table that is partitioned by batch.

    The same batch again replaces itself, also by no rows at all, so a job that is retried
    after a failure leaves its rows once.  Other batches are not touched: their partitions
    are not rewritten.  ``batch`` has letters, digits, ``_``, ``-`` and ``.`` only.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"not a batch name: {batch!r}")
    options = CSV_LAYOUT if fmt == "csv" else {}
    if df.isEmpty():
        # a partition without rows is only replaced by its own folder
        df.write.mode("overwrite").options(**options).format(fmt).save(f"{path.rstrip('/')}/{BATCH}={batch}")
        return
    tagged = df.withColumn(BATCH, F.lit(batch)).write.mode("overwrite").partitionBy(BATCH)
    tagged.options(partitionOverwriteMode="dynamic", **options).format(fmt).save(path)


def write_processed(messages: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Processed messages, ten columns in order, only those present."""
    write_table(select_known(messages, PROCESSED_COLUMNS), path, fmt)


def write_conversations(conversations: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(select_known(conversations, [*CONVERSATION_COLUMNS, "part"]), path, fmt)


def append_annotations(records: DataFrame, path: str, batch: str) -> None:
    """Append a batch of records to the progress table; every file carries the header."""
    append_batch(select_known(records, ANNOTATION_COLUMNS), path, batch, "csv")


def write_golden(golden: DataFrame, path: str, fmt: str = "csv") -> None:
    """Golden labels sorted by conversation id."""
    write_table(select_known(golden, ANNOTATION_COLUMNS).orderBy("conversation_id"), path, fmt)


def as_json(df: DataFrame) -> DataFrame:
    """Rows as JSON text in a single column."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    """Metrics and summaries, one JSON object per line."""
    as_json(df).write.mode("overwrite").text(path)


def append_audit(rows: DataFrame, path: str, batch: str, at: datetime | None = None) -> None:
    """Add a batch to the audit log with the time of writing, or a given one."""
    logged = F.lit(at) if at else F.current_timestamp()
    append_batch(rows.withColumn("logged_at", logged), path, batch)
