"""Readers for message, conversation, annotation and batch-request files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.operators.annotations import golden_with_text
from threadlens.operators.conversations import evidence_pairs, first_brand_replies
from threadlens.operators.ordering import numbered
from threadlens.params import Params
from threadlens.sources import seeds
from threadlens.sources.schemas import (
    ANNOTATION_SCHEMA,
    CONVERSATION_COLUMNS,
    PROCESSED_COLUMNS,
    RAW_COLUMNS,
    require_columns,
)
from threadlens.sources.writers import BATCH

CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8"}


def normalize_inbound(value: Column) -> Column:
    """``True`` / ``False`` as text or boolean; anything else is unknown."""
    text = value.cast("string")
    return F.when(text.isin("True", "true"), True).when(text.isin("False", "false"), False)


def parse_created_at(value: Column) -> Column:
    """Dates as ``Tue Oct 31 22:10:47 +0000 2017`` or in ISO form; else null.

    The weekday is cut off, it cannot be parsed and carries no information.
    """
    return F.coalesce(
        F.try_to_timestamp(F.substr(value, F.lit(5)), F.lit("MMM dd HH:mm:ss Z yyyy")),
        value.try_cast("timestamp"),
    )


def read_csv(
    spark: SparkSession, path: str, types: dict[str, str] | None = None, multiline: bool = True
) -> DataFrame:
    """CSV with all columns as text, apart from the columns named in ``types``.

    Pass ``multiline=False`` for large files without line breaks inside quotes:
    only then can one file be read by several tasks.
    """
    options = {**CSV_OPTIONS, "multiLine": multiline}
    df = spark.read.options(**options).option("inferSchema", False).csv(path)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in (types or {}).items()})


def scan_messages(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Raw message CSV: ids stay text, dates and the direction flag are parsed."""
    raw = require_columns(read_csv(spark, path, multiline=multiline), RAW_COLUMNS)
    return raw.withColumns(
        {
            "inbound": normalize_inbound(F.col("inbound")),
            "created_at": parse_created_at(F.col("created_at")),
        }
    )


def scan_processed(spark: SparkSession, path: str) -> DataFrame:
    """Processed messages in Parquet, or in the CSV export when the path says so."""
    if path.rstrip("/").endswith(".csv"):
        df = read_csv(spark, path, {"created_at": "timestamp", "inbound": "boolean"})
    else:
        df = spark.read.parquet(path)
    return require_columns(df, PROCESSED_COLUMNS[:4])


def scan_conversations(spark: SparkSession, path: str) -> DataFrame:
    if path.rstrip("/").endswith(".csv"):
        counts = {c: "bigint" for c in CONVERSATION_COLUMNS if c.startswith("num_")}
        df = read_csv(spark, path, counts)
    else:
        df = spark.read.parquet(path)
    return require_columns(df, ["conversation_id"])


def parse_message_json(documents: DataFrame, column: str = "value") -> DataFrame:
    """Explode JSON request documents into (position, text), other columns kept.

    A document is a list of strings, a list of objects with ``text``, or an
    object with such a list under ``messages``.
    """
    wrapped = F.from_json(column, "messages array<string>")["messages"]
    plain = F.from_json(column, "array<string>")
    others = [c for c in documents.columns if c != column]
    rows = documents.select(
        *others, F.posexplode(F.coalesce(wrapped, plain)).alias("position", "item")
    )
    is_object = F.startswith(F.ltrim("item"), F.lit("{")) & F.try_parse_json("item").isNotNull()
    text = F.coalesce(F.get_json_object("item", "$.text"), F.lit(""))
    return rows.select(
        *others, "position", F.when(is_object, text).otherwise(F.col("item")).alias("text")
    )


def scan_message_json(spark: SparkSession, path: str) -> DataFrame:
    """Batch requests from files that hold one JSON document each."""
    return parse_message_json(spark.read.text(path, wholetext=True))


def scan_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Annotation progress with a row number column; empty when there is no file.

    ``row_id`` counts rows from 0 in the order in which files were written, then by file,
    by block of a file and by place in it.  How Spark packs files and cuts them into
    tasks makes no difference.
    """
    try:
        df = spark.read.options(**CSV_OPTIONS).csv(path)
        names = [c for c in df.columns if c != BATCH]
        place = {
            "_written": F.col("_metadata.file_modification_time"),
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
        df = df.withColumns(place).select(*[F.col(c).cast("string") for c in names], *place)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], ANNOTATION_SCHEMA).withColumn("row_id", F.lit(0).cast("bigint"))
    return numbered(df, list(place), "row_id").drop(*place)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder that Spark can list."""
    try:
        spark.read.text(path).schema  # noqa: B018
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def scan_log(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of an append table in Parquet with their ``batch``."""
    return require_columns(spark.read.parquet(path), columns).select(*columns, F.col(BATCH).cast("string").alias(BATCH))


def scan_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Metrics and summaries that ``write_json`` wrote, in a given layout."""
    return spark.read.schema(schema).json(path)


def with_fallback(*candidates: DataFrame | None) -> DataFrame:
    """The first candidate that exists and has rows."""
    for df in candidates:
        if df is not None and not df.isEmpty():
            return df
    raise ValueError("no source has any rows")


def training_table(
    spark: SparkSession,
    golden: DataFrame | None,
    conversations: DataFrame | None,
    min_records: int = 10,
) -> DataFrame:
    """(conversation_id, text, primary_intent, source) for the classifier.

    ``golden`` labels count when there are ``min_records`` of them.  Their text is the
    opening message of their conversation where a conversation table is given, else
    their own ``customer_text``.  Otherwise a built-in starter set; ``source`` says
    which of ``conversations``, ``golden`` and ``starter`` it is.
    """
    columns = ["conversation_id", "text", "primary_intent"]
    if golden is not None and len(golden.take(min_records)) == min_records:
        if conversations is not None and "opening_message" in conversations.columns:
            joined = golden_with_text(golden, conversations)
            return joined.select(*columns, F.lit("conversations").alias("source"))
        if "customer_text" in golden.columns:
            own = golden.withColumn("text", F.col("customer_text"))
            return own.select(*columns, F.lit("golden").alias("source"))
    return seeds.training_rows(spark).withColumn("source", F.lit("starter"))


def evaluation_table(
    spark: SparkSession, golden: DataFrame | None, conversations: DataFrame | None
) -> DataFrame:
    """(conversation_id, customer_text, primary_intent, escalation, source) to evaluate on.

    Golden labels with the opening messages of their conversations; else, where no
    conversation meets a label, with their own ``customer_text``; else the built-in rows.
    ``source`` says which: ``conversations``, ``golden`` or ``starter``.
    """
    columns = ["conversation_id", "customer_text", "primary_intent", "escalation"]
    if golden is not None and "primary_intent" in golden.columns and not golden.isEmpty():
        if conversations is not None and "opening_message" in conversations.columns:
            joined = golden_with_text(golden, conversations).withColumn("customer_text", F.col("text"))
            if not joined.isEmpty():
                return joined.select(*columns, F.lit("conversations").alias("source"))
        if "customer_text" in golden.columns:
            return golden.select(*columns, F.lit("golden").alias("source"))
    return seeds.evaluation_rows(spark).select(*columns).withColumn("source", F.lit("starter"))


def evidence_table(
    spark: SparkSession, index: DataFrame | None, messages: DataFrame | None, p: Params
) -> DataFrame:
    """(conversation_id, customer_text, brand_reply, source) to retrieve answers from.

    ``index`` may have the texts as columns, or be a conversation table, whose transcripts
    give the replies.  Else the first messages of both roles in processed ``messages``,
    else the built-in rows; ``source`` is ``index``, ``messages`` or ``starter``.
    """
    columns = ["conversation_id", "customer_text", "brand_reply"]
    if index is not None and "conversation_id" in index.columns and not index.isEmpty():
        if {"customer_text", "brand_reply"} <= set(index.columns):
            return index.select(*columns).withColumn("source", F.lit("index"))
        if {"opening_message", "full_conversation"} <= set(index.columns):
            parts = index if "part" in index.columns else index.withColumn("part", F.lit(0))
            openings = parts.filter("part = 0")
            replies = first_brand_replies(parts, p).withColumnRenamed("reply", "brand_reply")
            named = openings.select("conversation_id", F.col("opening_message").alias("customer_text"))
            return named.join(replies, "conversation_id").select(*columns, F.lit("index").alias("source"))
    if messages is not None:
        pairs = evidence_pairs(messages)
        if not pairs.isEmpty():
            return pairs.select(*columns).withColumn("source", F.lit("messages"))
    return seeds.evidence_rows(spark).select(*columns).withColumn("source", F.lit("starter"))
