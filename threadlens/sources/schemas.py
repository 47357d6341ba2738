"""Table layouts and column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_COLUMNS = [
    "tweet_id",
    "author_id",
    "inbound",
    "created_at",
    "text",
    "response_tweet_id",
    "in_response_to_tweet_id",
]

RAW_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

PROCESSED_COLUMNS = [
    "conversation_id",
    "tweet_id",
    "author_id",
    "role",
    "inbound",
    "created_at",
    "text",
    "text_original",
    "in_response_to_tweet_id",
    "response_tweet_id",
]

CONVERSATION_COLUMNS = [
    "conversation_id",
    "opening_message",
    "full_conversation",
    "num_messages",
    "num_customer_messages",
    "num_brand_replies",
    "customer_id",
]

ANNOTATION_COLUMNS = [
    "conversation_id",
    "primary_intent",
    "escalation",
    "escalation_reason",
    "confidence",
    "annotator_notes",
    "annotated_at",
]

ANNOTATION_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ANNOTATION_COLUMNS])

HUMAN_SCORE_COLUMNS = [
    "conversation_id",
    "human_groundedness",
    "human_correctness",
    "human_empathy",
    "human_actionability",
    "human_brand_tone",
    "human_overall",
]


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns the plan does not have; runs no job."""
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def human_score_errors(df: DataFrame) -> list[str]:
    """Problems of a human-score table's layout, empty when it is usable."""
    return [
        f"Missing required human annotation column: '{c}'"
        for c in missing_columns(df, HUMAN_SCORE_COLUMNS)
    ]


def resolve_column(df: DataFrame, *aliases: str) -> str:
    """Name of the first alias the table has."""
    for name in aliases:
        if name in df.columns:
            return name
    raise ValueError(f"None of the columns {list(aliases)} found in {df.columns}")


def select_known(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select([c for c in columns if c in df.columns])
