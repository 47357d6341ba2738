"""Profile of the raw message table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions import text as tx
from threadlens.sources.schemas import RAW_COLUMNS, require_columns


def profile_raw(tweets: DataFrame) -> DataFrame:
    """One row: rows, columns, direction counts, authors, nulls per column."""
    require_columns(tweets, RAW_COLUMNS)
    return tweets.agg(
        F.count("*").alias("total_rows"),
        F.lit(len(tweets.columns)).cast("bigint").alias("total_columns"),
        F.count_if(F.col("inbound")).alias("inbound_rows"),
        F.count_if(~F.col("inbound")).alias("outbound_rows"),
        F.count_distinct("author_id").alias("unique_authors"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in RAW_COLUMNS],
    )


def null_report(tweets: DataFrame) -> DataFrame:
    """(column_name, nulls, null_pct) from one pass over the table."""
    pairs = ", ".join(f"'{c}', null_{c}" for c in RAW_COLUMNS)
    return (
        profile_raw(tweets)
        .selectExpr("total_rows", f"stack({len(RAW_COLUMNS)}, {pairs}) AS (column_name, nulls)")
        .select("column_name", "nulls", tx.percentage(F.col("nulls"), F.col("total_rows")).alias("null_pct"))
    )
