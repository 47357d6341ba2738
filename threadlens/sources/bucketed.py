"""Message and conversation tables bucketed by conversation, read without a shuffle.

Everything that works per conversation shuffles messages by their conversation.  A table that
is written in buckets of the conversation id keeps that shuffle: groupings and windows by
conversation read it as it lies, and two tables with the same number of buckets are joined
bucket by bucket.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators.ordering import HotGroups
from threadlens.sources.schemas import CONVERSATION_COLUMNS, PROCESSED_COLUMNS, select_known
from threadlens.sources.tables import checkpoint_folder

KEY = "conversation_id"


def write_buckets(
    df: DataFrame, name: str, buckets: int, order: list[str], hot: HotGroups | None = None, folder: str | None = None
) -> DataFrame:
    """Write ``df`` as the catalog table ``name`` and return it.

    Rows are dealt to one task per bucket, so that a bucket is one sorted file.  The groups
    in ``hot`` stay where they are: no task gathers one, and their buckets have more files.
    A table of that name is replaced.  The files are in ``folder``, by default the shared
    one of intermediate tables.
    """
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"not a table name: {name!r}")
    spark = df.sparkSession
    if hot is None or hot.table is None:
        dealt = df.repartition(buckets, KEY)
    else:
        keys = F.broadcast(hot.table.select(KEY))
        dealt = df.join(keys, KEY, "left_anti").select(*df.columns).repartition(buckets, KEY)
        dealt = dealt.unionByName(df.join(keys, KEY, "left_semi").select(*df.columns))
    path = f"{(folder or checkpoint_folder(spark)).rstrip('/')}/tables/{name}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, KEY).sortBy(KEY, *order).saveAsTable(name)
    return spark.table(name)


def write_processed_buckets(
    messages: DataFrame, name: str, buckets: int, hot: HotGroups | None = None, folder: str | None = None
) -> DataFrame:
    """Processed messages, their ten columns in order, only those present."""
    known = select_known(messages, PROCESSED_COLUMNS)
    return write_buckets(known, name, buckets, ["created_at", "tweet_id"], hot, folder)


def write_conversation_buckets(
    conversations: DataFrame, name: str, buckets: int, folder: str | None = None
) -> DataFrame:
    return write_buckets(select_known(conversations, [*CONVERSATION_COLUMNS, "part"]), name, buckets, ["part"], None, folder)


def is_bucketed(spark: SparkSession, name: str) -> int:
    """Number of buckets by conversation of a catalog table, 0 if it has none."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if KEY not in (rows.get("Bucket Columns") or ""):
        return 0
    return int(rows.get("Num Buckets") or 0)
