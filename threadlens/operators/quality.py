"""Cleaning and quality filtering of the message table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens import params as P
from threadlens.functions import text as tx
from threadlens.operators.common import beside
from threadlens.operators.ordering import (
    HotGroups,
    drop_short_groups,
    find_hot_groups,
    first_per_key,
    nulls_last,
)

MESSAGE_ORDER = ["conversation_id", "created_at", "tweet_id"]


def clean_messages(messages: DataFrame, p: P.Params) -> DataFrame:
    """Cleaned ``text``; the input is kept as ``text_original``."""
    return messages.withColumnRenamed("text", "text_original").select(
        "*", tx.once(tx.clean_text(F.col("text_original"), p)).alias("text")
    )


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    """One row: messages, modified messages and their share."""
    modified = F.count_if(F.col("text") != F.coalesce("text_original", F.lit("")))
    return cleaned.agg(F.count("*").alias("messages"), modified.alias("modified")).withColumn(
        "modified_pct", tx.percentage(F.col("modified"), F.col("messages"))
    )


def cleaning_samples(cleaned: DataFrame, n: int = 3, seed: int = 42) -> DataFrame:
    """A seeded sample of changed messages, before and after."""
    return (
        cleaned.filter(F.col("text") != F.col("text_original"))
        .orderBy(F.md5(F.concat("tweet_id", F.lit(f"|{seed}"))), "tweet_id")
        .limit(n)
        .select("tweet_id", "text_original", "text")
    )


def removal_reason(p: P.Params) -> Column:
    """First row-level rule a message fails; null for messages that pass."""
    text = F.col("text")
    reason = F.when(F.lit(False), F.lit(""))
    if p.remove_empty:
        reason = reason.when(tx.is_blank(text), F.lit("empty_text"))
    if p.remove_system_messages:
        system = tx.contains_any(F.lower(text), P.SYSTEM_PHRASES)
        reason = reason.when(system, F.lit("system_messages"))
    return reason.when(F.length(text) < p.min_text_length, F.lit("too_short"))


def _first_copies(messages: DataFrame) -> DataFrame:
    """(author_id, _digest, the order) of the first message of every (author, text) pair.

    Texts that agree have the same SHA-256, so the texts themselves need not move.
    """
    digest = F.unhex(F.sha2(F.col("text"), 256)).alias("_digest")
    narrow = messages.select("author_id", digest, *MESSAGE_ORDER)
    return first_per_key(narrow, ["author_id", "_digest"], nulls_last(MESSAGE_ORDER))


def _without_duplicates(messages: DataFrame, hot: HotGroups, twice: bool) -> DataFrame:
    """The first message of every (author, text) pair.

    Where messages may be read ``twice``, a text moves once, to its conversation, where it meets
    the first copy's narrow row, and what follows by conversation needs no further shuffle.
    Oversized conversations are dealt by their texts instead.
    """
    if not twice or hot.table is not None:
        return first_per_key(messages, ["author_id", "text"], nulls_last(MESSAGE_ORDER))
    key, *order = MESSAGE_ORDER
    digest = F.unhex(F.sha2(F.col("text"), 256))
    rows = messages.withColumn("_digest", digest).withColumn("_first", F.lit(False))
    both = rows.unionByName(_first_copies(messages).withColumn("_first", F.lit(True)), allowMissingColumns=True)
    # the row after a first copy's is that message: there is one in a group at most, and none is before it
    copies = Window.partitionBy(key, "author_id", "_digest").orderBy(F.desc("_first"), *nulls_last(order))
    kept = both.repartition(key).withColumn("_after", F.lag("_first").over(copies))
    return kept.filter("_after AND NOT _first").select(*messages.columns)


def quality_filter(
    messages: DataFrame, p: P.Params, hot: HotGroups | None = None, twice: bool = False
) -> DataFrame:
    """Messages that pass all rules, in conversations that stay long enough.

    ``twice`` reads the messages a second time, so that less is shuffled.
    """
    hot = hot or find_hot_groups(messages, "conversation_id", p.hot_group_rows)
    passed = messages.filter(removal_reason(p).isNull())
    if p.remove_duplicates:
        passed = _without_duplicates(passed, hot, twice)
    return drop_short_groups(passed, "conversation_id", p.min_thread_length, hot)


def quality_removals(messages: DataFrame, p: P.Params) -> DataFrame:
    """(stage, removed) of every stage that is switched on, in order.

    Counts add up over grouped sizes: the message table is grouped once by
    (author, text, conversation) order and never joined.
    """
    reasons = messages.withColumn("reason", removal_reason(p))
    row_level = reasons.agg(
        F.count_if(F.col("reason") == "empty_text").alias("empty_text"),
        F.count_if(F.col("reason") == "system_messages").alias("system_messages"),
        F.count_if(F.col("reason") == "too_short").alias("too_short"),
        F.count_if(F.col("reason").isNull()).alias("passed"),
    )
    unique = messages.filter(removal_reason(p).isNull())
    if p.remove_duplicates:
        unique = _first_copies(unique)
    sizes = unique.groupBy("conversation_id").agg(F.count("*").alias("n"))
    short = F.col("n") < p.min_thread_length
    after = sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("unique_rows"),
        F.coalesce(F.sum(F.when(short, F.col("n"))), F.lit(0)).alias("short_conversations"),
        F.count_if(short).alias("short_conversations_threads"),
    )
    stages = []
    if p.remove_empty:
        stages.append(("empty_text", "empty_text"))
    if p.remove_system_messages:
        stages.append(("system_messages", "system_messages"))
    stages.append(("too_short", "too_short"))
    if p.remove_duplicates:
        stages.append(("duplicates", "passed - unique_rows"))
    stages.append(("short_conversations", "short_conversations"))
    stages.append(("short_conversations_threads", "short_conversations_threads"))
    pairs = ", ".join(f"'{name}', {i}L, {expr}" for i, (name, expr) in enumerate(stages))
    return beside(row_level, after).selectExpr(
        f"stack({len(stages)}, {pairs}) AS (stage, position, removed)"
    )
