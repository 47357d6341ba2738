"""Escalation signals of whole conversations (descriptive, no model)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions import text as tx
from threadlens.operators.conversations import message_order
from threadlens.operators.ordering import HotGroups, find_hot_groups, with_previous
from threadlens.params import Params


def conversation_signals(
    messages: DataFrame, p: Params, hot: HotGroups | None = None
) -> DataFrame:
    """Per conversation: follow-up flag, unresolved flag, one flag per keyword category.

    Keywords are searched in the customer's messages joined by spaces.  A keyword
    with k blanks spans at most k + 1 messages, so it is enough to look at every
    run of k + 1 messages; the joined text itself is never built.
    """
    hot = hot or find_hot_groups(messages, "conversation_id", p.hot_group_rows)
    key, customer = "conversation_id", F.col("role") == "customer"
    spans = max(k.count(" ") for words in p.signal_keywords.values() for k in words)
    texts = messages.select(
        key, "created_at", "tweet_id", "role", F.lower(F.coalesce("text", F.lit(""))).alias("low")
    )
    # the preceding messages of the same role, so brand messages do not intervene
    runs = with_previous(
        texts, key, ["created_at", "tweet_id"], "low", hot, lags=spans, within=["role"]
    )
    run = F.concat_ws(" ", *[F.col(f"prev{i}") for i in range(spans, 0, -1)], F.col("low"))
    return (
        runs.withColumn("run", run)
        .groupBy(key)
        .agg(
            (F.count_if(customer) >= p.followup_messages).alias("repeated_followups"),
            (F.max_by("role", message_order()) == "customer").alias("unresolved"),
            *[
                F.bool_or(customer & tx.contains_any(F.col("run"), words)).alias(category)
                for category, words in p.signal_keywords.items()
            ],
        )
        .na.fill(False)
    )


def keyword_signals(signals: DataFrame, p: Params, samples: int = 5) -> DataFrame:
    """Per category: conversations, share, and the first ids."""
    categories = list(p.signal_keywords)
    long = signals.selectExpr(
        "conversation_id",
        f"stack({len(categories)}, {', '.join(f'{c!r}, `{c}`' for c in categories)}) AS (category, hit)",
    )
    total = signals.agg(F.count("*").alias("total"))
    counts = long.groupBy("category").agg(F.count_if("hit").alias("count"))
    firsts = _first_ids(long.filter("hit"), samples)
    return (
        counts.withColumn("total", total.scalar())
        .join(firsts, "category", "left")
        .select(
            "category",
            "count",
            tx.percentage(F.col("count"), F.col("total")).alias("pct"),
            F.coalesce("sample_conversations", F.lit("")).alias("sample_conversations"),
        )
    )


def _first_ids(hits: DataFrame, n: int) -> DataFrame:
    from pyspark.sql.window import Window

    window = Window.partitionBy("category").orderBy("conversation_id")
    return (
        hits.select("category", "conversation_id")
        .withColumn("rn", F.row_number().over(window))
        .filter(F.col("rn") <= n)
        .groupBy("category")
        .agg(F.array_join(F.sort_array(F.collect_list("conversation_id")), ",").alias("sample_conversations"))
    )


def _flag_count(signals: DataFrame, flag: str) -> DataFrame:
    return signals.agg(F.count_if(flag).alias("count"), F.count("*").alias("_n")).select(
        "count", tx.percentage(F.col("count"), F.col("_n")).alias("pct")
    )


def repeated_followups(signals: DataFrame) -> DataFrame:
    return _flag_count(signals, "repeated_followups")


def unresolved(signals: DataFrame) -> DataFrame:
    return _flag_count(signals, "unresolved")


def any_escalation(signals: DataFrame, p: Params) -> DataFrame:
    flags = ["repeated_followups", "unresolved", *p.signal_keywords]
    hit = F.greatest(*[F.col(f).cast("int") for f in flags]) == 1
    return signals.agg(F.count_if(hit).alias("conversations_with_any_signal"), F.count("*").alias("_n")).select(
        "conversations_with_any_signal",
        tx.percentage(F.col("conversations_with_any_signal"), F.col("_n")).alias("pct"),
    )


def escalation_signal_table(signals: DataFrame, p: Params) -> DataFrame:
    """Tidy (signal, conversations, pct) table of every signal."""
    flags = [*p.signal_keywords, "repeated_followups", "unresolved"]
    counts = signals.agg(
        F.count("*").alias("total"), *[F.count_if(f).alias(f) for f in flags]
    )
    return counts.selectExpr(
        "total", f"stack({len(flags)}, {', '.join(f'{f!r}, `{f}`' for f in flags)}) AS (signal, conversations)"
    ).select("signal", "conversations", tx.percentage(F.col("conversations"), F.col("total")).alias("pct"))
