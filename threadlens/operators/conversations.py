"""Conversation-level tables and descriptive statistics.

Statistics are computed from one row per conversation, or from a histogram of
sizes, so the final single-row aggregates see little data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.functions import text as tx
from threadlens.operators.common import beside
from threadlens.operators.graph import message_sequence, thread_sizes
from threadlens.operators.ordering import (
    HotGroups,
    find_hot_groups,
    join_groups,
    with_previous,
)
from threadlens.params import REPLY_WHEN_NO_BRAND_LINE, REPLY_WHEN_NO_TRANSCRIPT, Params
from threadlens.sources.tables import materialize


def message_order() -> Column:
    """Chronological order with missing dates last and ties by tweet id."""
    return F.struct(F.col("created_at").isNull(), "created_at", "tweet_id")


def _percentiles(sizes: DataFrame, column: str, points: dict[str, float], digits: int):
    """Exact interpolated percentiles from a histogram of the column."""
    histogram = sizes.groupBy(column).agg(F.count("*").alias("freq"))
    return histogram.agg(
        *[
            F.round(F.percentile(column, F.lit(q), F.col("freq")), digits).alias(name)
            for name, q in points.items()
        ]
    )


def overview_counts(messages: DataFrame) -> DataFrame:
    """One row: conversations, messages per role, distinct customers.

    Messages are first combined per (conversation, author, role), so the distinct
    counts run on few rows.
    """
    customer, brand, n = F.col("role") == "customer", F.col("role") == "brand", F.col("n")
    sizes = messages.groupBy("conversation_id", "author_id", "role").agg(F.count("*").alias("n"))

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    return sizes.agg(
        F.count_distinct("conversation_id").alias("total_conversations"),
        total(F.lit(True)).alias("total_messages"),
        total(customer).alias("customer_messages"),
        total(brand).alias("brand_replies"),
        F.count_distinct(F.when(customer, F.col("author_id"))).alias("unique_customers"),
    )


def thread_length_stats(messages: DataFrame) -> DataFrame:
    histogram = thread_sizes(messages).groupBy("n").agg(F.count("*").alias("freq"))
    total = F.sum("freq")
    mean = F.sum(F.col("n") * F.col("freq")) / total
    # sums of integers: exact, whatever the order of partial results
    squares = F.sum(F.col("n") * F.col("n") * F.col("freq"))
    linear = F.sum(F.col("n") * F.col("freq"))
    variance = (squares - linear * linear / total) / F.nullif(total - 1, F.lit(0))

    def quantile(q):
        return F.round(F.percentile("n", F.lit(q), F.col("freq")), 2)

    return histogram.agg(
        F.round(mean, 2).alias("mean"),
        quantile(0.5).alias("median"),
        F.round(F.sqrt(variance), 2).alias("std"),
        F.min("n").alias("min"),
        F.max("n").alias("max"),
        quantile(0.25).alias("q25"),
        quantile(0.75).alias("q75"),
    )


def notable_conversations(messages: DataFrame) -> DataFrame:
    """Longest and shortest conversation; the smallest id wins ties."""
    sizes = thread_sizes(messages)
    longest = F.min_by("conversation_id", F.struct(-F.col("n"), "conversation_id"))
    shortest = F.min_by("conversation_id", F.struct("n", "conversation_id"))
    return sizes.agg(
        longest.alias("longest_id"),
        F.max("n").alias("longest_length"),
        shortest.alias("shortest_id"),
        F.min("n").alias("shortest_length"),
    )


def role_balance(messages: DataFrame) -> DataFrame:
    """Mean messages per role and their ratio; no row unless both roles occur."""
    return (
        thread_sizes(messages)
        .agg(
            F.round(F.avg("n_customer"), 2).alias("avg_customer_msgs_per_thread"),
            F.round(F.avg("n_brand"), 2).alias("avg_brand_replies_per_thread"),
            F.round(
                F.sum("n_customer") / F.nullif(F.sum("n_brand"), F.lit(0)), 2
            ).alias("customer_to_brand_ratio"),
            F.sum("n_customer").alias("_c"),
            F.sum("n_brand").alias("_b"),
        )
        .filter("_c > 0 AND _b > 0")
        .drop("_c", "_b")
    )


def text_length_stats(messages: DataFrame) -> DataFrame:
    """Text length overall and per role, from one histogram of (role, length)."""
    lengths = messages.select("role", F.length(F.coalesce("text", F.lit(""))).alias("len"))
    histogram = lengths.groupBy("role", "len").agg(F.count("*").alias("freq"))

    scopes = F.when(
        F.col("role").isin("customer", "brand"), F.array(F.lit("all"), F.col("role"))
    ).otherwise(F.array(F.lit("all")))
    both = histogram.select(F.explode(scopes).alias("scope"), "len", "freq")
    return both.groupBy("scope").agg(
        F.round(F.sum(F.col("len").cast("bigint") * F.col("freq")) / F.sum("freq"), 2).alias("mean"),
        F.round(F.percentile("len", F.lit(0.5), F.col("freq")), 2).alias("median"),
        F.max("len").cast("bigint").alias("max"),
        F.min("len").cast("bigint").alias("min"),
    )


def temporal_span(messages: DataFrame) -> DataFrame:
    """First and last date (epoch seconds) and the whole days between them."""
    seconds = F.unix_seconds("created_at")
    return (
        messages.filter("created_at IS NOT NULL")
        .agg(F.min(seconds).alias("earliest"), F.max(seconds).alias("latest"))
        .filter("earliest IS NOT NULL")
        .withColumn("span_days", F.floor((F.col("latest") - F.col("earliest")) / 86400))
    )


def length_distribution(messages: DataFrame) -> DataFrame:
    return thread_sizes(messages).groupBy("n").agg(F.count("*").alias("conversations"))


def length_percentiles(messages: DataFrame) -> DataFrame:
    points = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}
    return _percentiles(thread_sizes(messages), "n", points, 1)


def participation(messages: DataFrame) -> DataFrame:
    """Per role: mean, median and maximum per conversation, conversations without."""
    per_role = thread_sizes(messages).selectExpr(
        "stack(2, 'customer', n_customer, 'brand', n_brand) AS (role, k)"
    )
    histogram = per_role.groupBy("role", "k").agg(F.count("*").alias("freq"))
    return (
        histogram.groupBy("role")
        .agg(
            F.round(F.sum(F.col("k") * F.col("freq")) / F.sum("freq"), 2).alias("mean"),
            F.round(F.percentile("k", F.lit(0.5), F.col("freq")), 2).alias("median"),
            F.max("k").alias("max"),
            F.coalesce(F.sum(F.when(F.col("k") == 0, F.col("freq"))), F.lit(0)).alias(
                "conversations_with_zero"
            ),
        )
        .filter(F.col("max") > 0)
    )


def turn_structure(messages: DataFrame) -> DataFrame:
    counts = thread_sizes(messages).agg(
        F.count_if(F.col("n") == 2).alias("single_turn_count"),
        F.count_if(F.col("n") > 2).alias("multi_turn_count"),
        F.count("*").alias("total"),
    )
    return counts.withColumns(
        {
            "single_turn_pct": tx.percentage(F.col("single_turn_count"), F.col("total")),
            "multi_turn_pct": tx.percentage(F.col("multi_turn_count"), F.col("total")),
        }
    )


def length_buckets(messages: DataFrame) -> DataFrame:
    """Conversations per length bucket; single-message ones are in none."""
    # Bucket labels and bounds.
    buckets = [
        ("2 messages", 2, 2),
        ("3-4 messages", 3, 4),
        ("5-6 messages", 5, 6),
        ("7-10 messages", 7, 10),
        ("11+ messages", 11, None),
    ]

    def inside(low, high):
        return F.col("n") >= low if high is None else F.col("n").between(low, high)

    counts = thread_sizes(messages).agg(
        F.count("*").alias("total"),
        *[F.count_if(inside(low, high)).alias(f"b{i}") for i, (_, low, high) in enumerate(buckets)],
    )
    pairs = ", ".join(f"{i}L, '{label}', b{i}" for i, (label, _, _) in enumerate(buckets))
    return counts.selectExpr(
        "total", f"stack({len(buckets)}, {pairs}) AS (position, bucket, conversations)"
    ).select(
        "position",
        "bucket",
        "conversations",
        tx.percentage(F.col("conversations"), F.col("total")).alias("pct"),
    )


def brand_responsiveness(messages: DataFrame) -> DataFrame:
    counts = thread_sizes(messages).agg(
        F.count_if(F.col("n_brand") == 0).alias("conversations_without_brand_reply"),
        F.count("*").alias("_total"),
    )
    replied = F.col("_total") - F.col("conversations_without_brand_reply")
    return counts.select(
        "conversations_without_brand_reply",
        tx.percentage(replied, F.col("_total")).alias("brand_reply_rate"),
    )


def role_switches(
    messages: DataFrame, p: Params, hot: HotGroups | None = None
) -> DataFrame:
    """Per conversation: messages, role changes and exchange depth."""
    hot = hot or find_hot_groups(messages, "conversation_id", p.hot_group_rows)
    slim = messages.select("conversation_id", "created_at", "tweet_id", "role")
    ordered = with_previous(slim, "conversation_id", ["created_at", "tweet_id"], "role", hot)
    return (
        ordered.groupBy("conversation_id")
        .agg(
            F.count("*").alias("total_messages"),
            F.count_if(F.col("role") != F.col("prev1")).alias("role_switches"),
        )
        .withColumn("depth", F.expr("(role_switches + 1) DIV 2"))
    )


def response_depth(switches: DataFrame) -> DataFrame:
    return switches.groupBy("role_switches").agg(
        F.count("*").alias("freq"), F.sum("depth").alias("depths")
    ).agg(
        F.round(F.sum(F.col("role_switches") * F.col("freq")) / F.sum("freq"), 2).alias("mean_switches"),
        F.round(F.percentile("role_switches", F.lit(0.5), F.col("freq")), 2).alias("median_switches"),
        F.max("role_switches").alias("max_switches"),
        F.round(F.sum("depths") / F.sum("freq"), 2).alias("mean_depth"),
    )


def depth_distribution(switches: DataFrame, n: int = 15) -> DataFrame:
    """Conversations per exchange depth, the ``n`` smallest depths."""
    return (
        switches.groupBy("depth").agg(F.count("*").alias("conversations")).orderBy("depth").limit(n)
    )


def last_speaker(messages: DataFrame) -> DataFrame:
    return messages.groupBy("conversation_id").agg(F.max_by("role", message_order()).alias("last_role"))


def opening_messages(messages: DataFrame, min_length: int = 10) -> DataFrame:
    """First customer message of every conversation, if longer than ``min_length``."""
    return (
        messages.filter("role = 'customer'")
        .groupBy("conversation_id")
        .agg(F.min_by("text", message_order()).alias("text"))
        .filter(F.length(tx.ustrip(F.col("text"))) > min_length)
    )


def evidence_pairs(messages: DataFrame) -> DataFrame:
    """First customer message and first brand message of conversations with both."""
    customer, brand = F.col("role") == "customer", F.col("role") == "brand"
    return (
        messages.groupBy("conversation_id")
        .agg(
            F.min_by("text", F.when(customer, message_order())).alias("customer_text"),
            F.min_by("text", F.when(brand, message_order())).alias("brand_reply"),
            F.count_if(customer).alias("_c"),
            F.count_if(brand).alias("_b"),
        )
        .filter("_c > 0 AND _b > 0")
        .drop("_c", "_b")
    )


def conversation_table(
    messages: DataFrame, p: Params, hot: HotGroups | None = None
) -> DataFrame:
    """One row per conversation and ``part`` with opening message and tagged transcript.

    A transcript longer than ``p.transcript_lines`` lines is cut into consecutive
    parts, one row each, so that no row grows without bound; joining the parts
    with a newline gives the whole transcript.
    """
    hot = hot or find_hot_groups(messages, "conversation_id", p.hot_group_rows)
    key = "conversation_id"
    slim = messages.select(key, "tweet_id", "created_at", "role", "author_id", "text")
    ordered = message_sequence(slim, p, hot)
    customer = F.col("role") == "customer"
    line = F.concat(tx.role_tag(F.col("role")), F.lit(" "), F.col("text"))
    parts = (
        ordered.withColumn("part", F.expr(f"(seq - 1) DIV {p.transcript_lines}"))
        .groupBy(key, "part")
        .agg(
            F.sort_array(F.collect_list(F.struct("seq", line.alias("line")))).alias("lines"),
            F.count("*").alias("n"),
            F.count_if(customer).alias("n_customer"),
            F.min(F.when(customer, F.struct("seq", "text", "author_id"))).alias("first"),
        )
        .select(
            key,
            "part",
            F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("full_conversation"),
            "n",
            "n_customer",
            "first",
        )
    )
    totals = {
        "first": F.min("first"),
        "num_messages": F.sum("n"),
        "num_customer_messages": F.sum("n_customer"),
    }
    if hot.table is None:
        # at most bound / transcript_lines parts per conversation
        whole = Window.partitionBy(key)
        joined = parts.withColumns({c: agg.over(whole) for c, agg in totals.items()})
    else:
        parts = materialize(parts, "transcript-parts")
        per_group = parts.groupBy(key).agg(*[agg.alias(c) for c, agg in totals.items()])
        joined = join_groups(
            parts.select(key, "part", "full_conversation"), per_group, key, "part", hot
        )
    return joined.select(
        key,
        F.coalesce("first.text", F.lit("")).alias("opening_message"),
        "full_conversation",
        "num_messages",
        "num_customer_messages",
        (F.col("num_messages") - F.col("num_customer_messages")).alias("num_brand_replies"),
        F.coalesce("first.author_id", F.lit("")).alias("customer_id"),
        "part",
    )


def first_brand_replies(parts: DataFrame, p: Params) -> DataFrame:
    """(conversation_id, reply): first brand line of every conversation.

    ``parts`` is a conversation table; the parts of a transcript are searched in order,
    so the answer does not depend on where transcripts are cut.  Stock texts stand for
    an empty transcript and for one without a brand line.
    """
    line = tx.brand_line(F.col("full_conversation"), p.brand)
    filled = F.coalesce(F.col("full_conversation") != "", F.lit(False))
    return (
        parts.select("conversation_id", "part", line.alias("_line"), filled.alias("_filled"))
        .groupBy("conversation_id")
        .agg(
            F.min(F.when(F.col("_line").isNotNull(), F.struct("part", "_line"))).alias("_hit"),
            F.bool_or("_filled").alias("_filled"),
        )
        .select(
            "conversation_id",
            F.when(~F.col("_filled"), F.lit(REPLY_WHEN_NO_TRANSCRIPT))
            .when(F.col("_hit").isNull(), F.lit(REPLY_WHEN_NO_BRAND_LINE))
            .otherwise(F.col("_hit._line"))
            .alias("reply"),
        )
    )


def preprocessing_summary(final: DataFrame, raw_rows: DataFrame, removals: DataFrame) -> DataFrame:
    """One row: run totals, removal counts per stage, thread lengths, roles.

    ``raw_rows`` is the unfiltered table, ``removals`` the (stage, removed) table.
    """
    sizes = thread_sizes(final).groupBy("n").agg(
        F.count("*").alias("freq"),
        F.sum("n_customer").alias("c"),
        F.sum("n_brand").alias("b"),
    )
    total = F.sum("freq")
    linear = F.sum(F.col("n") * F.col("freq"))
    squares = F.sum(F.col("n") * F.col("n") * F.col("freq"))
    variance = (squares - linear * linear / total) / F.nullif(total - 1, F.lit(0))

    def zero(x, digits=None):
        x = x if digits is None else F.round(x, digits)
        return F.coalesce(x, F.lit(0))

    threads = sizes.agg(
        zero(linear).alias("final_total_messages"),
        zero(total).alias("final_total_conversations"),
        zero(linear / total, 2).alias("mean_length"),
        zero(F.percentile("n", F.lit(0.5), F.col("freq")), 2).alias("median_length"),
        zero(F.max("n")).alias("max_length"),
        zero(F.min("n")).alias("min_length"),
        zero(F.sqrt(variance), 2).alias("std_length"),
        zero(F.sum("c")).alias("customer_messages"),
        zero(F.sum("b")).alias("brand_messages"),
    )
    stages = ["empty_text", "system_messages", "too_short", "duplicates",
              "short_conversations", "short_conversations_threads"]
    removed = removals.agg(
        *[F.sum(F.when(F.col("stage") == s, F.col("removed"))).alias(f"removed_{s}") for s in stages]
    )
    raw = raw_rows.agg(F.count("*").alias("raw_total_rows"))
    return beside(beside(raw, threads), removed).withColumn(
        "retention_rate",
        tx.percentage(F.col("final_total_messages"), F.col("raw_total_rows"), 2),
    )
