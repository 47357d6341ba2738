"""Descriptive analysis of a processed message table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators import conversations as cv
from threadlens.operators import language as lg
from threadlens.operators import signals as sg
from threadlens.operators.graph import thread_length_histogram
from threadlens.operators.ordering import find_hot_groups
from threadlens.operators.themes import Themes, discover_themes
from threadlens.params import Params
from threadlens.sources.tables import materialize


def explore(messages: DataFrame, p: Params) -> dict[str, DataFrame]:
    """All descriptive tables by name; each is lazy.

    Role switches and signals are written once, several tables read them.
    """
    hot = find_hot_groups(messages, "conversation_id", p.hot_group_rows)
    switches = materialize(cv.role_switches(messages, p, hot), "role-switches")
    signals = materialize(sg.conversation_signals(messages, p, hot), "signals")
    openings = cv.opening_messages(messages)
    return {
        "overview_counts": cv.overview_counts(messages),
        "thread_length_stats": cv.thread_length_stats(messages),
        "notable_conversations": cv.notable_conversations(messages),
        "role_balance": cv.role_balance(messages),
        "text_length_stats": cv.text_length_stats(messages),
        "temporal_span": cv.temporal_span(messages),
        "length_distribution": cv.length_distribution(messages),
        "length_percentiles": cv.length_percentiles(messages),
        "length_buckets": cv.length_buckets(messages),
        "thread_length_histogram": thread_length_histogram(messages),
        "participation": cv.participation(messages),
        "turn_structure": cv.turn_structure(messages),
        "response_depth": cv.response_depth(switches),
        "depth_distribution": cv.depth_distribution(switches),
        "brand_responsiveness": cv.brand_responsiveness(messages),
        "top_keywords": lg.top_keywords(messages, p.top_keywords),
        "top_bigrams": lg.top_phrases(messages, 2, p.top_phrases),
        "top_trigrams": lg.top_phrases(messages, 3, p.top_phrases),
        "message_types": lg.message_types(messages),
        "emotional_punctuation": lg.emotional_punctuation(messages),
        "emoji_usage": lg.emoji_usage(messages),
        "top_emojis": lg.top_emojis(messages, p.top_emojis),
        "keyword_themes": lg.keyword_themes(openings),
        "keyword_signals": sg.keyword_signals(signals, p),
        "repeated_followups": sg.repeated_followups(signals),
        "unresolved": sg.unresolved(signals),
        "any_escalation": sg.any_escalation(signals, p),
        "escalation_signal_table": sg.escalation_signal_table(signals, p),
    }


def chart_series(tables: dict[str, DataFrame], clusters: DataFrame | None = None) -> DataFrame:
    """The numbers behind the charts as one tidy table (chart, label, count, pct).

    Takes the result of ``explore`` and, if given, the theme clusters.  Charts show
    the 20 shortest thread lengths, the top 20 words and the 12 smallest depths.
    """

    def series(chart: str, df: DataFrame, label: str, count: str, pct: str | None = None):
        share = F.col(pct) if pct else F.lit(None).cast("double")
        return df.select(
            F.lit(chart).alias("chart"),
            F.col(label).cast("string").alias("label"),
            F.col(count).cast("bigint").alias("count"),
            share.alias("pct"),
        )

    roles = tables["overview_counts"].selectExpr(
        "stack(2, 'Customer', customer_messages, 'Brand', brand_replies) AS (label, count)"
    )
    turns = tables["turn_structure"].selectExpr(
        "stack(2, 'Single-turn', single_turn_count, single_turn_pct, "
        "'Multi-turn', multi_turn_count, multi_turn_pct) AS (label, count, pct)"
    )
    types = tables["message_types"].selectExpr(
        "stack(3, 'Questions', questions, questions_pct, 'Complaints', complaints, complaints_pct, "
        "'Exclamations', exclamation_msgs, exclamation_pct) AS (label, count, pct)"
    )
    lengths = tables["length_distribution"].orderBy("n").limit(20)
    words = tables["top_keywords"].orderBy(F.desc("count"), "word").limit(20)
    depths = tables["depth_distribution"].orderBy("depth").limit(12)
    parts = [
        series("conversation_length", lengths, "n", "conversations"),
        series("messages_per_thread", tables["length_buckets"], "bucket", "conversations", "pct"),
        series("customer_vs_brand", roles, "label", "count"),
        series("top_keywords", words, "word", "count"),
        series("turn_split", turns, "label", "count", "pct"),
        series("response_depth", depths, "depth", "conversations"),
        series("message_types", types, "label", "count", "pct"),
        series("escalation_signals", tables["escalation_signal_table"], "signal", "conversations", "pct"),
    ]
    if clusters is not None:
        named = clusters.withColumn("label", F.substring("theme_label", 1, 40))
        parts.append(series("theme_sizes", named, "label", "size", "frequency_pct"))
    return reduce(DataFrame.unionByName, parts)


def themes(messages: DataFrame, p: Params) -> Themes:
    """Clusters of the opening messages."""
    openings = cv.opening_messages(messages).select(
        F.col("conversation_id").alias("doc_id"), "text"
    )
    return discover_themes(openings, p)
