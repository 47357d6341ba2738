"""Preprocessing run: raw messages to the processed and conversation tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from threadlens.operators.conversations import conversation_table, preprocessing_summary
from threadlens.operators.graph import build_threads, filter_brand
from threadlens.operators.ordering import HotGroups, find_hot_groups
from threadlens.operators.quality import clean_messages, quality_filter, quality_removals
from threadlens.params import Params
from threadlens.sources import writers
from threadlens.sources.tables import materialize


@dataclass(frozen=True)
class Preprocessed:
    messages: DataFrame
    conversations: DataFrame
    removals: DataFrame
    summary: DataFrame


def clean_and_filter(
    threads: DataFrame, p: Params, hot: HotGroups | None = None
) -> DataFrame:
    """Cleaned, quality-filtered messages of a threaded message table."""
    hot = hot or find_hot_groups(threads, "conversation_id", p.hot_group_rows)
    return quality_filter(clean_messages(threads, p), p, hot, twice=True)


def preprocess(tweets: DataFrame, p: Params) -> Preprocessed:
    """Filter to the brand, build threads, clean, filter, derive both tables.

    Cleaning comes before the quality rules, so a message that is only a URL
    counts as empty.  Brand rows, cleaned and final messages are written once each
    because several steps read them.
    """
    selected = materialize(filter_brand(tweets, p), "brand-rows")
    cleaned = materialize(clean_messages(build_threads(selected, p), p), "cleaned")
    hot = find_hot_groups(cleaned, "conversation_id", p.hot_group_rows)
    messages = materialize(quality_filter(cleaned, p, hot, twice=True), "messages")
    removals = quality_removals(cleaned, p)
    return Preprocessed(
        messages,
        conversation_table(messages, p, hot),
        removals,
        preprocessing_summary(messages, tweets, removals),
    )


def export(result: Preprocessed, folder: str, fmt: str = "parquet") -> None:
    folder = folder.rstrip("/")
    writers.write_processed(result.messages, f"{folder}/processed_conversations", fmt)
    writers.write_conversations(result.conversations, f"{folder}/annotation_ready", fmt)
    writers.write_json(result.summary, f"{folder}/preprocessing_summary")
