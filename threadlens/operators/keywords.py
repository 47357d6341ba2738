"""Substring search for a table of keywords of any number.

Every task holds a table of bounded size and looks for it in the texts it reads, so nothing
but the finds is moved: the few keywords of a length one by one, many by looking up all
windows of that length.

For larger tables texts are cut into overlapping pieces of bounded length; for each length
that a keyword has, all windows of that length are hashed, and the different hashes of a
piece meet the hashes of the keywords in one join.  What meets is verified, so a hash that
agrees by chance changes nothing.  The work follows the characters of the texts and the
number of different keyword lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.operators.ordering import HotGroups, with_previous
from threadlens.sources.tables import materialize

#: Characters of a piece, without what it shares with the next one.
PIECE_CHARS = 1_000
#: Keyword tables of so many rows are sent to every task, some megabytes; larger ones are shuffled.
BROADCAST_KEYWORDS = 50_000
#: So many keywords of one length are looked for one by one; a window costs as much as some hundreds of them.
FEW_KEYWORDS = 200


def keyword_table(spark, keywords: dict[str, list[str]]) -> DataFrame:
    """(category, keyword) of a mapping."""
    rows = [(c, k) for c, words in keywords.items() for k in words]
    return spark.createDataFrame(rows, "category string, keyword string")


def _found(texts: DataFrame, key: str, words: list[str]) -> DataFrame:
    """(key, keyword) of the texts (key, low), once per text."""
    by_length: dict[int, set[str]] = {}
    for word in words:
        by_length.setdefault(len(word), set()).add(word)
    schema = T.StructType([texts.schema[key]]).add("keyword", "string")
    few = FEW_KEYWORDS

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, low in enumerate(batch.column(1).to_pylist()):
                for n, own in by_length.items():
                    if len(own) <= few:
                        hits = [w for w in own if w in low]
                    else:
                        hits = own.intersection(low[j : j + n] for j in range(len(low) - n + 1))
                    found.extend(hits)
                    rows.extend([i] * len(hits))
            keys = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(found, pa.string())], names=schema.names)

    return texts.mapInArrow(find, schema)


def keyword_hits(texts: DataFrame, keywords: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Different (key, category, keyword) such that the lower-cased text contains the keyword.

    ``keywords`` are (category, keyword); they match as substrings, whatever their case.
    Null and empty keywords match nothing, null texts have no match.  Rows of the same
    key count as one.
    """
    known = keywords.filter("keyword <> ''").select("category", F.lower("keyword").alias("keyword")).distinct()
    known = materialize(known.withColumn("n", F.length("keyword")), "keywords")
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())
    if not lengths:
        return texts.select(key).limit(0).withColumns({"category": F.lit(""), "keyword": F.lit("")})
    longest = lengths[-1]
    low = texts.select(key, F.lower(text).alias("low")).filter("low <> ''")
    if known.count() <= BROADCAST_KEYWORDS:
        words = [r["keyword"] for r in known.select("keyword").distinct().collect()]
        found = _found(low, key, words)
        return found.join(F.broadcast(known), "keyword").select(key, "category", "keyword").distinct()
    starts = F.sequence(F.lit(0), F.length("low") - 1, F.lit(PIECE_CHARS))
    piece = lambda s: F.substring("low", s + 1, F.lit(PIECE_CHARS + longest - 1))
    pieces = low.select(key, F.explode(F.transform(starts, piece)).alias("piece"))

    def windows(n: int):
        ends = F.sequence(F.lit(1), F.length("piece") - (n - 1))
        hashes = F.transform(ends, lambda i: F.xxhash64(F.substring("piece", i, F.lit(n))))
        return F.when(F.length("piece") >= n, F.array_distinct(hashes))

    listed = F.flatten(F.array_compact(F.array(*[windows(n) for n in lengths])))
    seen = pieces.select(key, "piece", F.explode(F.array_distinct(listed)).alias("h"))
    hashed = known.select("category", "keyword", F.xxhash64("keyword").alias("h"))
    # few windows are keywords: pieces travel with those alone
    met = seen.join(hashed, "h")
    return met.filter(F.contains("piece", F.col("keyword"))).select(key, "category", "keyword").distinct()


def customer_runs(messages: DataFrame, keywords: DataFrame, hot: HotGroups) -> DataFrame:
    """(conversation_id, run): each customer message behind those before it that a keyword may begin in.

    A keyword with b blanks spans at most b + 1 messages joined by spaces.
    """
    blanks = F.max(F.length("keyword") - F.length(F.replace("keyword", F.lit(" "), F.lit(""))))
    spans = keywords.agg(blanks.alias("b")).first()["b"] or 0
    texts = messages.filter("role = 'customer'").select(
        "conversation_id", "created_at", "tweet_id", F.coalesce("text", F.lit("")).alias("own")
    )
    before = with_previous(texts, "conversation_id", ["created_at", "tweet_id"], "own", hot, lags=spans)
    run = F.concat_ws(" ", *[F.col(f"prev{i}") for i in range(spans, 0, -1)], F.col("own"))
    return before.select("conversation_id", run.alias("run"))


def conversation_keywords(messages: DataFrame, keywords: DataFrame, hot: HotGroups) -> DataFrame:
    """Different (conversation_id, category, keyword) found in the customer's messages, in order
    of time and joined by spaces."""
    return keyword_hits(customer_runs(messages, keywords, hot), keywords, "conversation_id", "run")


def keyword_flags(messages: DataFrame, keywords: DataFrame, categories: list[str], hot: HotGroups) -> DataFrame:
    """(conversation_id, one boolean per category) of every conversation."""
    hits = conversation_keywords(messages, keywords, hot)
    flags = hits.groupBy("conversation_id").agg(*[F.bool_or(F.col("category") == c).alias(c) for c in categories])
    ids = messages.select("conversation_id").distinct()
    return ids.join(flags, "conversation_id", "left").na.fill(False, categories)
