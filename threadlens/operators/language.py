"""Customer-language statistics: keywords, phrases, message types, emoji."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens import params as P
from threadlens.functions import text as tx


def customer_texts(messages: DataFrame) -> DataFrame:
    return messages.filter("role = 'customer'").select(
        F.coalesce("text", F.lit("")).alias("text")
    )


def _counts(texts: DataFrame, items: Column, name: str) -> DataFrame:
    return texts.select(F.explode(items).alias(name)).groupBy(name).agg(
        F.count("*").alias("count")
    )


def _top(counts: DataFrame, name: str, n: int) -> DataFrame:
    return counts.orderBy(F.desc("count"), name).limit(n)


def word_counts(texts: DataFrame) -> DataFrame:
    return _counts(texts, tx.alpha_words(F.col("text")), "word")


def top_keywords(messages: DataFrame, n: int) -> DataFrame:
    """Most frequent customer words outside the stop list; ties by word."""
    return _top(word_counts(customer_texts(messages)), "word", n)


def top_phrases(messages: DataFrame, size: int, n: int) -> DataFrame:
    """Most frequent runs of ``size`` words, taken after stop words are removed."""
    grams = tx.ngrams(tx.alpha_words(F.col("text")), size)
    return _top(_counts(customer_texts(messages), grams, "phrase"), "phrase", n)


def message_types(messages: DataFrame) -> DataFrame:
    """One row: questions, complaints and exclamations with their shares."""
    text = F.col("text")
    texts = customer_texts(messages).withColumn("low", F.lower("text"))
    counts = texts.agg(
        F.count_if(F.contains(text, F.lit("?"))).alias("questions"),
        F.count_if(tx.contains_any(F.col("low"), P.COMPLAINT_WORDS)).alias("complaints"),
        F.count_if(F.contains(text, F.lit("!"))).alias("exclamation_msgs"),
        F.count("*").alias("_total"),
    )
    share = {
        "questions_pct": "questions",
        "complaints_pct": "complaints",
        "exclamation_pct": "exclamation_msgs",
    }
    return counts.withColumns(
        {name: tx.percentage(F.col(c), F.col("_total")) for name, c in share.items()}
    ).drop("_total")


def emotional_punctuation(messages: DataFrame) -> DataFrame:
    text = F.col("text")
    return customer_texts(messages).agg(
        F.count_if(F.contains(text, F.lit("!!"))).alias("multiple_exclamations"),
        F.count_if(F.contains(text, F.lit("??"))).alias("multiple_questions"),
        F.count_if(tx.caps_heavy(text)).alias("mostly_caps"),
    )


def emoji_counts(messages: DataFrame) -> DataFrame:
    return _counts(customer_texts(messages), tx.emoji_chars(F.col("text")), "emoji")


def top_emojis(messages: DataFrame, n: int) -> DataFrame:
    return _top(emoji_counts(messages), "emoji", n)


def emoji_usage(messages: DataFrame) -> DataFrame:
    """One row: messages with an emoji, their share, distinct emoji."""
    found = customer_texts(messages).select(tx.emoji_chars(F.col("text")).alias("emoji"))
    # a message counts at its first emoji, or at the null that stands for none
    listed = found.select(F.posexplode_outer("emoji").alias("pos", "char"))
    per_char = listed.groupBy("char").agg(F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("messages"))
    some = F.col("char").isNotNull()
    return per_char.agg(
        F.coalesce(F.sum(F.when(some, F.col("messages"))), F.lit(0)).alias("messages_with_emoji"),
        F.coalesce(F.sum("messages"), F.lit(0)).alias("_total"),
        F.count_if(some).alias("total_unique_emojis"),
    ).select(
        "messages_with_emoji",
        tx.percentage(F.col("messages_with_emoji"), F.col("_total")).alias("emoji_pct"),
        "total_unique_emojis",
    )


def keyword_themes(texts: DataFrame) -> DataFrame:
    """Fixed word groups and how often their words occur; groups may be empty."""
    rows = [(tx.title_of(theme), word) for theme, words in P.KEYWORD_THEMES.items() for word in words]
    spark = texts.sparkSession
    lexicon = spark.createDataFrame(rows, "theme_label string, word string")
    hits = word_counts(texts).join(F.broadcast(lexicon), "word").groupBy("theme_label").agg(
        F.sum("count").alias("mentions")
    )
    return (
        lexicon.select("theme_label").distinct()
        .join(hits, "theme_label", "left")
        .select("theme_label", F.coalesce("mentions", F.lit(0)).alias("total_mentions"))
        .orderBy(F.desc("total_mentions"), "theme_label")
    )


def fallback_top_words(texts: DataFrame, n: int) -> DataFrame:
    return _top(word_counts(texts), "word", n)
