"""Reply-graph operators: brand neighbourhood, thread building, thread statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import ustrip
from threadlens.operators.ordering import (
    HotGroups,
    find_hot_groups,
    first_per_key,
    nulls_last,
    numbered,
    with_sequence,
)
from threadlens.params import Params
from threadlens.sources.tables import materialize


def is_brand(author: str, brand: str):
    return F.lower(F.col(author)) == F.lower(F.lit(brand))


def brand_messages(tweets: DataFrame, p: Params) -> DataFrame:
    """Rows written by the brand; the author match ignores case."""
    return tweets.filter(is_brand("author_id", p.brand))


def top_brands(tweets: DataFrame, n: int = 20) -> DataFrame:
    """Outbound authors by number of messages."""
    return (
        tweets.filter(~F.col("inbound") & F.col("author_id").isNotNull())
        .groupBy("author_id")
        .agg(F.count("*").alias("messages"))
        .orderBy(F.desc("messages"), "author_id")
        .limit(n)
    )


def require_brand(tweets: DataFrame, p: Params) -> DataFrame:
    """The table itself, or an error that names the largest brands."""
    if brand_messages(tweets, p).isEmpty():
        known = [f"{r['author_id']}: {r['messages']}" for r in top_brands(tweets).collect()]
        raise ValueError(f"Brand '{p.brand}' not found in dataset. Largest: {known}")
    return tweets


def reply_edges(tweets: DataFrame) -> DataFrame:
    """(tweet_id, response_id) pairs from the comma-separated response lists."""
    ids = F.transform(F.split("response_tweet_id", ","), ustrip)
    return tweets.select("tweet_id", F.explode(ids).alias("response_id")).filter("response_id <> ''")


def parent_edges(tweets: DataFrame) -> DataFrame:
    """(tweet_id, parent_id) pairs of the messages that answer another one."""
    return tweets.filter("in_response_to_tweet_id IS NOT NULL").select(
        "tweet_id", ustrip(F.col("in_response_to_tweet_id")).alias("parent_id")
    )


def brand_seed(tweets: DataFrame, p: Params) -> DataFrame:
    """Ids of brand messages, of messages they answer and of answers to them."""
    brand = brand_messages(tweets, p)
    brand_ids = brand.select("tweet_id")
    answered = parent_edges(brand).select(F.col("parent_id").alias("tweet_id"))
    answered = tweets.select("tweet_id").join(answered, "tweet_id", "left_semi")
    answers = parent_edges(tweets).join(
        brand_ids.withColumnRenamed("tweet_id", "parent_id"), "parent_id", "left_semi"
    )
    return brand_ids.union(answered).union(answers.select("tweet_id")).distinct()


def _neighbours(tweets: DataFrame) -> DataFrame:
    """Directed steps along which a kept message pulls in others."""
    parents = parent_edges(tweets)
    return (
        parents.select(F.col("tweet_id").alias("src"), F.col("parent_id").alias("dst"))
        .union(parents.select(F.col("parent_id").alias("src"), F.col("tweet_id").alias("dst")))
        .union(reply_edges(tweets).select("tweet_id", "response_id"))
    )


def reply_columns(tweets: DataFrame) -> DataFrame:
    """The narrow columns of the reply graph, written once for all steps."""
    columns = ["tweet_id", "author_id", "inbound", "response_tweet_id", "in_response_to_tweet_id"]
    return materialize(tweets.select(*columns), "reply-columns")


def expand_brand(tweets: DataFrame, p: Params) -> tuple[DataFrame, int, bool]:
    """Ids reachable from the seed, the number of rounds used, and whether that is all.

    Without ``max_expansion_rounds`` it always is.

    Only the ids found in the previous round are joined with the neighbour list,
    and every round's new ids are written out, so the plan does not grow.
    """
    ids = tweets.select("tweet_id")
    # steps to ids outside the table lead nowhere
    steps = _neighbours(tweets).join(ids.withColumnRenamed("tweet_id", "dst"), "dst", "left_semi")
    steps = materialize(steps.select("src", "dst"), "reply-steps")
    frontier = materialize(brand_seed(tweets, p), "frontier")
    kept = frontier
    rounds, converged = 0, False
    while p.max_expansion_rounds is None or rounds < p.max_expansion_rounds:
        rounds += 1
        found = (
            steps.join(frontier.withColumnRenamed("tweet_id", "src"), "src", "left_semi")
            .select(F.col("dst").alias("tweet_id"))
            .distinct()
            .join(kept, "tweet_id", "left_anti")
        )
        frontier = materialize(found, "frontier")
        if frontier.isEmpty():
            converged = True
            break
        kept = kept.union(frontier)
    return kept, rounds, converged


def filter_brand(tweets: DataFrame, p: Params) -> DataFrame:
    """All messages of conversations that involve the brand."""
    kept, *_ = expand_brand(require_brand(reply_columns(tweets), p), p)
    return tweets.join(kept, "tweet_id", "left_semi")


def brand_filter_report(tweets: DataFrame, p: Params) -> DataFrame:
    """One row: sizes before and after, retention, rounds, brand/customer counts.

    ``converged`` tells whether the last round found nothing new.
    """
    slim = reply_columns(tweets)
    kept, rounds, converged = expand_brand(slim, p)
    flagged = slim.join(kept.withColumn("kept", F.lit(True)), "tweet_id", "left")
    kept_flag = F.coalesce("kept", F.lit(False))
    brand = F.coalesce(is_brand("author_id", p.brand), F.lit(False))
    return flagged.agg(
        F.count("*").alias("original_rows"),
        F.count_if(kept_flag).alias("filtered_rows"),
        F.count_if(~kept_flag).alias("removed_rows"),
        F.round(F.count_if(kept_flag) * 100.0 / F.count("*"), 1).alias("retention_pct"),
        F.count_if(kept_flag & brand).alias("brand_messages"),
        F.count_if(kept_flag & ~brand).alias("customer_messages"),
    ).withColumns({"rounds": F.lit(rounds).cast("bigint"), "converged": F.lit(converged)})


def with_role(tweets: DataFrame, p: Params) -> DataFrame:
    """``brand`` for the brand's own messages, ``customer`` for everybody else."""
    return tweets.withColumn(
        "role", F.when(is_brand("author_id", p.brand), "brand").otherwise("customer")
    )


def latest_per_id(tweets: DataFrame) -> DataFrame:
    """One row per tweet id, the latest when an id occurs repeatedly."""
    order = [F.col("created_at").desc_nulls_last()]
    # further columns make the choice the same in every evaluation
    order += nulls_last(["in_response_to_tweet_id", "response_tweet_id", "author_id", "text"])
    return first_per_key(tweets, ["tweet_id"], order)


def thread_roots(tweets: DataFrame) -> DataFrame:
    """Ids of messages that answer nothing, or nothing in the table."""
    children = parent_edges(tweets)
    ids = tweets.select(F.col("tweet_id").alias("parent_id"))
    orphans = children.join(ids, "parent_id", "left_anti").select("tweet_id")
    starts = tweets.filter("in_response_to_tweet_id IS NULL").select("tweet_id")
    return starts.union(orphans)


def thread_members(tweets: DataFrame, max_depth: int | None) -> DataFrame:
    """(tweet_id, root_id, depth) of all messages at most ``max_depth`` below a root.

    Without a limit, of all messages that reach a root at all.

    Every message starts with a pointer to its parent; each round replaces the
    pointer by the pointer of the message it points to, so a path of length n is
    resolved in log2(n) rounds.  Messages deeper than the limit, and messages on
    reply cycles, never reach a root within the limit and drop out.

    A message with very many answers makes its id a hot join key.  Both join
    inputs are plain written tables, which lets adaptive execution split it.
    """
    within = F.lit(True) if max_depth is None else F.col("depth") <= max_depth
    parents = tweets.select(
        "tweet_id", ustrip(F.col("in_response_to_tweet_id")).alias("parent_id")
    )
    ids = tweets.select(F.col("tweet_id").alias("parent_id"), F.lit(True).alias("known"))
    # messages without a parent pointer need no look-up and would all share a null key
    starts = parents.filter("parent_id IS NULL").withColumn("known", F.lit(None).cast("boolean"))
    answers = parents.filter("parent_id IS NOT NULL").join(ids, "parent_id", "left")
    pointers = (
        starts.unionByName(answers)
        .select(
            "tweet_id",
            F.when(F.col("known"), F.col("parent_id")).otherwise(F.col("tweet_id")).alias("ptr"),
            F.when(F.col("known"), 1).otherwise(0).cast("bigint").alias("depth"),
            F.col("known").isNull().alias("resolved"),
        )
        .filter(within)
    )
    pointers = materialize(pointers, "pointers")
    # a cycle never resolves; pointers along a path reach twice as far each round
    reach, longest = 1, tweets.count()
    while reach <= 2 * longest and not pointers.filter("NOT resolved").isEmpty():
        reach *= 2
        target = pointers.select(
            F.col("tweet_id").alias("ptr"),
            F.col("ptr").alias("next_ptr"),
            F.col("depth").alias("next_depth"),
            F.col("resolved").alias("next_resolved"),
        )
        moved = (
            pointers.filter("NOT resolved")
            .join(target, "ptr")
            .select(
                "tweet_id",
                F.col("next_ptr").alias("ptr"),
                (F.col("depth") + F.col("next_depth")).alias("depth"),
                F.col("next_resolved").alias("resolved"),
            )
            .filter(within)
        )
        pointers = materialize(pointers.filter("resolved").union(moved), "pointers")
    return pointers.filter("resolved").select("tweet_id", F.col("ptr").alias("root_id"), "depth")


def thread_depth_report(tweets: DataFrame, p: Params) -> DataFrame:
    """One row: messages, messages in threads, messages too deep or on a reply cycle."""
    slim = materialize(tweets.select("tweet_id", "in_response_to_tweet_id"), "reply-pointers")
    placed = thread_members(slim, p.max_thread_depth).agg(F.count("*").alias("placed"))
    total = slim.agg(F.countDistinct("tweet_id").alias("messages"))
    return total.join(placed).select(
        "messages", "placed", (F.col("messages") - F.col("placed")).alias("dropped")
    )


def build_threads(tweets: DataFrame, p: Params, unique_ids: bool = False) -> DataFrame:
    """Message table with ``conversation_id``, ``role`` and ``depth``.

    Conversations are numbered by their root's (created_at, tweet_id).  Pass
    ``unique_ids=True`` when tweet ids are known to be unique.
    """
    if not unique_ids:
        tweets = latest_per_id(tweets)
    # every round reads the ids and pointers, only the last step the messages
    slim = materialize(
        tweets.select("tweet_id", "created_at", "in_response_to_tweet_id"), "reply-pointers"
    )
    members = thread_members(slim, p.max_thread_depth)
    starts = members.filter("depth = 0").select("tweet_id")
    roots = slim.select("tweet_id", "created_at").join(starts, "tweet_id")
    numbers = numbered(roots, ["created_at", "tweet_id"], "_n").select(
        F.col("tweet_id").alias("root_id"),
        F.format_string("conv_%06d", "_n").alias("conversation_id"),
    )
    threaded = (
        members.join(numbers, "root_id")
        .join(tweets, "tweet_id")
        .withColumn("text", F.coalesce("text", F.lit("")))
    )
    return with_role(threaded, p).select(
        "conversation_id", "tweet_id", "author_id", "role", "inbound", "created_at", "text",
        "in_response_to_tweet_id", "response_tweet_id", "depth",
    )


def message_sequence(
    messages: DataFrame, p: Params, hot: HotGroups | None = None, out: str = "seq"
) -> DataFrame:
    """Add the chronological position inside the conversation (ties by tweet id)."""
    hot = hot or find_hot_groups(messages, "conversation_id", p.hot_group_rows)
    return with_sequence(messages, "conversation_id", ["created_at", "tweet_id"], hot, out)


def thread_sizes(messages: DataFrame) -> DataFrame:
    return messages.groupBy("conversation_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("role") == "customer").alias("n_customer"),
        F.count_if(F.col("role") == "brand").alias("n_brand"),
    )


def thread_stats(messages: DataFrame) -> DataFrame:
    """One row: conversations, messages, thread-length summary, messages per role."""
    return thread_sizes(messages).agg(
        F.count("*").alias("conversations"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("messages"),
        F.round(F.avg("n"), 1).alias("mean_length"),
        F.max("n").alias("max_length"),
        F.min("n").alias("min_length"),
        F.percentile("n", F.lit(0.5)).alias("median_length"),
        F.round(F.avg("n_brand"), 1).alias("mean_brand_messages"),
        F.round(F.avg("n_customer"), 1).alias("mean_customer_messages"),
    )


def thread_length_histogram(messages: DataFrame) -> DataFrame:
    """Number of conversations per length class; empty classes are kept."""
    # Lower bounds and labels of the length classes.
    classes = [(1, "1"), (2, "2"), (3, "3"), (4, "4"), (5, "5-9"), (10, "10-19"), (20, "20+")]
    label = F.lit(None).cast("string")
    for low, name in classes:
        label = F.when(F.col("n") >= low, F.lit(name)).otherwise(label)
    counts = (
        thread_sizes(messages).groupBy(label.alias("length")).agg(F.count("*").alias("found"))
    )
    rows = [(i, name) for i, (_, name) in enumerate(classes)]
    frame = messages.sparkSession.createDataFrame(rows, "position bigint, length string")
    return frame.join(counts, "length", "left").select(
        "position", "length", F.coalesce("found", F.lit(0)).cast("bigint").alias("conversations")
    )
