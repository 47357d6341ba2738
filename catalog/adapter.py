"""Maps the benchmark tables to support-message tables, for Spark and DuckDB.

The expressions below are written once in the SQL subset both engines share.
The decorations make every message rule fire somewhere.  They are added to the texts
and replace none; empty, two-character and URL-only messages are further turns.  All
turns are read; those of the system count as a customer's, like every author but a brand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.text import once
from threadlens.operators.ordering import find_hot_groups, with_sequence
from threadlens.params import SCORE_DIMENSIONS, Params

BRANDS = ["AcmeSupport", "BoltCare", "CedarHelp", "DeltaAssist"]
BRAND = BRANDS[0]
PARAMS = Params(brand=BRAND, brand_handle="@AcmeSupport")

N = "(conv_id * 1000 + turn)"

AUTHOR = (
    "CASE WHEN role = 'assistant' THEN CASE conv_id % 4 "
    + " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(BRANDS))
    + " END WHEN role = 'system' THEN concat('system_', CAST(conv_id % 50 AS STRING))"
    " ELSE concat('user_', CAST(conv_id % 50 AS STRING)) END"
)

# all turns, and one of a fixed text for every conversation
EXTRA_TURN = 901
EXTRA_TEXT = (
    "CASE conv_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'ok' WHEN 2 THEN 'This tweet has been deleted' "
    "ELSE concat('https://t.example.org/x', CAST(conv_id AS STRING)) END"
)
TURNS = f"""
  SELECT conv_id, turn, role, text, false AS extra FROM {{conversations}}
  UNION ALL
  SELECT conv_id, {EXTRA_TURN} AS turn, 'user' AS role, {EXTRA_TEXT} AS text, true AS extra
  FROM (SELECT DISTINCT conv_id FROM {{conversations}}) t"""

TEXT = f"""
CASE WHEN extra THEN text ELSE concat(
  CASE WHEN {N} % 21 = 10 THEN ' \n' ELSE '' END,
  CASE WHEN {N} % 7 = 2 THEN 'RT @someuser: ' ELSE '' END,
  CASE WHEN {N} % 5 = 1 THEN '@{BRAND} @friend_1 ' ELSE '' END,
  CASE WHEN {N} % 12 = 3 THEN 'item ' ELSE '' END,
  CASE WHEN {N} % 31 = 12 THEN upper(replace(text, 'ß', 'ss')) ELSE text END,
  CASE WHEN {N} % 29 = 11 THEN concat(' https://t.example.org/x', CAST({N} AS STRING)) ELSE '' END,
  CASE WHEN {N} % 13 = 4 THEN ' Please DM us your order details so we can help.' ELSE '' END,
  CASE WHEN {N} % 9 = 2 THEN ' I was charged twice and want a refund' ELSE '' END,
  CASE WHEN {N} % 10 = 7 THEN ' my account is locked out' ELSE '' END,
  CASE WHEN {N} % 14 = 5 THEN ' the box was damaged and broken' ELSE '' END,
  CASE WHEN {N} % 15 = 4 THEN ' this is urgent, I will call my lawyer' ELSE '' END,
  CASE WHEN {N} % 19 = 8 THEN ' 😡❤️🚚' ELSE '' END,
  CASE WHEN {N} % 23 = 9 THEN concat(' WWW.example.org/', CAST({N} AS STRING)) ELSE '' END,
  CASE WHEN {N} % 3 = 0 THEN '?' ELSE '' END,
  CASE WHEN {N} % 11 = 3 THEN '!!' ELSE '' END,
  CASE WHEN {N} % 17 = 6 THEN '??' ELSE '' END,
  CASE WHEN {N} % 12 = 1 THEN ' wrong' ELSE '' END,
  CASE WHEN {N} % 21 = 10 THEN '\n' ELSE '' END
) END
"""

EPOCH = "1704067200 + conv_id * 3600 + turn * 60"

# the message table in DuckDB; timestamps are epoch seconds there
MESSAGES_SQL = f"""
turns AS MATERIALIZED ({TURNS.format(conversations="conversations")}),
messages AS MATERIALIZED (
  SELECT printf('conv_%06d', conv_id) AS conversation_id,
         CAST({N} AS STRING) AS tweet_id,
         {AUTHOR} AS author_id,
         CASE WHEN role = 'assistant' THEN 'brand' ELSE 'customer' END AS role,
         role <> 'assistant' AS inbound,
         {EPOCH} AS created_at,
         {TEXT} AS text,
         conv_id, turn, {N} AS n
  FROM turns
)"""

TWEETS_SQL = f"""
{MESSAGES_SQL},
tweets AS MATERIALIZED (
  SELECT m.*, CAST(p.n AS STRING) AS in_response_to_tweet_id,
         CASE WHEN c.n IS NULL THEN NULL
              WHEN m.n % 6 = 0 THEN concat(CAST(c.n AS STRING), ', missing_', CAST(m.n AS STRING))
              ELSE CAST(c.n AS STRING) END AS response_tweet_id
  FROM messages m
  LEFT JOIN messages p ON p.n = m.n - 1
  LEFT JOIN messages c ON c.n = m.n + 1
)"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return spark.sql(TURNS.replace("{conversations}", "{c}"), c=conversations)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer or brand message."""
    return (
        turns(spark, sf_dir)
        .select(
            F.format_string("conv_%06d", "conv_id").alias("conversation_id"),
            F.expr(f"CAST({N} AS STRING)").alias("tweet_id"),
            F.expr(AUTHOR).alias("author_id"),
            F.expr("CASE WHEN role = 'assistant' THEN 'brand' ELSE 'customer' END").alias("role"),
            F.expr("role <> 'assistant'").alias("inbound"),
            F.timestamp_seconds(F.expr(EPOCH)).alias("created_at"),
            once(F.expr(TEXT)).alias("text"),
            "conv_id",
            "turn",
            F.expr(N).alias("n"),
        )
    )


def conversation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversation id of every message; reads no text."""
    return turns(spark, sf_dir).select(F.format_string("conv_%06d", "conv_id").alias("conversation_id"))


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layout: reply pointers instead of conversation ids.

    Neighbouring turns meet on the message number, which is unique.
    """
    m = messages(spark, sf_dir)
    previous = m.select((F.col("n") + 1).alias("n"), F.col("n").alias("prev_n"))
    following = m.select((F.col("n") - 1).alias("n"), F.col("n").alias("next_n"))
    listed = F.expr(
        "CASE WHEN next_n IS NULL THEN NULL "
        "WHEN n % 6 = 0 THEN concat(CAST(next_n AS STRING), ', missing_', CAST(n AS STRING)) "
        "ELSE CAST(next_n AS STRING) END"
    )
    return (
        m.join(previous, "n", "left")
        .join(following, "n", "left")
        .select(
            "tweet_id",
            "author_id",
            "inbound",
            "created_at",
            "text",
            listed.alias("response_tweet_id"),
            F.col("prev_n").cast("string").alias("in_response_to_tweet_id"),
        )
    )


# Reply graphs with branching and long chains: the events of a user in time
# order.  In a tree, event r answers event r/2; in a chain, event r - 1.
# Every event of an even user comes from the brand.
EVENT_TWEETS_SQL = f"""
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events
),
event_tweets AS MATERIALIZED (
  SELECT printf('u%06d_%06d', user_id, r) AS tweet_id,
         CASE WHEN user_id % 2 = 0 AND event_type <> 'view' THEN '{BRAND}'
              ELSE concat('user_', CAST(user_id AS STRING)) END AS author_id,
         event_type = 'view' AS inbound,
         epoch_us(ts) AS created_us,
         event_type AS text,
         CASE WHEN r = 1 THEN NULL
              WHEN user_id % 3 = 0 THEN printf('u%06d_%06d', user_id, r - 1)
              ELSE printf('u%06d_%06d', user_id, CAST(floor(r / 2) AS BIGINT)) END
           AS in_response_to_tweet_id,
         CASE WHEN event_type = 'click' THEN printf('u%06d_%06d', user_id, r + 1) END
           AS response_tweet_id
  FROM ranked
)"""


def event_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    hot = find_hot_groups(events, "user_id", PARAMS.hot_group_rows)
    ranked = with_sequence(events, "user_id", ["ts", "event_id"], hot, "r")

    def node(rank: str):
        return F.format_string("u%06d_%06d", F.col("user_id"), F.expr(rank))

    parent = F.when(F.col("r") > 1, F.when(F.expr("user_id % 3 = 0"), node("r - 1")).otherwise(node("CAST(floor(r / 2) AS BIGINT)")))
    return ranked.select(
        node("r").alias("tweet_id"),
        F.when(F.expr("user_id % 2 = 0 AND event_type <> 'view'"), F.lit(BRAND))
        .otherwise(F.concat(F.lit("user_"), F.col("user_id").cast("string")))
        .alias("author_id"),
        (F.col("event_type") == "view").alias("inbound"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("event_type").alias("text"),
        parent.alias("in_response_to_tweet_id"),
        F.when(F.col("event_type") == "click", node("r + 1")).alias("response_tweet_id"),
    )


# Annotation records: one per message, many ids occur repeatedly.
ANNOTATION_ID = (
    f"CASE WHEN {N} % 47 = 0 OR conv_id % 5 = 2 THEN '' WHEN {N} % 53 = 0 THEN NULL ELSE 'id' END"
)
ANNOTATION_INTENT = (
    f"CASE WHEN {N} % 61 = 3 THEN '' ELSE CASE {N} % 13 "
    + " ".join(
        f"WHEN {i} THEN '{v}'"
        for i, v in enumerate(
            [
                "order_status", "order_modification", "order_missing_wrong", "refund_request",
                "billing_issue", "delivery_problem", "shipping_inquiry", "account_access",
                "account_management", "product_issue", "technical_support", "general_inquiry",
                "Refund-Request ",
            ]
        )
    )
    + " END END"
)
ANNOTATION_ESCALATION = (
    f"CASE {N} % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'yes' "
    "WHEN 3 THEN ' escalate ' ELSE NULL END"
)
ANNOTATION_REASON = (
    f"CASE {N} % 11 WHEN 0 THEN 'identity_verification' WHEN 1 THEN 'refund_payment' "
    "WHEN 2 THEN 'legal_privacy' WHEN 3 THEN 'account_security' WHEN 4 THEN 'damaged_defective' "
    "WHEN 5 THEN 'abusive_customer' WHEN 6 THEN 'Policy Exception' WHEN 7 THEN 'n/a' "
    "WHEN 8 THEN 'none' WHEN 9 THEN 'bogus' ELSE NULL END"
)
ANNOTATION_CONFIDENCE = (
    f"CASE {N} % 7 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' WHEN 3 THEN 'high' "
    "WHEN 4 THEN ' HIGH' WHEN 5 THEN 'med' ELSE 'high' END"
)

ANNOTATIONS_SQL = f"""
annotations AS MATERIALIZED (
  SELECT CASE WHEN {ANNOTATION_ID} = 'id' THEN printf('conv_%06d', conv_id)
              ELSE {ANNOTATION_ID} END AS conversation_id,
         {ANNOTATION_INTENT} AS primary_intent,
         {ANNOTATION_ESCALATION} AS escalation,
         {ANNOTATION_REASON} AS escalation_reason,
         {ANNOTATION_CONFIDENCE} AS confidence,
         concat('note ', CAST({N} AS STRING)) AS annotator_notes,
         {EPOCH} AS annotated_at,
         {N} AS row_id
  FROM conversations
)"""


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "conversations")
        .select(
            F.when(F.expr(f"{ANNOTATION_ID} = 'id'"), F.format_string("conv_%06d", "conv_id"))
            .otherwise(F.expr(ANNOTATION_ID))
            .alias("conversation_id"),
            F.expr(ANNOTATION_INTENT).alias("primary_intent"),
            F.expr(ANNOTATION_ESCALATION).alias("escalation"),
            F.expr(ANNOTATION_REASON).alias("escalation_reason"),
            F.expr(ANNOTATION_CONFIDENCE).alias("confidence"),
            F.expr(f"concat('note ', CAST({N} AS STRING))").alias("annotator_notes"),
            F.expr(EPOCH).alias("annotated_at"),
            F.expr(N).alias("row_id"),
        )
    )


# Predictions of three systems per labelled document: the true label is the
# document language, wrong guesses and escalation flags follow the document id.
def _guess(step: int) -> str:
    return (
        f"CASE WHEN doc_id % {step} = 0 THEN CASE lang WHEN 'en' THEN 'de' WHEN 'de' THEN 'fr' "
        "WHEN 'fr' THEN 'xx' ELSE 'en' END ELSE lang END"
    )


PREDICTION_COLUMNS = {
    "conversation_id": "CAST(doc_id AS STRING)",
    "customer_text": "text",
    "true_intent": "lang",
    "true_escalation": "quality = 0",
    "b1_intent": "'en'",
    "b1_escalation": "'AUTO_HANDLE'",
    "b2_intent": _guess(4),
    "b2_escalation": "CASE WHEN doc_id % 3 = 0 THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END",
    "agent_intent": _guess(11),
    "agent_escalation": "CASE WHEN toxic = 1 OR doc_id % 7 = 0 THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END",
}

PREDICTIONS_SQL = (
    "predictions AS MATERIALIZED (SELECT "
    + ", ".join(f"{e} AS {c}" for c, e in PREDICTION_COLUMNS.items())
    + " FROM documents JOIN labels USING (doc_id))"
)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return docs.join(read(spark, sf_dir, "labels"), "doc_id").select(
        *[F.expr(e).alias(c) for c, e in PREDICTION_COLUMNS.items()]
    )


# Two raters: human scores for the labelled documents, judge scores for all.
DIMENSIONS = SCORE_DIMENSIONS
_FACTORS = [3, 7, 11, 13, 17]
HUMAN = {d: f"1 + (doc_id * {k} + quality) % 5" for d, k in zip(DIMENSIONS, _FACTORS)}
JUDGE = {
    d: f"least(5, greatest(1, 1 + (doc_id * {k} + 1) % 5 + doc_id % {i + 2} - 1))"
    for i, (d, k) in enumerate(zip(DIMENSIONS, _FACTORS))
}

HUMAN_SQL = (
    "human AS MATERIALIZED (SELECT *, (h1 + h2 + h3 + h4 + h5) / 5.0::DOUBLE AS human_overall FROM ("
    "SELECT CAST(doc_id AS STRING) AS conversation_id, "
    + ", ".join(f"{e} AS human_{d}, {e} AS h{i + 1}" for i, (d, e) in enumerate(HUMAN.items()))
    + " FROM labels))"
)
JUDGE_SQL = (
    "judge AS MATERIALIZED (SELECT *, (j1 + j2 + j3 + j4 + j5) / 5.0::DOUBLE AS overall_score FROM ("
    "SELECT CAST(doc_id AS STRING) AS conversation_id, "
    + ", ".join(f"{e} AS {d}, {e} AS j{i + 1}" for i, (d, e) in enumerate(JUDGE.items()))
    + " FROM documents))"
)


def human_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = read(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("conversation_id"),
        *[F.expr(e).alias(f"human_{d}") for d, e in HUMAN.items()],
    )
    total = sum((F.col(f"human_{d}") for d in DIMENSIONS), F.lit(0))
    return base.withColumn("human_overall", total / F.lit(5.0))


def judge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("conversation_id"),
        *[F.expr(e).alias(d) for d, e in JUDGE.items()],
    )
    total = sum((F.col(d) for d in DIMENSIONS), F.lit(0))
    return base.withColumn("overall_score", total / F.lit(5.0))
