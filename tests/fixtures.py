"""Small hand-made tables with known results."""

from __future__ import annotations

from datetime import datetime, timedelta

from threadlens import Params

P = Params(brand="AcmeSupport", brand_handle="@AcmeSupport")
START = datetime(2024, 5, 1, 9, 0)

TWEET_SCHEMA = (
    "tweet_id string, author_id string, inbound boolean, created_at timestamp, text string, "
    "response_tweet_id string, in_response_to_tweet_id string"
)
MESSAGE_SCHEMA = (
    "conversation_id string, tweet_id string, author_id string, role string, created_at timestamp, text string"
)


def tweets(spark, rows):
    """rows: (id, author, minute or None, text, listed responses, parent)."""
    data = [
        (i, a, a.lower() not in ("acmesupport", "otherco"), None if m is None else START + timedelta(minutes=m), t, r, p)
        for i, a, m, t, r, p in rows
    ]
    return spark.createDataFrame(data, TWEET_SCHEMA)


SUPPORT_ROWS = [
    ("1", "ann", 0, "@AcmeSupport the parcel hasn't come! https://t.example.org/a", "2", None),
    ("2", "acmesupport", 5, "@ann Sorry! Could you DM us the parcel number?", "3", "1"),
    ("3", "ann", 10, "@AcmeSupport you have it twice already!!", "4", "2"),
    ("4", "AcmeSupport", 15, "@ann We will look into it now.", None, "3"),
    ("5", "bob", 60, "@AcmeSupport when does my refund arrive?", "6", None),
    ("6", "AcmeSupport", 65, "@bob Refunds need five days.", None, "5"),
    ("7", "OtherCo", 120, "@cid We can sort that out.", None, None),
    ("8", "cid", 180, "@OtherCo why is the bill so high?", None, None),
]

THREAD_ROWS = [
    ("conv_000000", "1", "ann", "customer", 0, "the parcel hasn't come!"),
    ("conv_000000", "2", "AcmeSupport", "brand", 5, "Sorry! Could you DM us the parcel number?"),
    ("conv_000000", "3", "ann", "customer", 10, "you have it twice already!!"),
    ("conv_000000", "4", "AcmeSupport", "brand", 15, "We will look into it now."),
    ("conv_000001", "5", "bob", "customer", 60, "when does my refund arrive?"),
    ("conv_000001", "6", "AcmeSupport", "brand", 65, "Refunds need five days."),
]


def messages(spark, rows=THREAD_ROWS):
    data = [(c, i, a, r, START + timedelta(minutes=m), t) for c, i, a, r, m, t in rows]
    return spark.createDataFrame(data, MESSAGE_SCHEMA)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def table(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
