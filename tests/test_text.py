import pytest
from pyspark.sql import functions as F

from threadlens import Params
from threadlens.functions import text as tx


def evaluate(spark, values, fn):
    """Apply a column function to rows of text and return the results in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", fn(F.col("t")).alias("o"))
    return [r["o"] for r in df.orderBy("i").collect()]


CLEAN_CASES = [
    ("Check https://example.org/a?b=c now", "Check now"),
    ("  too   many    spaces ", "too many spaces"),
    ("great 😀 work", "great 😀 work"),
    ("@TestBrand @user2 my order is late", "my order is late"),
    ("RT @someuser: This is a retweet", "This is a retweet"),
    ("Hello World", "Hello World"),
    ("   ", ""),
    (None, ""),
    (" \nhi there\r\n", "hi there"),
    ("https://only.example.org", ""),
    ("RT @a: @b @c text", "text"),
    ("see WWW.Example.org/x today", "see today"),
    ("@häuser grüße an @dich", "grüße an @dich"),
    ("ok ❤️!", "ok ❤️!"),
    ("http://x.org RT @a: later", "RT @a: later"),
    ("line one\n\nline two", "line one line two"),
]


def test_clean_text(spark):
    got = evaluate(spark, [c for c, _ in CLEAN_CASES], lambda c: tx.clean_text(c, Params()))
    assert got == [w for _, w in CLEAN_CASES]


def test_clean_text_flags(spark):
    p = Params(lowercase=True, remove_urls=False, remove_rt_prefix=False, strip_leading_mentions=False, normalize_whitespace=False)
    got = evaluate(spark, ["RT @a: Hello  WORLD https://x.org"], lambda c: tx.clean_text(c, p))
    assert got == ["rt @a: hello  world https://x.org"]


def test_alpha_words_are_whole_unicode_words(spark):
    got = evaluate(spark, ["Häuser user_1 foo x9 Bar's hasn't a"], lambda c: tx.alpha_words(c, []))
    assert got == [["foo", "bar", "hasn"]]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams_match_brute_force(spark, n):
    texts = ["one two three four", "solo", "", "a1 b2 c3"]
    got = evaluate(spark, texts, lambda c: tx.ngrams(tx.terms(c), n))
    words = [t.split() for t in texts]
    assert got == [[" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] for w in words]


def test_message_predicates(spark):
    texts = ["STOP THIS NOW!!", "short", "Fine really", "ÄÖÜ ÄÖÜ ÄÖÜ"]
    assert evaluate(spark, texts, tx.caps_heavy) == [True, False, False, True]
    assert evaluate(spark, ["a 😡❤️ b", "none"], tx.emoji_chars) == [["😡", "❤", "️"], []]


def test_brand_line(spark):
    cases = [
        ("[CUSTOMER] hi\n[BRAND] hello there\n[BRAND] again", "hello there"),
        ("[CUSTOMER] hey TestBrand help\n[BRAND] hello", "[CUSTOMER] hey TestBrand help"),
        ("[CUSTOMER] hi", None),
        ("", None),
        (None, None),
    ]
    got = evaluate(spark, [c for c, _ in cases], lambda c: tx.brand_line(c, "TestBrand"))
    assert got == [w for _, w in cases]


def test_label_normalisation(spark):
    assert evaluate(spark, [" Refund-Request ", "order status", "nope", None], tx.normalize_intent) == [
        "refund_request", "order_status", None, None]
    assert evaluate(spark, ["H", " Medium", "med", "l", "x"], tx.normalize_confidence) == [
        "high", "medium", "medium", "low", None]
    assert evaluate(spark, ["", "N/A", "Legal Privacy", "bogus"], tx.normalize_reason) == [
        "none", "none", "legal_privacy", None]
    assert evaluate(spark, ["True", "yes", "1", " escalate ", "human required", "no", None], tx.is_escalation) == [
        True, True, True, True, True, False, False]


def test_truncate_and_snippet(spark):
    assert evaluate(spark, ["abcdefgh", "abc"], lambda c: tx.truncate_text(c, 6)) == ["abc...", "abc"]
    assert evaluate(spark, ['say "hi"', "x" * 41], tx.snippet) == ["say 'hi'", "x" * 40 + "..."]
