"""Keyword tables against looking for every keyword in every text."""

import random

import pytest

from threadlens import Params
from threadlens.operators import keywords as kw
from threadlens.operators import signals as sg
from threadlens.operators.ordering import HotGroups, find_hot_groups

LETTERS = "abcd é数"


def word(rng, longest=6):
    return "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, longest)))


@pytest.mark.parametrize("broadcast", [0, 50_000])
def test_thousand_keywords(spark, broadcast, monkeypatch):
    monkeypatch.setattr(kw, "BROADCAST_KEYWORDS", broadcast)
    monkeypatch.setattr(kw, "PIECE_CHARS", 7)
    rng = random.Random(1)
    known = [(f"c{i % 5}", word(rng).upper() if i % 3 else word(rng, 12)) for i in range(1_000)]
    known += [("c0", None), ("c1", ""), known[0]]
    texts = [(i, "".join(rng.choice(LETTERS + "AB") for _ in range(rng.randint(0, 40)))) for i in range(40)]
    texts += [(40, None), (41, ""), (42, "ab" * 700), (0, "the same key once more: dddd")]
    frame = spark.createDataFrame(texts, "doc_id int, text string").repartition(3)
    got = kw.keyword_hits(frame, spark.createDataFrame(known, "category string, keyword string"), "doc_id").collect()
    want = {(i, c, k.lower()) for i, t in texts for c, k in known if t and k and k.lower() in t.lower()}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert kw.keyword_hits(frame, spark.createDataFrame([], "category string, keyword string"), "doc_id").count() == 0


def test_keywords_across_messages_equal_flags(spark):
    rng = random.Random(2)
    words = ["not", "working", "asap", "still", "no", "reply", "ok"]
    rows = [
        (f"c{i % 9 if i % 2 else 0}", i // 3, i, rng.choice(["customer", "customer", "brand"]), rng.choice([None, " ".join(rng.choices(words, k=2))]))
        for i in range(120)
    ]
    messages = spark.createDataFrame(rows, "conversation_id string, created_at int, tweet_id int, role string, text string")
    p = Params(signal_keywords={"broken": ["not working"], "urgent": ["ASAP".lower(), "still no reply"], "none": ["zzz"]})
    table = kw.keyword_table(spark, p.signal_keywords)
    for hot in (HotGroups(None, 10**6), find_hot_groups(messages, "conversation_id", 10)):
        flags = {r.conversation_id: r for r in kw.keyword_flags(messages, table, list(p.signal_keywords), hot).collect()}
        old = sg.conversation_signals(messages, p, hot).collect()
        assert len(flags) == len(old)
        for r in old:
            assert [flags[r.conversation_id][c] for c in p.signal_keywords] == [r[c] for c in p.signal_keywords]
    assert any(f.urgent for f in flags.values()) and not any(f.none for f in flags.values())
