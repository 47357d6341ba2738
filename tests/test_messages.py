"""Quality filter, conversation statistics, language and signals."""

import random

import pytest

from pyspark.sql import functions as F

from tests.fixtures import P, messages, one, table
from threadlens import Params
from threadlens.functions import text as tx
from threadlens.operators import conversations as cv
from threadlens.operators import language as lg
from threadlens.operators import quality as qu
from threadlens.operators import signals as sg
from threadlens.operators.graph import message_sequence
from threadlens.operators.ordering import find_hot_groups
from threadlens.params import SIGNAL_KEYWORDS
from threadlens.plans.explore import explore


def removals(df, p=P):
    return {r["stage"]: r["removed"] for r in qu.quality_removals(df, p).collect()}


def case(spark, rows):
    return messages(spark, [(c, f"t{i}", a, r, i, t) for i, (c, a, r, t) in enumerate(rows)])


def test_quality_stages(spark):
    empty = case(spark, [("c1", "a", "customer", "Hello"), ("c1", "b", "brand", ""), ("c2", "c", "customer", "How are you"), ("c2", "d", "brand", None)])
    got = removals(empty)
    assert (got["empty_text"], got["short_conversations"], got["short_conversations_threads"]) == (2, 2, 2)
    assert qu.quality_filter(empty, P).count() == 0

    dup = case(spark, [("c1", "u1", "customer", "Same text"), ("c1", "u1", "customer", "Same text"), ("c1", "u2", "brand", "Other")])
    assert removals(dup)["duplicates"] == 1
    assert [r["tweet_id"] for r in qu.quality_filter(dup, P).orderBy("tweet_id").collect()] == ["t0", "t2"]

    system = case(spark, [("c1", "a", "customer", "hello there"), ("c1", "b", "brand", "This Tweet is UNAVAILABLE now"), ("c1", "c", "customer", "ok thanks")])
    assert removals(system)["system_messages"] == 1 and qu.quality_filter(system, P).count() == 2

    short = case(spark, [("c1", "a", "customer", "solo message"), ("c2", "b", "customer", "first one"), ("c2", "c", "brand", "second"), ("c2", "c", "brand", "no")])
    got = removals(short)
    assert (got["too_short"], got["short_conversations"], got["short_conversations_threads"]) == (1, 1, 1)


def test_quality_counts_add_up_and_switches(spark):
    rng = random.Random(1)
    texts = ["hello", "hello", "thanks a lot", "", "ok", "account suspended", None, "where is it"]
    df = case(spark, [(f"c{rng.randrange(40)}", f"u{rng.randrange(5)}", "customer", rng.choice(texts)) for _ in range(200)])
    got = removals(df)
    survivors = qu.quality_filter(df, P).count()
    assert survivors + sum(v for k, v in got.items() if k != "short_conversations_threads") == 200
    assert survivors == qu.quality_filter(df.repartition(6), P, find_hot_groups(df, "conversation_id", 3)).count()
    off = Params(brand="x", remove_empty=False, remove_duplicates=False, remove_system_messages=False)
    assert set(removals(df, off)) == {"too_short", "short_conversations", "short_conversations_threads"}


def test_cleaning_keeps_the_original(spark):
    df = case(spark, [("c", "a", "customer", "@x hi https://e.org"), ("c", "a", "customer", "plain"), ("c", "a", "customer", None)])
    cleaned = qu.clean_messages(df, P)
    got = table(cleaned, "tweet_id")
    assert (got["t0"]["text"], got["t0"]["text_original"]) == ("hi", "@x hi https://e.org")
    assert got["t2"]["text"] == "" and got["t2"]["text_original"] is None
    assert one(qu.cleaning_report(cleaned)) == {"messages": 3, "modified": 1, "modified_pct": 33.3}
    assert [r["tweet_id"] for r in qu.cleaning_samples(cleaned).collect()] == ["t0"]
    # the cleaning chain is evaluated once, whatever filters follow
    plan = qu.quality_filter(cleaned, P)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("https?") == 1


def test_conversation_statistics(spark):
    m = messages(spark)
    assert one(cv.overview_counts(m)) == {"total_conversations": 2, "total_messages": 6, "customer_messages": 3, "brand_replies": 3, "unique_customers": 2}
    assert one(cv.thread_length_stats(m)) == {"mean": 3.0, "median": 3.0, "std": 1.41, "min": 2, "max": 4, "q25": 2.5, "q75": 3.5}
    assert one(cv.notable_conversations(m)) == {"longest_id": "conv_000000", "longest_length": 4, "shortest_id": "conv_000001", "shortest_length": 2}
    assert one(cv.role_balance(m))["customer_to_brand_ratio"] == 1.0
    assert cv.role_balance(m.filter("role = 'brand'")).count() == 0
    assert one(cv.length_percentiles(m)) == {"p10": 2.2, "p25": 2.5, "p50": 3.0, "p75": 3.5, "p90": 3.8, "p95": 3.9}
    assert one(cv.turn_structure(m)) == {"single_turn_count": 1, "multi_turn_count": 1, "total": 2, "single_turn_pct": 50.0, "multi_turn_pct": 50.0}
    switches = cv.role_switches(m, P)
    assert {r["conversation_id"]: (r["role_switches"], r["depth"]) for r in switches.collect()} == {"conv_000000": (3, 2), "conv_000001": (1, 1)}
    assert one(cv.response_depth(switches)) == {"mean_switches": 2.0, "median_switches": 2.0, "max_switches": 3, "mean_depth": 1.5}
    assert one(cv.brand_responsiveness(m)) == {"conversations_without_brand_reply": 0, "brand_reply_rate": 100.0}
    assert one(cv.temporal_span(m))["span_days"] == 0
    assert table(cv.participation(m), "role")["customer"] == {"role": "customer", "mean": 1.5, "median": 1.5, "max": 2, "conversations_with_zero": 0}
    assert {r["last_role"] for r in cv.last_speaker(m).collect()} == {"brand"}


def test_empty_input_gives_empty_or_zero_results(spark):
    m = messages(spark).filter("false")
    assert one(cv.overview_counts(m))["total_messages"] == 0
    assert one(cv.brand_responsiveness(m))["brand_reply_rate"] == 0.0
    assert cv.temporal_span(m).count() == 0
    assert one(lg.message_types(m))["questions_pct"] == 0.0


def test_conversation_table_parts_join_to_the_whole(spark):
    rows = [("c1", f"t{i:03d}", "ann" if i % 2 else "AcmeSupport", "customer" if i % 2 else "brand", i, f"line {i}") for i in range(23)]
    rows += [("c2", "x", "AcmeSupport", "brand", 0, "only brand")]
    m = messages(spark, rows).repartition(3)
    whole = table(cv.conversation_table(m, P), "conversation_id")
    assert whole["c1"]["num_messages"] == 23 and whole["c1"]["num_customer_messages"] == 11
    assert (whole["c1"]["opening_message"], whole["c1"]["customer_id"]) == ("line 1", "ann")
    assert whole["c1"]["full_conversation"].split("\n")[:2] == ["[BRAND] line 0", "[CUSTOMER] line 1"]
    assert (whole["c2"]["opening_message"], whole["c2"]["customer_id"]) == ("", "")
    small = Params(brand=P.brand, transcript_lines=5, hot_group_rows=4)
    parts = cv.conversation_table(m, small).filter("conversation_id = 'c1'").orderBy("part").collect()
    assert len(parts) == 5 and {r["num_messages"] for r in parts} == {23}
    assert "\n".join(r["full_conversation"] for r in parts) == whole["c1"]["full_conversation"]


@pytest.mark.parametrize("lines", [1, 2, 1_000])
def test_first_brand_replies_do_not_depend_on_the_parts(spark, lines):
    rows = [("c1", f"t{i}", "ann", "customer", i, f"line {i}") for i in range(5)]
    rows += [("c1", "t7", "AcmeSupport", "brand", 7, "first"), ("c1", "t8", "AcmeSupport", "brand", 8, "second")]
    rows += [("c2", f"x{i}", "bob", "customer", i, "hi") for i in range(4)]
    p = Params(brand=P.brand, transcript_lines=lines)
    parts = cv.conversation_table(messages(spark, rows), p)
    parts = parts.unionByName(parts.limit(1).withColumn("conversation_id", F.lit("c3")).withColumn("full_conversation", F.lit("")))
    got = {r["conversation_id"]: r["reply"] for r in cv.first_brand_replies(parts, p).collect()}
    assert got == {
        "c1": "first",
        "c2": "Please DM us your details so we can investigate.",
        "c3": "Please DM us so we can assist you.",
    }


def test_language(spark):
    m = messages(spark)
    words = {r["word"]: r["count"] for r in lg.top_keywords(m, 30).collect()}
    assert words["parcel"] == words["refund"] == words["twice"] == 1 and "hasn" not in words and "the" not in words
    assert one(lg.message_types(m))["questions"] == 1
    assert one(lg.emotional_punctuation(m)) == {"multiple_exclamations": 1, "multiple_questions": 0, "mostly_caps": 0}
    themes = {r["theme_label"]: r["total_mentions"] for r in lg.keyword_themes(cv.opening_messages(m)).collect()}
    assert themes["Refund Payment"] == 1 and themes["Account Access"] == 0 and len(themes) == 5


def brute_force_signals(rows):
    conv = {}
    for c, i, a, r, m, t in sorted(rows, key=lambda x: (x[0], x[4], x[1])):
        conv.setdefault(c, []).append((r, t))
    out = {}
    for c, msgs in conv.items():
        joined = " ".join((t or "").lower() for r, t in msgs if r == "customer")
        out[c] = (
            sum(r == "customer" for r, _ in msgs) >= 3,
            msgs[-1][0] == "customer",
            *[any(k in joined for k in ks) for ks in SIGNAL_KEYWORDS.values()],
        )
    return out


def test_signals_match_the_joined_text(spark):
    rng = random.Random(5)
    vocabulary = ["wrong", "item", "not", "working", "fine", "", "Refund please", "my login", "hello not", "working hours", None]
    rows = [(f"c{0 if i % 3 == 0 else rng.randrange(30)}", f"t{i:03d}", "u", rng.choice(["customer", "customer", "brand"]), rng.randrange(90), rng.choice(vocabulary)) for i in range(150)]
    m = messages(spark, rows)
    want = brute_force_signals(rows)
    for hot_rows in (10**6, 8):
        p = Params(brand="x", hot_group_rows=hot_rows)
        signals = sg.conversation_signals(m, p)
        got = {r["conversation_id"]: tuple(r)[1:] for r in signals.collect()}
        assert got == want
    counts = table(sg.keyword_signals(signals, p), "category")
    assert counts["damage"]["count"] == sum(v[4] for v in want.values())
    assert one(sg.any_escalation(signals, p))["conversations_with_any_signal"] == sum(any(v) for v in want.values())


def test_explore_runs_every_table(spark):
    tables = explore(messages(spark), P)
    for name, df in tables.items():
        assert df.count() >= (0 if name in ("top_emojis", "top_trigrams") else 1), name
    assert {r["seq"] for r in message_sequence(messages(spark), P).collect()} == {1, 2, 3, 4}
