import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from cases import odd_rows, prose, table  # noqa: E402

from threadlens.llm.quality_classifier import Settings, fit_quality, score_quality, train  # noqa: E402
from threadlens.llm.quality_rules import (  # noqa: E402
    DecisionList,
    keep_good,
    learn_rules,
    quality_verdicts,
    text_statistics,
)

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {
        i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def junk(texts):
    """Every third text with symbols behind its words; label 0."""
    out = [t if i % 3 else " ".join(w + "###" for w in t.split()) for i, t in enumerate(texts)]
    return out, [(i, int(i % 3 > 0), 0) for i in range(len(texts))]


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_statistics_equal_brute_force(spark):
    texts = prose(7, 40) + ["a b c a b c a b c", "x x x x x", "one\none\ntwo\n\n\n", "# | <b> é"]
    ids, odd = odd_rows()
    texts += odd
    rows = text_statistics(table(spark, texts, extra=True)).collect()
    got = {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows
    }
    assert got == {i: plain_statistics(t) for i, t in enumerate(texts)}


def test_rules_tell_junk(spark):
    texts, labels = junk(prose(8, 200, words=120))
    docs, marks = table(spark, texts, extra=True), labels_of(spark, labels)
    rules = learn_rules(text_statistics(docs), marks)
    assert rules.rules and all(c.measure for r in rules.rules for c in r)
    for r in quality_verdicts(docs, marks).collect():
        n, _, _, _, repeated = plain_statistics(texts[r.doc_id])
        failed = n < 50 or 100 * repeated > 50 * n
        assert r.base_failed == failed
        assert r.kept == (not failed and r.doc_id % 3 > 0)
    kept = keep_good(docs, marks)
    assert kept.columns == docs.columns and kept.count() > 0


def test_rules_without_labels(spark):
    docs = table(spark, prose(9, 20))
    none = labels_of(spark, [])
    assert learn_rules(text_statistics(docs), none) == DecisionList()
    strange = labels_of(spark, [(1, None, 0), (2, 7, 0), (None, 1, 0), (999, 0, 0)])
    rows = quality_verdicts(docs, strange).collect()
    assert all(r.kept != r.base_failed for r in rows)
    assert quality_verdicts(table(spark, []), none).count() == 0


def test_rules_odd_rows(spark):
    ids, texts = odd_rows()
    docs = table(spark, texts, ids, extra=True)
    rows = quality_verdicts(docs, labels_of(spark, [(4, 1, 0), (9, 0, 0)])).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
    assert {r.kept for r in rows if r.doc_id in (1, 2, 3, 5)} == {False}
    assert keep_good(docs, labels_of(spark, [])).columns == docs.columns


def test_classifier_on_held_out_documents(spark):
    texts, labels = junk(prose(10, 300))
    docs, marks = table(spark, texts, extra=True), labels_of(spark, labels)
    settings = Settings(epochs=8)
    scored = score_quality(docs, fit_quality(docs, marks, settings), settings).collect()
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0.0 <= r.score <= 1.0
    held = [(r.score, r.doc_id % 3 > 0) for r in scored if r.held_out]
    assert sum((s >= 0.5) == good for s, good in held) >= 0.95 * len(held)


def test_classifier_never_learns_from_held_out_rows(spark):
    texts, labels = junk(prose(10, 120))
    docs = table(spark, texts)
    settings = Settings(epochs=2)
    flipped = [
        (i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels
    ]
    one, two = (fit_quality(docs, labels_of(spark, x), settings) for x in (labels, flipped))
    assert one.bias == two.bias and np.array_equal(one.buckets, two.buckets)


def test_classifier_odd_rows(spark):
    ids, texts = odd_rows()
    docs = table(spark, texts, ids, extra=True)
    model = fit_quality(docs, labels_of(spark, [(4, 1, 0), (9, 0, 0), (None, 1, 0), (5, 3, 0)]))
    rows = score_quality(docs, model).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    blind = train([], Settings())
    assert set(blind.scores([b"", b"any words"])) == {0.5}
    assert score_quality(table(spark, []), blind).count() == 0
