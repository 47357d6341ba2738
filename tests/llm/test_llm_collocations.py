"""Phrase collocations against counting every phrase."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import DOCS, odd_rows, table  # noqa: E402

from threadlens.llm import collocations as module  # noqa: E402
from threadlens.llm.collocations import (  # noqa: E402
    PhraseIndex,
    collocations,
    phrase_counts,
    phrase_extensions,
)


def plain_pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
        yield [w for w in re.split("[ \t]+", piece) if w]


def plain_phrases(rows, longest=4):
    """{lang: Counter of word tuples}"""
    found = {}
    for lang, text in rows:
        counts = found.setdefault(lang or "und", Counter())
        for ws in plain_pieces(text):
            for k in range(1, longest + 1):
                counts.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    return found


def plain_collocations(rows, top, least):
    out = []
    for lang, f in plain_phrases(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        scored = []
        for p in candidates:
            a = f[p]
            around = [q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * f[q] >= 80 * a for q in around):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def texts_of(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "The", "new", "york", "city", "a", "a", "é", "is", "time", "über", "x-1"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 30)):
            parts += rng.choices(words, k=rng.randint(1, 4))
            parts.append(rng.choice(["new york city", "a a a a", "time of the", ", ", ".", "\n", "\t", "! ?"]))
        rows.append((rng.choice(["en", "en", "de", None]), " ".join(parts)))
    return rows


def frame(spark, rows):
    full = [(i, text, lang, "s", 0) for i, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).selectExpr("*", "'x' AS word", "1 AS n", "2 AS w0", "3 AS shard")


@pytest.mark.parametrize("shard_words, gathered", [(1, 1 << 20), (50, 40), (50, 1 << 20), (1 << 21, 0)])
def test_equals_counting_every_phrase(spark, shard_words, gathered, monkeypatch):
    monkeypatch.setattr(module, "GATHERED_ROWS", gathered)
    rows = texts_of(3, 120) + [(None, None), ("en", ""), ("und", "new york city " * 3), ("fr", "lone words")]
    got = collocations(frame(spark, rows).repartition(3), top=25, min_count=5, shard_words=shard_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 25, 5)


def test_phrases_and_extensions(spark, monkeypatch):
    # a filter of a few bits lets nearly everything through
    monkeypatch.setattr(module, "filter_bits", lambda *a: 5)
    rows = texts_of(7, 60)
    _, grams = phrase_counts(frame(spark, rows), min_count=4, shard_words=200)
    word = {r.w0: (r.lang, r.word) for r in grams[1].collect()}
    want = {(lang, p): n for lang, f in plain_phrases(rows).items() for p, n in f.items() if n >= 4}
    got = {}
    for size, table_of in grams.items():
        for r in table_of.collect():
            named = [word[r[f"w{i}"]] for i in range(size)]
            got[named[0][0], tuple(w for _, w in named)] = r.n
    assert got == want
    for r in phrase_extensions(grams, 2).collect():
        own, other = (word[r.w0][1], word[r.w1][1]), word[r.word_id]
        assert r.n == want[other[0], (other[1], *own) if r.side == "left" else (*own, other[1])]


def test_index_intervals():
    rng = np.random.default_rng(5)
    numbers = rng.integers(0, 6, 400).astype(np.int32)
    index = PhraseIndex(numbers, 5, 3)
    words, intervals = index.words[:, None], index.word_intervals
    for left in (True, False, False):
        phrase, symbol, intervals = index.extend(intervals, left)
        shorter = words[phrase]
        words = np.concatenate([symbol[:, None], shorter] if left else [shorter, symbol[:, None]], 1)
        size = words.shape[1]
        windows = Counter(tuple(numbers[i : i + size].tolist()) for i in range(len(numbers) - size + 1))
        want = {p: n for p, n in windows.items() if 0 not in p}
        assert dict(zip(map(tuple, words.tolist()), (intervals[:, 1] - intervals[:, 0]).tolist())) == want
        assert (intervals[:, 3] - intervals[:, 2] == intervals[:, 1] - intervals[:, 0]).all()


def test_odd_rows_and_empty_tables(spark):
    ids, texts = odd_rows()
    got = collocations(table(spark, texts, ids, extra=True), min_count=2).collect()
    assert sorted(map(tuple, got)) == plain_collocations([("en", t) for t in texts], 2000, 2)
    assert collocations(table(spark, [])).count() == 0
    assert collocations(table(spark, [None, "", " . "])).count() == 0
    assert collocations(table(spark, ["words found once"])).count() == 0
