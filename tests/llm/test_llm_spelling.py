"""Spelling variants against all pairs of words."""

import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import odd_rows, prose, table  # noqa: E402

from threadlens.llm import spelling_variants as module  # noqa: E402
from threadlens.llm.queries import misspelt_runs  # noqa: E402
from threadlens.llm.spelling_variants import frequent_words, near_words, spelling_variants  # noqa: E402


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_variants(counts):
    """word -> (form, root, n, n_near, form_n)"""
    found, forms = {}, {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 2 * n:
            forms[w] = best
        found[w] = (n, len(close))

    def root(w):
        return root(forms[w]) if w in forms else w

    return {w: (forms.get(w), root(w), *found[w], counts.get(forms.get(w))) for w in counts}


def plain_words(ids, texts):
    counts = Counter()
    for i, t in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def as_dict(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


def test_pairs_equal_all_pairs(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(300)}
    # long words that share long beginnings, over the length of one edge
    words |= {"x" * n for n in (999, 1000, 1001, 2001)} | {"x" * 1500 + "y", "x" * 1500, "y" + "x" * 1500}
    got = [(r.a, r.b) for r in near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()]
    listed = sorted(words)
    assert sorted(got) == [(a, b) for i, a in enumerate(listed) for b in listed[i + 1 :] if near(a, b)]


@pytest.mark.parametrize("broadcast", [0, 10_000])
def test_variants_equal_brute_force(spark, broadcast, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_EDGES", broadcast)
    rng = random.Random(9)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("acdehiñ") for _ in range(rng.randint(2, 7)))
        counts[word] = n = 2 ** rng.randint(3, 9)
        for _ in range(3):
            # chains of rarer and rarer misspellings, with ties
            i, n = rng.randrange(len(word) + 1), n // rng.choice([1, 2, 3])
            word = word[:i] + rng.choice(["", "a", "ñ", "🙂"]) + word[i + rng.randint(0, 1) :]
            if word:
                counts.setdefault(word, max(1, n))
    want = plain_variants(counts)
    assert as_dict(spelling_variants(frame(spark, counts)).collect()) == want
    assert any(v[0] and v[0] != v[1] for v in want.values())


def test_query_on_documents(spark):
    texts = ["Straße STRASSE Straßen ÀÉ×÷ x" * 4, None, ""] + prose(41, 20, words=120)
    texts += ["different variants, various spellings " * 3] * 150
    ids = [None if i == 5 else i for i in range(len(texts))]
    docs = table(spark, texts, ids, extra=True)
    counts = {r.word: r.n for r in frequent_words(misspelt_runs(docs)).collect()}
    assert counts == plain_words(ids, texts)
    got = as_dict(spelling_variants(frequent_words(misspelt_runs(docs))).collect())
    assert got == plain_variants(counts)
    assert any(v[0] for v in got.values())


def test_odd_words(spark):
    rows = [("abc", 5), ("abc", 1), ("ab", 3), (None, 9), ("", 9), ("zz", 4)]
    words = spark.createDataFrame([(w, n, "x", "y") for w, n in rows], "word string, n bigint, child string, back string")
    want = {"abc": (None, "abc", 6, 1, None), "ab": ("abc", "abc", 3, 1, 6), "zz": (None, "zz", 4, 0, None)}
    assert as_dict(spelling_variants(words).collect()) == want
    assert spelling_variants(words.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(words, dominance=1)
    ids, texts = odd_rows()
    assert as_dict(spelling_variants(frequent_words(misspelt_runs(table(spark, texts, ids)))).collect()) == (
        plain_variants(plain_words(ids, texts))
    )
