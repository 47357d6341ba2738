import hashlib
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import odd_rows, prose, table  # noqa: E402

from threadlens.llm import suffix_dedup  # noqa: E402
from threadlens.llm.suffix_dedup import remove_repeats  # noqa: E402
from threadlens.llm.suffix_sort import suffix_array  # noqa: E402


def test_suffix_array_equals_sorting():
    rng = random.Random(1)
    for k in range(400):
        text = [rng.randint(0, rng.choice([0, 1, 2, 30])) for _ in range(rng.randint(0, 50))]
        if k % 5 == 0 and text:
            text = text[: rng.randint(1, len(text))] * 6
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def plain(documents, width=100):
    """Result of every document of a list of bytes in corpus order."""
    seen, out = set(), []
    for data in documents:
        covered = bytearray(len(data))
        for s in range(len(data) - width + 1):
            window = data[s : s + width]
            if window in seen:
                covered[s : s + width] = b"\1" * width
            seen.add(window)
        kept = bytes(c for c, x in zip(data, covered) if not x)
        runs = sum(1 for i, x in enumerate(covered) if x and not (i and covered[i - 1]))
        out.append((len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("max_passages", [1, 20_000])
def test_spans_equal_brute_force(spark, max_passages):
    texts = prose(2, 60)
    texts += ["ab" * 400, "word " * 300, "x" * 350, "no blank " + "y" * 99, "é" * 130 + texts[0]]
    got = found(remove_repeats(table(spark, texts, extra=True), max_passages=max_passages))
    want = dict(enumerate(plain([t.encode() for t in texts])))
    assert got == want
    assert sum(w[1] for w in want.values()) > 0


def test_long_texts_are_cut_into_parts(spark, monkeypatch):
    # tasks run in other processes, so the parts are tried directly
    monkeypatch.setattr(suffix_dedup, "PART", 700)
    text = prose(3, 10)[0].encode() * 3
    windows = []
    for data, _, _, _, first, start, n in suffix_dedup._passages([text], 100):
        for f, s, k in zip(first.tolist(), start.tolist(), n.tolist()):
            windows += [(f + i, data[s + i : s + i + 100]) for i in range(k)]
    assert sorted(windows) == [(i, text[i : i + 100]) for i in range(len(text) - 99)]


def test_odd_rows(spark):
    ids, texts = odd_rows()
    rows = remove_repeats(table(spark, texts, ids, extra=True)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_bytes, by_id[1].n_removed, by_id[1].kept) == (0, 0, b"")
    assert by_id[9].n_removed == 4_999 and by_id[9].n_spans == 1
    same = [r for r in rows if r.doc_id == 6]
    assert same[0] == same[1] and same[0].n_removed == 0


def test_empty_table(spark):
    assert remove_repeats(table(spark, [])).count() == 0
