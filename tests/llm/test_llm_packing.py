import random
import struct
import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import odd_rows, prose, table  # noqa: E402

from threadlens.llm.packing import BestFit, default_tokenizer_path, pack_documents, sequences  # noqa: E402


def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer_path())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def layout(rows, limit):
    """Checks that sequences are gapless and within the limit; pieces by sequence."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limit
    return by


def test_pieces_and_round_trip(spark):
    texts = prose(11, 40) + ["It's <|endoftext|> a TEST\x0bof é é   odd blanks", None, ""]
    limit = 64
    rows = pack_documents(
        table(spark, texts, extra=True), max_tokens=limit, with_ids=True
    )
    got = rows.collect()
    by = layout(got, limit)
    for i, ids in enumerate(encoded(texts)):
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == list(range(0, len(ids), limit))
        for r in own:
            part = ids[r.start : r.start + limit]
            raw = struct.pack(f"<{len(part)}I", *part)
            assert (r.length, bytes(r.ids), r.ids_crc32) == (len(part), raw, zlib.crc32(raw))
    for s in sequences(rows).collect():
        want = b"".join(bytes(r.ids) for r in sorted(by[s.sequence_id], key=lambda r: r.offset))
        assert bytes(s.ids) == want and s.n_tokens * 4 == len(want)


@pytest.mark.parametrize("open_bins", [1, 4, 1000])
def test_best_fit_equals_a_plain_search(open_bins):
    rng = random.Random(2)
    bins, plain, closed = BestFit(50, open_bins), {}, 0
    for _ in range(2_000):
        length = rng.randint(1, 50)
        fitting = [f for f in plain.values() if f >= length]
        number, offset = bins.add(length)
        if fitting:
            assert plain[number] == min(fitting) == 50 - offset
        else:
            assert offset == 0 and number not in plain
            plain[number] = 50
        plain[number] -= length
        if not plain[number]:
            del plain[number]
        if len(plain) > open_bins:
            least = min(plain.values())
            # among equally full bins any may close
            open_now = {n for own in bins.by_free for n in own}
            gone = [n for n in plain if n not in open_now]
            assert len(gone) == 1 and plain.pop(gone[0]) == least
            closed += 1
        assert bins.n_open == len(plain) <= open_bins
    assert closed or open_bins == 1000


def test_odd_rows(spark):
    ids, texts = odd_rows()
    rows = pack_documents(table(spark, texts, ids, extra=True)).collect()
    layout(rows, 4096)
    assert {str(r.doc_id) for r in rows} == set(map(str, ids))
    assert [r.length for r in rows if r.doc_id == 1] == [1]
    assert len([r for r in rows if r.doc_id == 6]) == 2
    assert pack_documents(table(spark, [])).count() == 0


def test_few_sequences(spark):
    texts = prose(12, 200)
    rows = pack_documents(table(spark, texts), max_tokens=512).collect()
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.1 * total / 512 + 2
