import sys
from pathlib import Path

import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
from cases import odd_rows, prose, table  # noqa: E402

from threadlens.llm.simhash_dedup import (  # noqa: E402
    block_masks,
    close_links,
    drop_near_duplicates,
    simhash_groups,
)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, distance=4):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_groups_equal_brute_force(spark):
    texts = prose(1, 120)
    fps = [plain_fingerprint(t) for t in texts]
    rows = simhash_groups(table(spark, texts, extra=True)).collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    roots = plain_groups(fps)
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in range(len(texts))}
    assert len(set(roots)) < len(roots)


@pytest.mark.parametrize("bucket_rows", [1, 3, 100_000])
@pytest.mark.parametrize("distance", [3, 4])
def test_crowded_buckets_link_the_same_fingerprints(spark, bucket_rows, distance):
    import random

    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = list(
        {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(25)}
    )
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = close_links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), distance, 6, bucket_rows)
    found = {(r.a, r.b) for r in links.collect()}
    place = {s: i for i, s in enumerate(signed)}
    root = list(range(len(fps)))
    for a, b in found:
        assert (fps[place[a]] ^ fps[place[b]]).bit_count() <= distance
        x, y = root[place[a]], root[place[b]]
        root = [min(x, y) if r in (x, y) else r for r in root]
    assert root == plain_groups(fps, distance)


def test_masks_cover_every_choice():
    masks = block_masks(6, 4)
    assert len(masks) == 15 and all(20 <= (m & (1 << 64) - 1).bit_count() <= 22 for m in masks)


def test_odd_rows(spark):
    ids, texts = odd_rows()
    rows = simhash_groups(table(spark, texts, ids, extra=True)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
    by_id = {r.doc_id: r for r in rows}
    # without words: fingerprint zero, one component
    assert {by_id[i].fingerprint for i in (1, 2, 3)} == {"0" * 16}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[7].component_id == 6
    kept = drop_near_duplicates(table(spark, texts, ids, extra=True))
    assert kept.columns == table(spark, texts, ids, extra=True).columns
    assert 7 not in {r.doc_id for r in kept.collect()}


def test_empty_table(spark):
    assert simhash_groups(table(spark, [])).count() == 0
    assert drop_near_duplicates(table(spark, [])).count() == 0
