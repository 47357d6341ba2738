"""Mini-batch k-means against a plain loop over the same batches."""

import random

import numpy as np
import pytest

from threadlens.operators import minibatch as mb

SPARSE = "doc_id bigint, indices array<int>, values array<double>"


def sparse(seed, n, size=12, groups=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        own = rng.sample(range(i % groups * 4, i % groups * 4 + 4), rng.randint(0, 3)) + rng.sample(range(size), 1)
        own = sorted(set(own)) if i % 17 else []
        rows.append((i, own, [rng.uniform(0.2, 1.0) for _ in own]))
    return rows


def dense(rows, size=12):
    m = np.zeros((len(rows), size))
    for j, (_, idx, values) in enumerate(rows):
        m[j, idx] = values
    return m


def as_matrix(centres, size=12):
    m = np.zeros((centres.k, size))
    for r in centres.values.collect():
        m[r.cluster, r.idx] = r.value
    return m


def plain_nearest(x, m):
    apart = np.round(np.maximum((x * x).sum(1)[:, None] - 2 * x @ m.T + (m * m).sum(1)[None], 0), 12)
    return apart.argmin(1), apart.min(1)


def test_rounds_equal_a_plain_loop(spark):
    rows = sparse(1, 240)
    frame = spark.createDataFrame(rows, SPARSE).repartition(3)
    by_id = dict(zip((r[0] for r in rows), dense(rows)))
    dealt, slots = mb.batches(frame, 50, 9, 7)
    held = {}
    for r in dealt.collect():
        held.setdefault(r.slot, []).append(r.doc_id)
    assert slots == 5 and sum(map(len, held.values())) == 240 and all(25 < len(v) < 80 for v in held.values())
    chosen = {r.cluster: r.doc_id for r in mb.first_centres(dealt.filter("slot = 0"), 4, 7, 2).collect()}
    assert sorted(chosen) == [0, 1, 2, 3] and set(chosen.values()) <= set(held[0])
    m, seen = np.array([by_id[chosen[c]] for c in range(4)]), np.zeros(4)
    for r in range(9):
        batch = held[r % 5]
        x = np.array([by_id[i] for i in batch])
        given, _ = plain_nearest(x, m)
        for c in range(4):
            own = x[given == c]
            if len(own):
                m[c] = (m[c] * seen[c] + own.sum(0)) / (seen[c] + len(own))
                seen[c] += len(own)
    got = mb.mini_batch_kmeans(frame, 4, seed=7, batch_rows=50, rounds=9, trials=2)
    assert as_matrix(got) == pytest.approx(m, abs=1e-9)
    assert got.seen == {c: seen[c] for c in range(4)}
    cluster, distance = plain_nearest(dense(rows), as_matrix(got))
    for r in mb.nearest(frame, got).collect():
        assert (r.cluster, r.distance) == (cluster[r.doc_id], pytest.approx(distance[r.doc_id], abs=1e-9))


def test_draws_are_rows_far_from_each_other(spark):
    # three places, one of them with nearly all rows
    rows = [(i, [0 if i < 90 else 1 if i < 95 else 2], [1.0]) for i in range(100)]
    frame = spark.createDataFrame(rows, SPARSE)
    places = [sorted(rows[r.doc_id][1][0] for r in mb.first_centres(frame, 3, seed, 1).collect()) for seed in range(3)]
    assert places == [[0, 1, 2]] * 3


def test_reruns_agree_and_few_rows(spark):
    rows = sparse(3, 60)
    runs = [
        as_matrix(mb.mini_batch_kmeans(spark.createDataFrame(rows, SPARSE).repartition(n), 3, batch_rows=20, rounds=4))
        for n in (1, 6)
    ]
    assert runs[0] == pytest.approx(runs[1], abs=1e-12)
    same = spark.createDataFrame([(i, [1], [1.0]) for i in range(6)], SPARSE)
    equal = mb.mini_batch_kmeans(same, 3, rounds=2)
    assert {(r.cluster, r.distance) for r in mb.nearest(same, equal).collect()} == {(0, 0.0)}


def test_means_of_labels(spark):
    rows = sparse(5, 30)
    labels = spark.createDataFrame([(i, i % 3) for i in range(30)], "doc_id bigint, cluster int")
    got = mb.label_means(spark.createDataFrame(rows, SPARSE), labels, 4)
    x = dense(rows)
    want = np.array([x[c::3].mean(0) for c in range(3)] + [np.zeros(12)])
    assert as_matrix(got) == pytest.approx(want) and got.seen == {0: 10, 1: 10, 2: 10}
