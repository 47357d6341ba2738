"""Dense top-k over cells against comparing with every vector."""

import numpy as np
import pytest

from threadlens.operators.dense import build_dense_index, search_dense

VECTORS = "vector array<float>"


def frame(spark, rows, key, kind="bigint"):
    data = [(i, None if v is None else [float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame(data, f"{key} {kind}, {VECTORS}").repartition(3)


def plain_topk(queries, corpus, k):
    def unit(v):
        v = np.array(v, np.float32).astype(float)
        return v / (np.linalg.norm(v) or 1)

    out = {}
    for q, v in queries:
        scored = [(-round(float(unit(v) @ unit(w)), 9) + 0.0, d) for d, w in corpus if w is not None]
        out[q] = [(d, -s) for s, d in sorted(scored)[:k]]
    return out


def as_dict(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    return out


def grouped(seed, n, groups=12, size=8):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, size)) * 10
    return middle[np.arange(n) % groups] + rng.normal(size=(n, size)) * 0.2


@pytest.mark.parametrize("k, cells, block_rows", [(1, 5, 7), (4, 30, 1000), (4, 1, 50), (500, 9, 64)])
def test_equals_comparing_all(spark, k, cells, block_rows):
    m = grouped(1, 300)
    m[7], m[11], m[50] = m[3] * 2, 0, 0
    corpus = [*enumerate(m), (999, None)]
    queries = [(i, m[i]) for i in range(0, 300, 7)] + [(300, np.zeros(8)), (301, -m[5])]
    index = build_dense_index(frame(spark, corpus, "doc_id"), cells)
    got = as_dict(search_dense(frame(spark, queries, "query_id"), index, k, block_rows).top.collect())
    want = plain_topk(queries, corpus, k)
    assert got.keys() == want.keys()
    for q in want:
        assert [d for d, _ in got[q]] == [d for d, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=2e-9)


def test_cells_that_cannot_matter_are_skipped(spark):
    m = grouped(2, 600)
    index = build_dense_index(frame(spark, enumerate(m), "doc_id"), 40)
    result = search_dense(frame(spark, [(i, m[i]) for i in range(100)], "query_id"), index, 3, 1_000)
    visits = result.visits.collect()
    assert len(visits) == 100
    assert sum(r.n_visited for r in visits) < 0.3 * sum(r.n_cells for r in visits)
    assert as_dict(result.top.collect()).keys() == set(range(100))


def test_text_ids_and_empty_tables(spark):
    rows = [("b", [1, 0]), ("a", [2, 0]), ("c", [0, 1])]
    corpus, queries = frame(spark, rows, "doc_id", "string"), frame(spark, rows, "query_id", "string")
    got = as_dict(search_dense(queries, build_dense_index(corpus), 2, 10).top.collect())
    assert got == {"a": [("a", 1.0), ("b", 1.0)], "b": [("a", 1.0), ("b", 1.0)], "c": [("c", 1.0), ("a", 0.0)]}
    none = search_dense(queries.limit(0), build_dense_index(corpus), 2, 10)
    assert (none.top.count(), none.visits.count()) == (0, 0)
    empty = search_dense(queries, build_dense_index(corpus.limit(0)), 2, 10)
    assert empty.top.count() == 0 and [r.n_cells for r in empty.visits.collect()] == [0, 0, 0]
    zeros = frame(spark, [("z", [0, 0]), ("y", [0, 0])], "doc_id", "string")
    got = as_dict(search_dense(queries, build_dense_index(zeros), 1, 10).top.collect())
    assert got == {q: [("y", 0.0)] for q in "abc"}


def test_reruns_agree(spark):
    m = grouped(3, 200)
    cells = [
        sorted(map(tuple, build_dense_index(frame(spark, enumerate(m), "doc_id").repartition(n), 9).vectors.select("doc_id", "cell").collect()))
        for n in (1, 5)
    ]
    assert cells[0] == cells[1]
