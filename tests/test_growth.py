"""What is moved and held grows no faster than the input."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadlens.operators import classify as cl
from threadlens.operators import dense
from threadlens.operators import features as ft
from threadlens.operators import keywords as kw
from threadlens.operators import quality as qu
from threadlens.operators import retrieval as rt
from threadlens.operators.ordering import HotGroups
from threadlens.params import Params
from threadlens.sources.tables import session_settings


def numbered(spark, rows, key, column="text"):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"{key} bigint, {column} string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("least, entries", [(10**6, 10**6), (5, 40)])
def test_text_search_moves_no_pairs(spark, monkeypatch, least, entries):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    corpus = [" ".join(["every", *rng.choices(words, k=rng.randint(1, 9))]) for _ in range(90)]
    corpus[70] = corpus[3]
    docs, asked = numbered(spark, corpus, "doc_id"), numbered(spark, corpus[:40], "query_id")
    index = rt.build_index(docs, None, 1)
    for name, value in (("LEAST_ENTRIES", least), ("QUERY_ENTRIES", entries), ("BLOCK_ENTRIES", entries)):
        monkeypatch.setattr(rt, name, value)
    rows = ft.sparse_rows(ft.doc_terms(asked.withColumnRenamed("query_id", "doc_id"), ngram_max=1), index.vocab)
    top = rt._sparse_topk(rows.withColumnRenamed("doc_id", "query_id"), index, 3)
    assert "Join" not in plan(top)
    weights = {(r.doc_id, r.term): r.weight for r in ft.weights(ft.doc_terms(docs, ngram_max=1), index.vocab).collect()}
    rowsof = {}
    for (d, t), w in weights.items():
        rowsof.setdefault(d, {})[t] = w
    got = {}
    for r in sorted(top.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.doc_id)
    for q in range(40):
        score = lambda d: round(sum(w * rowsof[d].get(t, 0) for t, w in rowsof[q].items()), 9)  # noqa: E731, B023
        assert got[q] == sorted(range(90), key=lambda d: (-score(d), d))[:3]


def test_partitions_of_terms_follow_the_text(spark, monkeypatch):
    docs = numbered(spark, ["late parcel again"] * 200, "doc_id")
    monkeypatch.setattr(ft, "PARTITION_CHARS", 200)
    counts = ft.written_terms(docs, "growth")
    assert ft.doc_terms(docs).rdd.getNumPartitions() == 17
    assert counts.count() == 1_000
    per_document = plan(counts.groupBy("doc_id").count())
    assert "Exchange" not in per_document and "SelectedBucketsCount: 17 out of 17" in per_document


@pytest.mark.parametrize("few", [0, 200])
def test_windows_of_texts_are_no_rows(spark, monkeypatch, few):
    monkeypatch.setattr(kw, "FEW_KEYWORDS", few)
    texts = numbered(spark, ["Late parcel, LATE again", None, "a parcel", ""], "doc_id")
    words = spark.createDataFrame([("x", "late"), ("y", "Parcel"), ("z", "late"), ("x", "nothing")], "category string, keyword string")
    hits = kw.keyword_hits(texts, words, "doc_id")
    assert "Generate" not in plan(hits)
    assert sorted(map(tuple, hits.collect())) == [(0, "x", "late"), (0, "y", "parcel"), (0, "z", "late"), (2, "y", "parcel")]


def test_dense_queries_travel_once_a_group(spark, monkeypatch):
    monkeypatch.setattr(dense, "GROUP_ROWS", 50)
    rng = np.random.default_rng(6)
    m = rng.normal(size=(120, 5))
    m[100:] = m[:20]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "doc_id bigint, vector array<double>")
    index = dense.build_dense_index(frame, 30)
    group, blocks = dense._grouped(index, 50)
    assert len(blocks) <= 5 and set(group) == set(index.sizes)
    top = dense.search_dense(frame.withColumnRenamed("doc_id", "query_id"), index, 4, 10).top
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(u @ u.T, 9)
    got = {}
    for r in top.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.doc_id)
    assert got == {i: sorted(range(120), key=lambda j: (-sims[i, j], j))[:4] for i in range(120)}  # noqa: B023


@pytest.mark.parametrize("bound", [0, 10**6])
def test_evidence_texts_stay_out_of_shuffles(spark, monkeypatch, bound):
    monkeypatch.setattr(rt, "BROADCAST_CHARS", bound)
    rows = [("a", "late parcel", "on its way"), ("b", None, "sorry"), ("b", "again", None), (None, "lost", "x")]
    evidence = spark.createDataFrame(rows, "doc_id string, customer_text string, brand_reply string")
    found = [(1, "a", 0.51234, 2), (1, "b", 0.9, 1), (2, "a", 0.3, 1), (3, "c", 0.2, 1), (None, "a", 0.1, 1)]
    matches = spark.createDataFrame(found, "query_id bigint, doc_id string, score double, rank int")
    out = rt.evidence_list(matches, evidence)
    # the queries are dealt out below the join with the texts, or else above it
    above = plan(out).split("Exchange hashpartitioning(query_id")
    assert len(above) == 2 and ("Join" in above[0]) == bool(bound)
    got = {r.query_id: [(e["rank"], e.conversation_id, e.customer_text, e.brand_reply, e.similarity_score) for e in r.evidence] for r in out.collect()}
    twice = [(1, "b", None, "sorry", 0.9), (1, "b", "again", None, 0.9)]
    last = lambda rank, score: (rank, "a", "late parcel", "on its way", score)
    assert got == {1: [*twice, last(2, 0.5123)], 2: [last(1, 0.3)], None: [last(1, 0.1)]}


def test_tasks_of_vocabularies_follow_the_text(spark, monkeypatch):
    docs = numbered(spark, ["late parcel again"] * 200, "doc_id")
    monkeypatch.setattr(ft, "PARTITION_CHARS", 100)
    before, plans, write = spark.conf.get("spark.sql.shuffle.partitions"), [], ft.materialize
    monkeypatch.setattr(ft, "materialize", lambda df, name: plans.append(plan(df)) or write(df, name))
    n = ft.term_partitions(docs)
    vocab = ft.fit(ft.written_terms(docs, "growth", n), 200, 3, partitions=n)
    assert n == 34 and re.findall(r"Exchange hashpartitioning\(term#\d+, (\d+)\)", plans[0]) == ["9"]
    assert sorted(map(tuple, vocab.table.select("term", "df", "tf").collect())) == [(t, 200, 200) for t in ("again", "late", "late parcel")]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert ft.fit(ft.doc_terms(docs), 200, 3).table.count() == 3


@pytest.mark.parametrize("n_rows, partitions", [(30_000, 4), (100_000, 4), (200_000, 8), (3_000, 1)])
def test_training_sends_few_gradients_a_pass(spark, n_rows, partitions):
    rows = spark.range(24).selectExpr("id AS y", "array(0) AS indices", "array(1.0D) AS values").repartition(12)
    with session_settings(spark, {"spark.sql.files.minPartitionNum": "48"}):
        vectors = cl.as_vectors(rows, 1, n_rows, ["y"])
        assert vectors.rdd.getNumPartitions() == partitions
    assert vectors.count() == 24


def test_blocks_of_text_search_are_not_shuffled(spark, monkeypatch):
    for name, value in (("LEAST_ENTRIES", 5), ("QUERY_ENTRIES", 12), ("BLOCK_ENTRIES", 20)):
        monkeypatch.setattr(rt, name, value)
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(8)], k=rng.randint(1, 6))) for _ in range(40)]
    docs = numbered(spark, texts, "doc_id").unionByName(numbered(spark, ["w1 w2"], "doc_id").withColumn("doc_id", F.lit(None).cast("bigint")))
    index = rt.build_index(docs, None, 1)
    blocks = rt._blocks(index.rows, "doc_id", 20)
    assert blocks.selectExpr("min(size(ids) = size(sizes) AND size(indices) = aggregate(sizes, 0, (a, x) -> a + x))").first()[0]
    assert blocks.selectExpr("sum(size(ids))").first()[0] == index.rows.count() > blocks.count()
    rows = ft.sparse_rows(ft.doc_terms(docs, ngram_max=1), index.vocab).withColumnRenamed("doc_id", "query_id")
    top = rt._sparse_topk(rows, index, 2)
    # narrow matches alone are dealt out
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan(top)) == ["query_id"]
    assert top.count() == 2 * 40
    # few queries take as many tasks as there are cores
    tasks = re.findall(r"Coalesce (\d+)", plan(rt._sparse_topk(rows.filter("query_id = 3"), index, 2)))
    assert tasks == ["4"]


def test_texts_of_duplicates_move_once(spark):
    rows = [
        ("c1", "t2", "ann", "the parcel is late", 5), ("c1", "t1", "ann", "the parcel is late", 5), ("c2", "t0", "ann", "the parcel is late", 1),
        ("c2", "t3", "bob", "the parcel is late", 2), ("c2", "t4", None, "no parcel has come", 2), ("c1", "t5", None, "no parcel has come", None),
        (None, "t6", "eve", "is anybody there", 1), (None, "t6", "eve", "is anybody there", 1), ("c1", "t7", "ann", "thanks for nothing", 9),
        ("c1", None, "dan", "still no parcel", 3), ("c1", "t8", "dan", "still no parcel", 3), ("c3", "t9", "dan", "one message alone", 3),
    ]
    frame = spark.createDataFrame(rows, "conversation_id string, tweet_id string, author_id string, text string, created_at int")
    hot = HotGroups(None, 1_000)
    kept = qu.quality_filter(frame, Params(min_thread_length=2), hot, twice=True)
    last = lambda x: (x is None, x)
    first = {}
    for r in sorted(rows, key=lambda r: (last(r[0]), last(r[4]), last(r[1]))):
        first.setdefault((r[2], r[3]), r)
    sizes = Counter(r[0] for r in first.values())
    expected = [r for r in first.values() if r[0] is None or sizes[r[0]] >= 2]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, expected))
    moved = [line for line in plan(kept).splitlines() if "Exchange hashpartitioning(author_id" in line]
    assert moved and not any("text#" in line for line in moved)


def test_best_of_other_blocks_are_a_floor():
    rng = np.random.default_rng(9)

    def rows(n):
        lists = [np.sort(rng.choice(30, rng.integers(1, 9), replace=False)) for _ in range(n)]
        weights = [rng.integers(1, 4, len(x)).astype(float) for x in lists]
        columns = [pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))]
        columns.append(pa.array([(w / np.linalg.norm(w)).tolist() for w in weights], pa.list_(pa.float64())))
        return pa.table([pa.array(range(n)), *columns], names=["id", "indices", "values"])

    asked, blocks, k = rows(20), [rows(25) for _ in range(6)], 3
    blocks[4] = blocks[1]
    best = {True: {}, False: {}}
    sent = {True: 0, False: 0}
    for carried in best:
        known_scores = np.zeros((20, k)) if carried else None
        for b, held in enumerate(blocks):
            for q, d, s in zip(*rt._best_in_block(asked, held, k, 8 * k, known_scores)):
                best[carried].setdefault(q, []).append((-s, b, d))
                sent[carried] += 1
    assert {q: sorted(x)[:k] for q, x in best[True].items()} == {q: sorted(x)[:k] for q, x in best[False].items()}
    assert sent[True] < sent[False]


def test_block_search_selects_among_few_documents(monkeypatch):
    rng = np.random.default_rng(4)

    def rows(n, most):
        lists = [np.sort(rng.choice(400, rng.integers(1, most), replace=False, p=chances)) for _ in range(n)]
        weights = [rng.integers(1, 5, len(x)) / (1 + 40 * chances[x]) for x in lists]
        columns = [pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))]
        columns.append(pa.array([(w / np.linalg.norm(w)).tolist() for w in weights], pa.list_(pa.float64())))
        return pa.table([pa.array(range(n)), *columns], names=["id", "indices", "values"])

    chances = 1 / np.arange(5, 405)
    chances /= chances.sum()
    asked, held, k = rows(40, 12), rows(3_000, 12), 3
    dense = [np.zeros((len(t), 400)) for t in (asked, held)]
    for table, d in zip((asked, held), dense):
        for i, r in enumerate(table.to_pylist()):
            d[i, r["indices"]] = r["values"]
    scores = np.round(dense[0] @ dense[1].T, rt.SCORE_DIGITS)
    want = [(q, d, s[d]) for q, s in enumerate(scores) for d in np.argsort(-s, kind="stable")[:k] if s[d] > 0]
    sizes, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda x, n: sizes.append(len(x)) or partition(x, n))
    for own_rows in (0, 3, 10**9):
        monkeypatch.setattr(rt, "OWN_ROWS", own_rows)
        found = list(zip(*rt._best_in_block(asked, held, k, 8 * k)))
        assert [x[:2] for x in found] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in found], [x[2] for x in want], atol=2e-9)
    # before, every query sorted the scores of all documents
    assert np.mean(sizes) < len(held) / 10


def test_terms_outside_a_capped_vocabulary_are_not_counted(spark):
    docs = spark.createDataFrame([(i % 7 or None, f"aa bb w{i} aa") for i in range(30)], "doc_id int, text string")
    counts = ft.doc_terms(docs)
    vocab = ft.fit(counts, 30, 9, index=True)
    top = ft.frequent_terms(docs, 9, 2)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(top.table) == rows(vocab.table.select("term")) and len(rows(top.table)) == 9
    few = ft.written_terms(docs, "terms", 2, known=top)
    assert rows(few) == rows(counts.join(top.table, "term", "left_semi").select("doc_id", "term", "tf"))
    assert rows(ft.fit(few, 30, 9, index=True).table) == rows(vocab.table)
    assert ft.frequent_terms(docs, None, 2) is None
    assert rows(ft.doc_terms(docs, known=ft.fit(counts, 30))) == rows(counts)


def test_certificate_reads_the_texts_once(spark, monkeypatch):
    rows = [(i, f"aa b{i % 3}b word{i}", "xyz"[i % 3]) for i in range(12)]
    # an id that comes twice counts its terms together, in both of its rows and with both labels
    rows += [(11, "aa aa", "x"), (None, "aa cc", "y"), (20, None, "z"), (21, "--", "z")]
    df = spark.createDataFrame(rows, "doc_id int, text string, label string")
    model, calls, counted = cl.train(df, Params()), [], ft.doc_terms
    monkeypatch.setattr(ft, "doc_terms", lambda *a, **b: calls.append(1) or counted(*a, **b))
    found = cl.certificate(df, model, Params(), 1e-3).first()
    assert len(calls) == 1
    weights = {}
    for r in ft.weights(counted(df), model.vocab).collect():
        weights.setdefault(r.doc_id, {})[r.term] = r.weight
    coef = {r.term: np.array(r.coef) for r in model.coefficients.collect()}
    slope, free = {t: c / len(rows) for t, c in coef.items()}, np.zeros(3)
    pairs = [(a[0], b[2]) for a in rows for b in rows if a[0] == b[0] and a[0] is not None]
    for key, label in pairs:
        own = weights.get(key, {})
        s = sum((w * coef[t] for t, w in own.items()), np.array(model.intercepts))
        off = np.exp(s - s.max()) / np.exp(s - s.max()).sum() - np.array([c == label for c in model.classes])
        free += off / len(rows)
        for t, w in own.items():
            slope[t] = slope[t] + w * off / len(rows)
    assert found.gradient == pytest.approx(np.sqrt(free @ free + sum(g @ g for g in slope.values())))
    assert (found.n_docs, found.n_terms) == (len(rows), len(coef))
