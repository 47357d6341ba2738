"""Features, retrieval, classifier and themes against brute force and invariants."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens import Params
from threadlens.operators import classify as cl
from threadlens.operators import features as ft
from threadlens.operators import retrieval as rt
from threadlens.operators import themes as th
from threadlens.sources import seeds
from threadlens.sources.schemas import resolve_column

WORDS = "order parcel refund login broken screen late driver card charge über naïve help price x1 a".split()


def texts(n, seed, longest=9):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, longest))) for _ in range(n)]


def grams(text):
    w = re.findall(r"\w\w+", text.lower())
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def brute_tfidf(corpus, cap, sublinear=False):
    counts = [Counter(grams(t)) for t in corpus]
    total, df = Counter(), Counter()
    for c in counts:
        total.update(c)
        df.update(c.keys())
    vocab = sorted(total, key=lambda t: (-total[t], t))[:cap]
    idf = {t: math.log((1 + len(corpus)) / (1 + df[t])) + 1 for t in vocab}

    def vector(text):
        raw = {t: ((1 + math.log(n)) if sublinear else n) * idf[t] for t, n in Counter(grams(text)).items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        return {t: v / norm for t, v in raw.items()} if norm else {}

    return vector


def frame(spark, values, key="doc_id"):
    return spark.createDataFrame(list(enumerate(values)), f"{key} bigint, text string").repartition(3)


@pytest.mark.parametrize("sublinear", [False, True])
def test_weights(spark, sublinear):
    corpus = texts(60, 1)
    counts = ft.doc_terms(frame(spark, corpus))
    vocab = ft.fit(counts, len(corpus), 40, sublinear=sublinear, index=True)
    vector = brute_tfidf(corpus, 40, sublinear)
    got = {}
    for r in ft.weights(counts, vocab).collect():
        got.setdefault(r["doc_id"], {})[r["term"]] = r["weight"]
    want = {i: vector(t) for i, t in enumerate(corpus) if vector(t)}
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i])
    index = {r["idx"]: r["term"] for r in vocab.table.collect()}
    for r in ft.sparse_rows(counts, vocab).collect():
        assert {index[i]: v for i, v in zip(r["indices"], r["values"])} == pytest.approx(want[r["doc_id"]])


def test_document_frequency_bounds(spark):
    counts = ft.doc_terms(frame(spark, ["aa bb", "aa cc", "aa bb"]), ngram_max=1)
    kept = {r["term"]: (r["df"], r["tf"]) for r in ft.vocabulary(counts, 3, min_df=2, max_df=0.8).collect()}
    assert kept == {"bb": (2, 2)}


@pytest.mark.parametrize("k, cap", [(1, 30), (4, 30), (4, None), (50, 30)])
def test_topk_is_exact(spark, monkeypatch, k, cap):
    # one term in every document; few seeds, so that the floors are low
    corpus = [f"{t} everywhere" for t in texts(50, 2)]
    asked = [*texts(12, 3), "everywhere", "zzz unknown", "  "]
    monkeypatch.setattr(rt, "SEED_POSTINGS", 1)
    got = rt.text_topk(frame(spark, asked, "query_id"), frame(spark, corpus), k, cap).collect()
    vector = brute_tfidf(corpus, cap)
    docs = [vector(t) for t in corpus]
    for i, text in enumerate(asked):
        mine = [(r["doc_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == i]
        if not text.strip():
            assert mine == []
            continue
        v = vector(text)
        scores = [round(sum(w * d.get(t, 0) for t, w in v.items()), 9) for d in docs]
        want = sorted(range(50), key=lambda j: (-scores[j], j))[:k]
        assert [d for d, _ in mine] == want
        assert [s for _, s in mine] == pytest.approx([scores[j] for j in want], abs=1e-8)


def test_dense_topk(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(40, 6))
    m[7] = m[3] * 2
    v = spark.createDataFrame([(f"v{i:02d}", [float(x) for x in r]) for i, r in enumerate(m)], "id string, vector array<double>")
    got = rt.dense_topk(v.withColumnRenamed("id", "query_id"), v.withColumnRenamed("id", "doc_id"), 3, 9).collect()
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(u @ u.T, 9)
    for i in range(40):
        want = sorted(range(40), key=lambda j: (-sims[i, j], j))[:3]
        mine = [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == f"v{i:02d}"]
        assert mine == [f"v{j:02d}" for j in want]


def test_retrieval_fixture_and_k_beyond_corpus(spark):
    rows = [("c1", "Where is my parcel tracking now"), ("c2", "charged twice on the card"), ("c3", "app crashes in cart")]
    corpus = spark.createDataFrame(rows, "doc_id string, text string")
    asked = spark.createDataFrame([("q", "where is my parcel?")], "query_id string, text string")
    got = rt.text_topk(asked, corpus, 10, 10_000).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == ["c1", "c2", "c3"] and got[2]["score"] == 0.0


def test_nearest_baseline(spark):
    corpus = spark.createDataFrame([(1, "parcel late", "delivery", "r" * 300), (2, "card charged twice", "billing", "ok")], "doc_id bigint, text string, label string, reply string")
    asked = spark.createDataFrame([(1, "CARD charged twice"), (2, "  "), (3, "parcel was late again")], "query_id bigint, text string")
    got = {r["query_id"]: r for r in rt.nearest_baseline(asked, corpus, Params()).collect()}
    assert (got[1]["predicted_intent"], got[1]["escalation_decision"], got[1]["confidence"]) == ("billing", "ESCALATE", pytest.approx(1.0))
    assert (got[2]["predicted_intent"], got[2]["confidence"]) == ("delivery", 0.40)
    assert len(got[3]["generated_reply"]) == 280


def test_classifier(spark):
    p = Params(classifier_tolerance=1e-6)
    seed = cl.training_columns(seeds.training_rows(spark))
    model = cl.train(seed, p)
    assert len(model.classes) == 12
    asked = seed.select("doc_id", "text").union(spark.createDataFrame([("blank", " \n"), ("none", "qqq zzz")], "doc_id string, text string"))
    got = {r["doc_id"]: r for r in cl.classify(asked, model).collect()}
    assert len(got) == 62
    labels = {r["doc_id"]: r["label"] for r in seed.collect()}
    assert sum(got[k]["predicted_intent"] == v for k, v in labels.items()) >= 58
    for r in got.values():
        probs = [c["prob"] for c in r["candidates"]]
        assert len(probs) <= 3 and probs == sorted(probs, reverse=True) and 0 < sum(probs) <= 1.0 + 1e-9
        assert r["confidence"] == probs[0]
    assert (got["blank"]["predicted_intent"], got["blank"]["confidence"], len(got["blank"]["candidates"])) == ("general_inquiry", 1.0, 1)

    # probabilities equal the softmax of the linear model on brute-force features
    rows = seed.orderBy("doc_id").collect()
    vector = brute_tfidf([r["text"] for r in rows], p.classifier_features, sublinear=True)
    coef = {r["term"]: r["coef"] for r in model.coefficients.collect()}
    scores = np.array(model.intercepts) + sum(w * np.array(coef[t]) for t, w in vector(rows[0]["text"]).items())
    e = np.exp(scores - scores.max())
    assert got[rows[0]["doc_id"]]["confidence"] == pytest.approx((e / e.sum()).max())
    # the penalised optimum has a zero gradient: mean residual per class is nil
    full = {r["doc_id"]: r["scores"] for r in cl.class_scores(seed.select("doc_id", "text"), model).collect()}
    residual = np.zeros(12)
    for r in rows:
        s = np.array(full[r["doc_id"]])
        residual += np.exp(s - s.max()) / np.exp(s - s.max()).sum()
        residual[model.classes.index(r["label"])] -= 1
    assert np.abs(residual / 60).max() < 1e-3


def test_themes(spark):
    rng = random.Random(9)
    topics = [["refund", "money", "card", "charge"], ["parcel", "driver", "door", "late"], ["login", "password", "code", "account"]]
    data = []
    for i in range(90):
        words = topics[i % 3]
        data.append((f"c{i:03d}", " ".join(rng.choice(words) for _ in range(8))))
    docs = spark.createDataFrame(data, "doc_id string, text string")
    t = th.discover_themes(docs, Params(n_clusters=3))
    clusters = t.clusters.collect()
    assert sum(c["size"] for c in clusters) == 90 and [c["size"] for c in clusters] == sorted([c["size"] for c in clusters], reverse=True)
    assert all(len(c["theme_label"].split(" / ")) == 3 for c in clusters)
    assert t.assignments.count() == 90 and t.assignments.filter("distance < 0").count() == 0
    for c in clusters:
        inside = t.assignments.filter(F.col("cluster") == c["cluster"]).orderBy("distance", "doc_id").limit(5)
        shown = t.examples.filter(F.col("cluster") == c["cluster"]).orderBy("rank")
        assert [r["doc_id"] for r in inside.collect()] == [r["doc_id"] for r in shown.collect()]
    assert t.terms.groupBy("cluster").count().filter("count > 10").count() == 0
    with pytest.raises(ValueError, match="Insufficient"):
        th.discover_themes(docs.limit(5), Params(n_clusters=3))


def test_column_aliases(spark):
    df = spark.createDataFrame([("c", "t", "i")], "conversation_id string, customer_text string, intent string")
    assert cl.training_columns(df).columns == ["doc_id", "text", "label"]
    with pytest.raises(ValueError):
        resolve_column(df, "nope")
