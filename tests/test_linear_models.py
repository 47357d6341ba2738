"""Models of given weights, and the check that a fitted one is near its optimum."""

import dataclasses

import numpy as np
import pytest
from test_models import brute_tfidf, frame, texts

from threadlens import Params
from threadlens.operators import classify as cl
from threadlens.operators import features as ft
from threadlens.plans import scoring
from threadlens.sources.tables import materialize

P = Params(classifier_tolerance=1e-7)


def labelled(spark, n=80):
    corpus = texts(n, 5)
    labels = ["refund" if "refund" in t else "late" if "late" in t else "other" for t in corpus]
    rows = [(i, t, label) for i, (t, label) in enumerate(zip(corpus, labels))]
    return corpus, labels, spark.createDataFrame(rows, "doc_id bigint, text string, label string")


def plain_gradient(corpus, labels, model, penalty):
    coef = {r["term"]: np.array(r["coef"]) for r in model.coefficients.collect()}
    vector = brute_tfidf(corpus, 10**6, sublinear=True)
    slope, free = {t: penalty * w for t, w in coef.items()}, np.zeros(len(model.classes))
    for text, label in zip(corpus, labels):
        own = vector(text)
        s = np.array(model.intercepts) + sum((w * coef[t] for t, w in own.items()), np.zeros(len(free)))
        off = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
        off[model.classes.index(label)] -= 1
        free += off / len(corpus)
        for t, w in own.items():
            slope[t] = slope[t] + w * off / len(corpus)
    return np.sqrt(sum((g * g).sum() for g in slope.values()) + (free * free).sum())


def test_certificate_is_the_length_of_the_gradient(spark):
    corpus, labels, rows = labelled(spark)
    model = cl.train(rows, P)
    penalty = 1 / (P.inverse_regularization * len(corpus))
    fitted = cl.certificate(rows, model, P, 1e-3).first()
    assert (fitted.n_docs, fitted.n_terms, fitted.n_classes) == (80, model.coefficients.count(), 3)
    assert fitted.optimal and fitted.gradient == pytest.approx(plain_gradient(corpus, labels, model, penalty), abs=1e-9)
    moved = model.coefficients.selectExpr("term", "idf", "transform(coef, (x, i) -> x + i) AS coef")
    worse = dataclasses.replace(model, coefficients=materialize(moved, "moved"))
    checked = cl.certificate(rows, worse, P, 1e-3).first()
    assert not checked.optimal
    assert checked.gradient == pytest.approx(plain_gradient(corpus, labels, worse, penalty), rel=1e-9)


def test_given_weights_equal_a_plain_softmax(spark):
    corpus, _, _ = labelled(spark)
    counts = ft.doc_terms(frame(spark, corpus))
    vocab = ft.fit(counts, len(corpus), 50, sublinear=True)
    terms = sorted(r["term"] for r in vocab.table.collect())
    given = [(t, c, ((len(t) * 7 + k * 3) % 11) - 5.0) for t in terms for k, c in enumerate("xyz") if len(t) % 3 != k]
    given += [("not a term", "x", 9.0), (terms[0], "unknown", 9.0)]
    weights = spark.createDataFrame(given, "term string, label string, weight double")
    model = cl.linear_model(vocab, weights, {"z": 0.5, "x": 0.0, "y": -1.0}, 2)
    assert model.classes == ["x", "y", "z"] and model.intercepts == [0.0, -1.0, 0.5]
    table, vector = {(t, c): w for t, c, w in given}, brute_tfidf(corpus, 50, sublinear=True)
    for r in cl.classify(frame(spark, corpus), model).collect():
        text = corpus[r.doc_id]
        if not text.strip():
            assert (r.predicted_intent, r.confidence) == ("general_inquiry", 1.0)
            continue
        s = np.array([b + sum(w * table.get((t, c), 0) for t, w in vector(text).items()) for c, b in zip("xyz", model.intercepts)])
        probs = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
        assert [c["prob"] for c in r.candidates] == pytest.approx(sorted(probs, reverse=True))
        assert r.confidence == pytest.approx(probs["xyz".index(r.predicted_intent)])


def test_scoring_with_given_weights(spark):
    corpus, _, rows = labelled(spark)
    vocab = ft.fit(ft.doc_terms(rows), len(corpus), None, sublinear=True)
    weights = vocab.table.selectExpr("term", "IF(term LIKE '%late%', 'late', 'refund') AS label", "8.0 AS weight")
    model = cl.linear_model(vocab, weights, {"late": 0.0, "refund": 0.0}, 2)
    evidence = rows.selectExpr("CAST(doc_id AS STRING) AS doc_id", "text AS customer_text", "label AS brand_reply")
    scored = scoring.score_messages(rows.select("doc_id", "text"), scoring.scorer_of(model, evidence, P)).collect()
    assert sorted(r.doc_id for r in scored) == list(range(80))
    for r in scored:
        if "late" in corpus[r.doc_id] and len(corpus[r.doc_id].split()) == 1:
            assert r.predicted_intent == "late"
