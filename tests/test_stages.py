"""The classifier as ML stages: fitted, saved, loaded and put into the scoring plan."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from test_models import texts

from threadlens import Params
from threadlens.operators import classify as cl
from threadlens.operators.stages import ADDED, IntentClassifier, IntentClassifierModel
from threadlens.plans import scoring


def labelled(spark):
    corpus = texts(60, 8)
    rows = [(f"m{i}", t, "refund" if "refund" in t else "late" if "late" in t else "other") for i, t in enumerate(corpus)]
    return spark.createDataFrame([*rows, ("blank", " ", "other")], "key string, body string, kind string")


def as_rows(df):
    return {r["key"]: (r["predicted_intent"], r["confidence"], [tuple(c) for c in r["candidates"]]) for r in df.collect()}


def test_saved_and_loaded_models_score_alike(spark, tmp_path):
    rows = labelled(spark)
    estimator = IntentClassifier(idCol="key", textCol="body", labelCol="kind", features=40, top=2)
    estimator.write().overwrite().save(str(tmp_path / "estimator"))
    again = IntentClassifier.load(str(tmp_path / "estimator"))
    assert {p.name: v for p, v in again.extractParamMap().items()} == {p.name: v for p, v in estimator.extractParamMap().items()}
    model = estimator.fit(rows)
    want = as_rows(model.transform(rows))
    assert len(want) == 61 and want["blank"][:2] == ("general_inquiry", 1.0)
    assert {len(c) for _, _, c in want.values()} == {1, 2}
    plain = cl.train(rows.toDF("doc_id", "text", "label"), Params(classifier_features=40))
    same = {r.doc_id: r.predicted_intent for r in cl.classify(rows.toDF("doc_id", "text", "label"), plain).collect()}
    assert same == {k: v[0] for k, v in want.items()}
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = IntentClassifierModel.load(str(tmp_path / "model"))
    assert loaded.uid == model.uid and as_rows(loaded.transform(rows)) == want
    # earlier columns of these names are replaced, other columns stay
    twice = loaded.transform(loaded.transform(rows))
    assert as_rows(twice) == want and sorted(twice.columns) == sorted([*rows.columns, *ADDED])
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS|overwrite"):
        model.save(str(tmp_path / "model"))


def test_a_saved_pipeline_in_the_scoring_plan(spark, tmp_path):
    rows = labelled(spark).toDF("doc_id", "text", "label")
    renamed = SQLTransformer(statement="SELECT *, lower(text) AS low FROM __THIS__")
    fitted = Pipeline(stages=[renamed, IntentClassifier(textCol="low", features=40)]).fit(rows)
    fitted.write().overwrite().save(str(tmp_path / "pipeline"))
    loaded = PipelineModel.load(str(tmp_path / "pipeline"))
    evidence = rows.selectExpr("doc_id", "text AS customer_text", "label AS brand_reply")
    asked = rows.select("doc_id", "text")
    results = [
        {r.doc_id: (r.predicted_intent, r.confidence, r.generated_reply) for r in scoring.score_messages(asked, scoring.scorer_of(m, evidence, Params())).collect()}
        for m in (loaded, fitted.stages[1].model)
    ]
    assert results[0] == results[1] and len(results[0]) == 61
