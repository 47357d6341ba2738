"""The intent classifier as Spark ML stages, to be put into pipelines, saved and swapped."""

from __future__ import annotations

import dataclasses

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators import classify as cl
from threadlens.operators import features
from threadlens.params import Params as Settings

ADDED = ["predicted_intent", "confidence", "candidates"]


class _Columns(Params):
    """Names of the id, text and label columns."""

    idCol = Param(Params._dummy(), "idCol", "column that tells rows apart", TypeConverters.toString)
    textCol = Param(Params._dummy(), "textCol", "column with the text", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "column with the label", TypeConverters.toString)
    top = Param(Params._dummy(), "top", "candidates per row", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(idCol="doc_id", textCol="text", labelCol="label", top=3)

    def _named(self, df: DataFrame, *params: Param) -> DataFrame:
        names = {"idCol": "doc_id", "textCol": "text", "labelCol": "label"}
        return df.select(*[F.col(self.getOrDefault(p)).alias(names[p.name]) for p in params])


class IntentClassifier(_Columns, Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """Fits TF-IDF features and a multinomial logistic regression on (id, text, label) rows."""

    features = Param(Params._dummy(), "features", "size of the vocabulary", TypeConverters.toInt)
    ngramMax = Param(Params._dummy(), "ngramMax", "longest run of words that is a term", TypeConverters.toInt)
    regularization = Param(Params._dummy(), "regularization", "inverse strength of the penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations at most", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "tolerance of the fit", TypeConverters.toFloat)

    def __init__(self, **params):
        super().__init__()
        p = Settings()
        self._setDefault(
            features=p.classifier_features,
            ngramMax=p.ngram_max,
            regularization=p.inverse_regularization,
            maxIter=p.classifier_iterations,
            tol=p.classifier_tolerance,
        )
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> IntentClassifierModel:
        settings = Settings(
            classifier_features=self.getOrDefault(self.features),
            ngram_max=self.getOrDefault(self.ngramMax),
            inverse_regularization=self.getOrDefault(self.regularization),
            classifier_iterations=self.getOrDefault(self.maxIter),
            classifier_tolerance=self.getOrDefault(self.tol),
        )
        model = cl.train(self._named(dataset, self.idCol, self.textCol, self.labelCol), settings)
        return self._copyValues(IntentClassifierModel(model))


class IntentClassifierModel(_Columns, Model, MLWritable, MLReadable):
    """Adds predicted_intent, confidence and candidates to rows with an id and a text.

    Rows that share an id share their text; columns of these names are replaced.
    """

    def __init__(self, model: cl.IntentModel | None = None):
        super().__init__()
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        asked = self._named(dataset, self.idCol, self.textCol).dropDuplicates(["doc_id"])
        scored = cl.classify(asked, self.model, self.getOrDefault(self.top))
        key = self.getOrDefault(self.idCol)
        return dataset.drop(*ADDED).join(scored.withColumnRenamed("doc_id", key), key, "left")

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    """Settings and intercepts as metadata, vocabulary and coefficients as tables."""

    def __init__(self, stage: IntentClassifierModel):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        model, vocab = self.stage.model, self.stage.model.vocab
        extra = {"classes": model.classes, "intercepts": model.intercepts, "ngram_max": model.ngram_max}
        extra["vocabulary"] = {f.name: getattr(vocab, f.name) for f in dataclasses.fields(vocab) if f.name != "table"}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"model": extra})
        vocab.table.write.parquet(f"{path}/vocabulary")
        model.coefficients.write.parquet(f"{path}/coefficients")


class _ModelReader(MLReader):
    def load(self, path: str) -> IntentClassifierModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        own = metadata["model"]
        tables = self.sparkSession.read
        vocab = features.Vocabulary(table=tables.parquet(f"{path}/vocabulary"), **own["vocabulary"])
        model = cl.IntentModel(
            vocab, tables.parquet(f"{path}/coefficients"), own["intercepts"], own["classes"], own["ngram_max"]
        )
        stage = IntentClassifierModel(model)
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage
