"""Intent classifier: TF-IDF features and multinomial logistic regression.

MLlib trains the model on sparse vectors.  Scoring needs no vectors: a linear
model is a small (term -> weight per class) table, so a message's scores are a
join with that table and one sum per class.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens import params as P
from threadlens.functions import text as tx
from threadlens.operators import features
from threadlens.sources.schemas import resolve_column
from threadlens.sources.tables import materialize, write_table


#: Rows that are worth a partition of their own in training, and rows of a full partition.
LEAST_ROWS, MOST_ROWS = 2_500, 25_000


def as_vectors(sparse: DataFrame, size: int, n_rows: int, keep: list[str]) -> DataFrame:
    """(indices, values) columns as a written table with an ML vector column.

    A vector column is stored as the struct below, so the table is written with
    the struct and read with the vector type.  Training passes over it many times, and in
    every pass each partition sends a whole gradient: there are as many as there are cores,
    and more only where rows are many; tiny tables are read by few tasks.
    """
    stored = sparse.select(
        *keep,
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(size).alias("size"),
            F.col("indices"),
            F.col("values"),
        ).alias("features"),
    )
    path = write_table(stored, "vectors")
    schema = T.StructType(
        [f for f in stored.schema.fields if f.name in keep] + [T.StructField("features", VectorUDT())]
    )
    vectors = sparse.sparkSession.read.schema(schema).parquet(path)
    cores = sparse.sparkSession.sparkContext.defaultParallelism
    return vectors.coalesce(max(1, min(cores, n_rows // LEAST_ROWS), n_rows // MOST_ROWS))


@dataclass(frozen=True)
class IntentModel:
    """Trained classifier: vocabulary with one weight array per term, intercepts."""

    vocab: features.Vocabulary
    coefficients: DataFrame  # term, idf, coef: array<double>, one entry per class
    intercepts: list[float]
    classes: list[str]
    ngram_max: int


def training_columns(df: DataFrame) -> DataFrame:
    """(doc_id, text, label) from a table that names them in one of the known ways."""
    text = resolve_column(df, "text", "primary_text", "customer_text")
    label = resolve_column(df, "primary_intent", "intent")
    key = resolve_column(df, "doc_id", "conversation_id")
    return df.select(
        F.col(key).alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.col(label).cast("string").alias("label"),
    )


def train(df: DataFrame, p: P.Params) -> IntentModel:
    """Fit on (doc_id, text, label) rows; labels may be any set of strings."""
    spark = df.sparkSession
    rows = materialize(df.select("doc_id", "text", "label"), "training")
    n_docs = rows.count()
    n = features.term_partitions(rows)
    known = features.frequent_terms(rows, p.classifier_features, n, ngram_max=p.ngram_max)
    counts = features.written_terms(rows, "training-terms", n, ngram_max=p.ngram_max, known=known)
    vocab = features.fit(counts, n_docs, p.classifier_features, sublinear=True, index=True, partitions=n)
    # labels are a closed set, a few dozen at most
    classes = [r["label"] for r in rows.select("label").distinct().orderBy("label").collect()]
    label_ids = spark.createDataFrame(list(enumerate(map(str, classes))), "y int, label string")
    sparse = features.sparse_rows(counts, vocab)
    labelled = (
        features.with_empty_rows(sparse, rows.select("doc_id", "label"))
        .join(F.broadcast(label_ids), "label")
        .select(F.col("y").cast("double").alias("y"), "indices", "values")
    )
    size = vocab.table.count()
    vectors = as_vectors(labelled, size, n_docs, ["y"])
    estimator = LogisticRegression(
        featuresCol="features",
        labelCol="y",
        family="multinomial",
        maxIter=p.classifier_iterations,
        tol=p.classifier_tolerance,
        regParam=1.0 / (p.inverse_regularization * n_docs),
        elasticNetParam=0.0,
        standardization=False,
    )
    model = estimator.fit(vectors)
    matrix = model.coefficientMatrix.toArray()  # classes x capped vocabulary
    table = [(j, [float(x) for x in matrix[:, j]]) for j in range(matrix.shape[1])]
    coef = spark.createDataFrame(table, "idx int, coef array<double>")
    coefficients = vocab.table.join(vocab.hinted(coef), "idx").select("term", "idf", "coef")
    return IntentModel(
        vocab,
        materialize(coefficients, "coefficients"),
        [float(x) for x in model.interceptVector],
        classes,
        p.ngram_max,
    )


def linear_model(
    vocab: features.Vocabulary, weights: DataFrame, intercepts: dict[str, float], ngram_max: int
) -> IntentModel:
    """A model from given weights (term, label, weight) and one intercept per label.

    Terms that are not in the vocabulary and labels without an intercept are left out;
    a pair that is not listed weighs nothing.
    """
    classes = sorted(intercepts)
    per_label = [
        F.coalesce(F.sum(F.when(F.col("label") == c, F.col("weight"))), F.lit(0.0)).cast("double") for c in classes
    ]
    coef = weights.groupBy("term").agg(F.array(*per_label).alias("coef"))
    coefficients = vocab.table.select("term", "idf").join(coef, "term")
    return IntentModel(
        vocab, materialize(coefficients, "coefficients"), [float(intercepts[c]) for c in classes], classes, ngram_max
    )


def certificate(df: DataFrame, model: IntentModel, p: P.Params, bound: float) -> DataFrame:
    """One row that says whether a fitted model is near the optimum of its training rows.

    The gradient of the penalised mean loss is, per class and term, the mean of (probability
    minus label) times the term's weight in each row, plus the penalty times the coefficient;
    intercepts have no penalty.  It is one sum over (row, term) pairs, so nothing but this row
    reaches the driver.  (n_docs, n_terms, n_classes, gradient, optimal): ``optimal`` if the
    gradient's length is at most ``bound``.
    """
    rows = materialize(df.select("doc_id", "text", "label"), "certified")
    n = rows.count()
    k = len(model.classes)
    counts = features.doc_terms(rows, ngram_max=model.ngram_max, known=model.vocab)
    per_term = model.vocab.table.select("term", "idf").join(model.coefficients.select("term", "coef"), "term", "left")
    hits = counts.join(model.vocab.hinted(per_term), "term").withColumn("raw", _tf(model) * F.col("idf"))
    # terms stay with their document, so texts are read once for the scores and the sums
    weighed = F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm")
    terms = F.collect_list(F.struct("term", "raw")).alias("terms")
    sums = hits.groupBy("doc_id").agg(*_sums(model, F.col("coef").isNotNull()), weighed, terms)
    scored = rows.select("doc_id").join(sums, "doc_id", "left").withColumn("scores", _scores(model))
    peak = F.array_max("scores")
    exp = F.transform("scores", lambda s: F.exp(s - peak))
    total = F.aggregate(exp, F.lit(0.0), lambda a, x: a + x)
    labels = F.array(*[F.lit(c) for c in model.classes])
    off = F.zip_with(
        F.transform(exp, lambda e: e / total), labels, lambda q, c: q - (c == F.col("label")).cast("double")
    )
    residuals = scored.join(rows.select("doc_id", "label"), "doc_id").select("terms", "norm", off.alias("off"))
    # the intercept is a term of weight one in every document, without a name
    own = F.struct(F.lit(None).cast("string").alias("term"), F.lit(1.0).alias("weight"))
    listed = F.transform("terms", lambda t: F.struct(t["term"].alias("term"), (t["raw"] / F.col("norm")).alias("weight")))
    listed = F.concat(F.coalesce(listed, F.array().cast("array<struct<term:string,weight:double>>")), F.array(own))
    slopes = residuals.select("off", F.explode(listed).alias("t")).groupBy("t.term").agg(
        F.array(*[F.sum(F.col("t.weight") * F.col("off")[i]) / n for i in range(k)]).alias("slope")
    )
    slopes = materialize(slopes, "slopes")
    penalty = 1.0 / (p.inverse_regularization * max(1, n))
    none = F.array_repeat(F.lit(0.0), k)
    whole = model.coefficients.join(slopes, "term", "left").select(
        F.zip_with(F.coalesce("slope", none), "coef", lambda g, w: g + F.lit(penalty) * w).alias("g")
    )
    square = F.aggregate("g", F.lit(0.0), lambda a, x: a + x * x)
    intercepts = slopes.filter("term IS NULL").select(F.col("slope").alias("g"))
    length = F.sqrt(F.coalesce(F.sum(square), F.lit(0.0)))
    n_terms = model.coefficients.agg(F.count("*").alias("n_terms"))
    return (
        whole.unionByName(intercepts)
        .agg(length.alias("gradient"))
        .crossJoin(F.broadcast(n_terms))
        .select(
            F.lit(n).cast("bigint").alias("n_docs"),
            "n_terms",
            F.lit(k).cast("bigint").alias("n_classes"),
            "gradient",
            (F.col("gradient") <= bound).alias("optimal"),
        )
    )


def _tf(model: IntentModel) -> Column:
    return F.lit(1.0) + F.log("tf") if model.vocab.sublinear else F.col("tf").cast("double")


def _sums(model: IntentModel, known: Column | None = None) -> list[Column]:
    """Square and class sums of a message's ``raw`` weights, of ``known`` terms."""
    raw = F.col("raw") if known is None else F.when(known, F.col("raw"))
    return [
        F.sum(raw * raw).alias("sq"),
        *[F.sum(raw * F.col("coef")[i]).alias(f"s{i}") for i in range(len(model.classes))],
    ]


def _scores(model: IntentModel) -> Column:
    """Linear scores; the unit-length scaling is one factor per message, applied after the sum."""
    return F.array(
        *[
            F.coalesce(F.col(f"s{i}") / F.sqrt("sq"), F.lit(0.0)) + F.lit(model.intercepts[i])
            for i in range(len(model.classes))
        ]
    )


def class_scores(messages: DataFrame, model: IntentModel) -> DataFrame:
    """(doc_id, scores array) for (doc_id, text) rows: linear scores per class."""
    counts = features.doc_terms(messages, ngram_max=model.ngram_max, known=model.vocab)
    hits = counts.join(model.vocab.hinted(model.coefficients), "term").withColumn(
        "raw", _tf(model) * F.col("idf")
    )
    sums = hits.groupBy("doc_id").agg(*_sums(model))
    return messages.select("doc_id").join(sums, "doc_id", "left").select("doc_id", _scores(model).alias("scores"))


def classify(messages: DataFrame, model: IntentModel, top: int = 3) -> DataFrame:
    """(doc_id, predicted_intent, confidence, candidates) for (doc_id, text) rows.

    Candidates are the best ``top`` (intent, prob) pairs; ties go to the first
    label.  Blank messages are general inquiries with certainty.
    """
    peak = F.array_max("scores")
    exp = F.transform("scores", lambda s: F.exp(s - F.col("_peak")))
    total = F.aggregate("_exp", F.lit(0.0), lambda a, x: a + x)
    labels = F.array(*[F.lit(c) for c in model.classes])
    ranked = F.array_sort(
        F.zip_with("_exp", labels, lambda e, l: F.struct((-e / F.col("_total")).alias("neg"), l.alias("intent")))
    )
    best = F.transform(
        F.slice(ranked, 1, top),
        lambda r: F.struct(r["intent"].alias("intent"), (-r["neg"]).alias("prob")),
    )
    blank_answer = F.array(F.struct(F.lit("general_inquiry").alias("intent"), F.lit(1.0).alias("prob")))
    blanks = messages.select("doc_id", tx.is_blank(F.col("text")).alias("blank"))
    return (
        class_scores(messages, model)
        .withColumn("_peak", peak)
        .withColumn("_exp", exp)
        .withColumn("_total", total)
        .withColumn("_best", best)
        .join(blanks, "doc_id")
        .withColumn("candidates", F.when(F.col("blank"), blank_answer).otherwise(F.col("_best")))
        .select(
            "doc_id",
            F.col("candidates")[0]["intent"].alias("predicted_intent"),
            F.col("candidates")[0]["prob"].alias("confidence"),
            "candidates",
        )
    )
