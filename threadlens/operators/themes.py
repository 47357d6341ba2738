"""Theme discovery: TF-IDF features of opening messages, clustered by mini-batch k-means."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens import params as P
from threadlens.operators import features, minibatch
from threadlens.sources.tables import materialize


@dataclass(frozen=True)
class Themes:
    """Result tables of a clustering run."""

    assignments: DataFrame  # doc_id, cluster, distance
    clusters: DataFrame  # cluster, size, frequency_pct, theme_label
    terms: DataFrame  # cluster, rank, word, weight
    examples: DataFrame  # cluster, rank, doc_id, text
    n_clusters: int


def theme_features(
    openings: DataFrame, p: P.Params, min_df: int = 3, max_df: float = 0.8, max_features: int = 5000
) -> tuple[DataFrame, features.Vocabulary]:
    """Sparse rows of opening messages (doc_id, text), written, and their vocabulary."""
    counts = features.written_terms(openings, "opening-terms", ngram_max=p.ngram_max, stop_words=P.STOP_WORDS)
    vocab = features.fit(
        counts, openings.count(), max_features, min_df=min_df, max_df=max_df, sublinear=True, index=True
    )
    rows = features.with_empty_rows(features.sparse_rows(counts, vocab), openings.select("doc_id"))
    return materialize(rows, "theme-rows"), vocab


def discover_themes(
    openings: DataFrame, p: P.Params, min_df: int = 3, max_df: float = 0.8,
    max_features: int = 5000, top_terms: int = 10, **batching,
) -> Themes:
    """Cluster opening messages (doc_id, text) by mini-batches; refuses too small inputs."""
    docs = materialize(openings.select("doc_id", "text"), "openings")
    n = docs.count()
    if n < 2 * p.n_clusters:
        raise ValueError("Insufficient data for clustering")
    k = min(p.n_clusters, n // 5)
    rows, vocab = theme_features(docs, p, min_df, max_df, max_features)
    centres = minibatch.mini_batch_kmeans(rows, k, p.seed, **batching)
    return describe_themes(docs, rows, vocab, centres, p, top_terms)


def describe_themes(
    docs: DataFrame, rows: DataFrame, vocab: features.Vocabulary, centres: minibatch.Centres,
    p: P.Params, top_terms: int = 10,
) -> Themes:
    """Sizes, terms and examples of the clusters around given centres.

    ``docs`` are (doc_id, text), ``rows`` their sparse rows.
    """
    assignments = materialize(minibatch.nearest(rows, centres), "assignments")
    sizes = (
        assignments.groupBy("cluster")
        .agg(F.count("*").alias("size"))
        .filter(F.col("size") >= p.min_cluster_size)
        .withColumn("frequency_pct", F.round(F.col("size") * 100.0 / docs.count(), 1))
    )
    by_weight = Window.partitionBy("cluster").orderBy(F.desc("c"), "word")
    words = (
        centres.values.withColumn("c", F.round("value", 9)).filter("c > 0")
        .join(vocab.table.select("idx", F.col("term").alias("word")), "idx")
        .withColumn("rank", F.row_number().over(by_weight))
        .filter(F.col("rank") <= top_terms)
        .join(sizes.select("cluster"), "cluster", "left_semi")
        .select("cluster", "rank", "word", F.round("value", 4).alias("weight"))
    )
    label = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]), " / "
    )
    labels = words.filter("rank <= 3").groupBy("cluster").agg(label.alias("theme_label"))
    clusters = sizes.join(labels, "cluster", "left").orderBy(F.desc("size"), "cluster")
    by_distance = Window.partitionBy("cluster").orderBy("distance", "doc_id")
    examples = (
        assignments.join(sizes.select("cluster"), "cluster", "left_semi")
        .withColumn("rank", F.row_number().over(by_distance))
        .filter(F.col("rank") <= p.samples_per_cluster)
        .join(docs, "doc_id")
        .select("cluster", "rank", "doc_id", F.substring("text", 1, 200).alias("text"))
    )
    return Themes(assignments, clusters, words, examples, centres.k)
