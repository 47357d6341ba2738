"""TF-IDF features as (doc_id, term, weight) tables.

Weights follow the common smoothed definition: idf = ln((1 + n) / (1 + df)) + 1,
term frequency raw or 1 + ln(tf), vectors scaled to unit length.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.functions import text as tx
from threadlens.operators.ordering import numbered
from threadlens.sources.tables import materialize, materialize_by, session_settings


#: Characters of text whose terms one task counts: at most some 100 MB of memory, and not
#: less than a task is worth.
PARTITION_CHARS, LEAST_CHARS = 4_000_000, 250_000
#: Such partitions whose different terms one task sums up.
SUMMED_PARTITIONS = 4


def term_partitions(docs: DataFrame, text_col: str = "text") -> int:
    """Partitions for the terms of the texts by their length, so that none grows with the input."""
    own = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chars = docs.agg(F.sum(F.length(text_col).cast("bigint")).alias("n")).first()["n"] or 0
    return max(1, min(own, chars // LEAST_CHARS), -(-chars // PARTITION_CHARS))


def written_terms(docs: DataFrame, name: str, partitions: int | None = None, **settings) -> DataFrame:
    """``doc_terms`` as a written table in buckets of documents, each as large as a task counted."""
    n = partitions or term_partitions(docs, settings.get("text_col", "text"))
    return materialize_by(doc_terms(docs, partitions=n, **settings), "doc_id", name, n)


def doc_terms(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngram_max: int = 2,
    stop_words: list[str] | None = None,
    partitions: int | None = None,
    known: Vocabulary | None = None,
) -> DataFrame:
    """(doc_id, term, tf) for all runs of 1..ngram_max terms, or those of a ``known`` vocabulary.

    Terms outside a capped vocabulary are dropped before they are counted, which takes most
    of the time; larger vocabularies drop nothing here.

    Documents are distributed by id before they are split, so that counting and
    every later step per document runs without moving the exploded terms.  Terms take many
    times the room of their text, so the number of partitions follows the characters.
    """
    found = _listed_terms(docs, id_col, text_col, ngram_max, stop_words, partitions)
    if known is not None and known.small:
        found = found.join(F.broadcast(known.table.select("term")), "term", "left_semi")
    return found.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def _listed_terms(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngram_max: int = 2,
    stop_words: list[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """(doc_id, term) for every occurrence of a run of 1..ngram_max terms."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spread = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    spread = spread.repartition(partitions or term_partitions(docs, text_col), "doc_id")
    words = spread.select("doc_id", tx.once(tx.terms(F.col("text"), stop_words)).alias("w"))
    grams = [tx.ngrams(F.col("w"), n) for n in range(1, ngram_max + 1)]
    return words.select("doc_id", F.explode(F.concat(*grams)).alias("term"))


def frequent_terms(docs: DataFrame, max_features: int | None, partitions: int, **settings) -> Vocabulary | None:
    """The ``max_features`` terms of the highest total frequency, where they are few enough to broadcast.

    They are found without counting per document, so that ``doc_terms`` counts and writes
    nothing but these.  The table has the column ``term`` alone.
    """
    known = Vocabulary(docs, max_features, False, 0)
    if not known.small:
        return None
    totals = _listed_terms(docs, partitions=partitions, **settings).groupBy("term").agg(F.count("*").alias("tf"))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-partitions // SUMMED_PARTITIONS))
    with session_settings(docs.sparkSession, {"spark.sql.shuffle.partitions": str(tasks)}):
        top = materialize(totals.orderBy(F.desc("tf"), "term").limit(max_features).select("term"), "frequent-terms")
    return replace(known, table=top)


BROADCAST_TERMS = 100_000  # larger vocabularies are joined by shuffling


@dataclass(frozen=True)
class Vocabulary:
    """Fitted terms: a table (term, df, tf, idf), its size bound and the corpus size."""

    table: DataFrame
    max_features: int | None
    sublinear: bool
    n_docs: int

    @property
    def small(self) -> bool:
        """Whether the size is capped, low enough to broadcast one row per term."""
        return self.max_features is not None and self.max_features <= BROADCAST_TERMS

    def hinted(self, per_term: DataFrame) -> DataFrame:
        """A table with one row per term, marked for broadcast if its size is capped."""
        return F.broadcast(per_term) if self.small else per_term


def vocabulary(
    counts: DataFrame,
    n_docs: int,
    max_features: int | None = None,
    min_df: int = 1,
    max_df: float = 1.0,
) -> DataFrame:
    """(term, df, tf, idf); with a cap, the terms of the highest total frequency."""
    table = (
        counts.groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))
        .filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
        .withColumn("idf", F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)
    )
    if max_features is not None:
        table = table.orderBy(F.desc("tf"), "term").limit(max_features)
    return table


def fit(
    counts: DataFrame,
    n_docs: int,
    max_features: int | None = None,
    min_df: int = 1,
    max_df: float = 1.0,
    sublinear: bool = False,
    index: bool = False,
    partitions: int | None = None,
) -> Vocabulary:
    """Fit once and keep the vocabulary as a written table.

    With ``index`` the terms also get a dense number ``idx`` in term order, by a
    range-partitioned sort.  ``partitions`` are those of ``counts``: as many tasks read and sum up
    its terms, and tasks with the sums follow their number, so that none grows with the text.
    """
    spark = counts.sparkSession
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(own, -(-(partitions or 0) // SUMMED_PARTITIONS))
    bounded = {"spark.sql.shuffle.partitions": str(tasks)}
    if partitions:
        bounded["spark.sql.files.minPartitionNum"] = str(partitions)
    with session_settings(spark, bounded):
        table = vocabulary(counts, n_docs, max_features, min_df, max_df)
        if index:
            table = numbered(table, ["term"], "idx").withColumn("idx", F.col("idx").cast("int"))
        return Vocabulary(materialize(table, "vocabulary"), max_features, sublinear, n_docs)


def _raw_weights(counts: DataFrame, vocab: Vocabulary, *columns: str) -> DataFrame:
    """(doc_id, columns, raw): term frequency times idf before scaling."""
    tf = F.lit(1.0) + F.log("tf") if vocab.sublinear else F.col("tf").cast("double")
    extra = [c for c in columns if c != "term"]
    known = vocab.hinted(vocab.table.select("term", "idf", *extra))
    return counts.join(known, "term").select("doc_id", *columns, (tf * F.col("idf")).alias("raw"))


def weights(counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(doc_id, term, weight) of unit length; unknown terms are dropped."""
    raw = _raw_weights(counts, vocab, "term")
    # a document's terms come from one row, so this window is bounded by its text
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("raw") / norm).alias("weight"))


def sparse_rows(counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(doc_id, indices, values): unit-length rows of an indexed vocabulary.

    One row per document with a known term, indices ascending.
    """
    pairs = F.sort_array(F.collect_list(F.struct("idx", "raw")))
    rows = _raw_weights(counts, vocab, "idx").groupBy("doc_id").agg(
        pairs.alias("p"), F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm")
    )
    return rows.select(
        "doc_id",
        F.col("p.idx").alias("indices"),
        F.transform("p.raw", lambda x: x / F.col("norm")).alias("values"),
    )


def with_empty_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One sparse row per id; documents without a known term get an empty one."""
    empty_i = F.expr("cast(array() as array<int>)")
    empty_v = F.expr("cast(array() as array<double>)")
    return ids.join(rows, "doc_id", "left").withColumns(
        {"indices": F.coalesce("indices", empty_i), "values": F.coalesce("values", empty_v)}
    )
