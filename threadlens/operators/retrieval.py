"""Exact top-k similarity search, nearest-neighbour and constant baselines.

Text queries meet documents in blocks of sparse rows (``_sparse_topk``); for dense vectors
see ``operators.dense``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from threadlens import params as P
from threadlens.functions import text as tx
from threadlens.operators import features
from threadlens.operators.dense import MARGIN, SCORE_DIGITS, dense_topk  # noqa: F401
from threadlens.sources.tables import materialize, session_settings

SEED_POSTINGS = 8  # times k postings give the first lower bound of a query's k-th score
OWN_ROWS = 3  # entries of a list that are added up in the time of one of a document's row
#: (term, weight) entries of a block of queries and of documents, some 75 and 50 MB, and of
#: queries that are worth a task of their own.
QUERY_ENTRIES, BLOCK_ENTRIES, LEAST_ENTRIES = 6_000_000, 4_000_000, 50_000
#: A partition for every file of blocks, and one pair of blocks at a time in a task.
ONE_BLOCK = {"spark.sql.files.openCostInBytes": str(1 << 27), "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
#: Characters of evidence up to which each executor gets all of it.
BROADCAST_CHARS = 64_000_000


@dataclass(frozen=True)
class TextIndex:
    """A fitted vocabulary with numbered terms and the written unit rows of a corpus.

    ``rows`` are (doc_id, indices, values), one per document with a known term, ``ids`` all
    doc_ids.
    """

    vocab: features.Vocabulary
    rows: DataFrame
    ids: DataFrame
    ngram_max: int


def build_index(corpus: DataFrame, max_features: int | None, ngram_max: int = 2) -> TextIndex:
    """Index a corpus (doc_id, text)."""
    n = features.term_partitions(corpus)
    counts = features.written_terms(corpus, "corpus-terms", n, ngram_max=ngram_max)
    vocab = features.fit(counts, corpus.count(), max_features, index=True, partitions=n)
    return TextIndex(
        vocab,
        materialize(features.sparse_rows(counts, vocab), "corpus-rows"),
        materialize(corpus.select("doc_id"), "corpus-ids"),
        ngram_max,
    )


def _entry_count(rows: DataFrame) -> int:
    return rows.agg(F.sum(F.size("indices")).alias("n")).first()["n"] or 0


def _blocks(rows: DataFrame, key: str, most: int) -> DataFrame:
    """(ids, sizes, indices, values): the sparse rows of a partition in blocks of some ``most`` entries.

    A block is one row, its sparse rows in the order of their ids; it is made where its rows lie.
    """
    id_type = rows.schema[key].dataType
    kinds = {"ids": id_type, "sizes": T.IntegerType(), "indices": T.IntegerType(), "values": T.DoubleType()}
    schema = T.StructType([T.StructField(c, T.ArrayType(kind)) for c, kind in kinds.items()])

    def block(parts: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(parts)
        table = table.take(pa.compute.sort_indices(table, sort_keys=[(key, "ascending")], null_placement="at_start"))
        ids, lists = table.column(key).combine_chunks(), [table.column(c).combine_chunks() for c in ("indices", "values")]
        flat = [ids, pa.compute.list_value_length(lists[0]), *[x.flatten() for x in lists]]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(x)], x) for x in flat], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            ends = np.cumsum(pa.compute.list_value_length(batch.column("indices")).to_numpy(), dtype=np.int64)
            at = before = 0
            while at < len(ends):
                to = min(len(ends), int(np.searchsorted(ends, before + most - n, "left")) + 1)
                parts.append(table.slice(at, to - at))
                n, before, at = n + int(ends[to - 1]) - before, int(ends[to - 1]), to
                if n >= most:
                    yield block(parts)
                    parts, n = [], 0
        if parts:
            yield block(parts)

    return rows.select(key, "indices", "values").mapInArrow(run, schema)


def _unpacked(ids: pa.ListScalar, sizes: pa.ListScalar, indices: pa.ListScalar, values: pa.ListScalar) -> pa.Table:
    """The sparse rows of a block."""
    starts = pa.array(np.concatenate([[0], np.cumsum(sizes.values.to_numpy())]), pa.int32())
    lists = [pa.ListArray.from_arrays(starts, x.values) for x in (indices, values)]
    return pa.table([ids.values, *lists], names=["id", "indices", "values"])


def _entries(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each row begins, term numbers and weights of all rows."""
    lists = [rows.column(c).combine_chunks() for c in ("indices", "values")]
    lengths = pa.compute.list_value_length(lists[0]).to_numpy()
    starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return starts, *[x.flatten().to_numpy(zero_copy_only=False) for x in lists]


def _best_in_block(
    asked: pa.Table, held: pa.Table, k: int, seeds: int, known_scores: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and documents, and scores, of each query's k best documents of a block.

    ``held`` is in the order of ids.  Whole scores of some documents under a query's rarest terms,
    up to ``seeds`` postings, give a floor for its k-th best score.  Terms that even at their
    largest weights stay below the floor all together cannot bring in a document, so only the
    lists of the others are added up.  The likeliest documents are scored whole then, which
    raises the floor; those that may still reach it are scored from their own rows if they are
    few, else the other lists are added too.  A document is in a term's list once, so lists add
    up in place; only documents that share a term with the query come out.
    ``known_scores``, k a query in descending order, are the best of other blocks: the last is
    a floor as well.  Those of this block are merged into them.
    """
    begin, terms, weights = _entries(asked)
    row_starts, row_terms, row_values = _entries(held)
    order = np.argsort(row_terms, kind="stable")
    docs, own = np.repeat(np.arange(len(held)), np.diff(row_starts))[order], row_terms[order]
    values = row_values[order]
    known, heads = np.unique(own, return_index=True)
    largest = np.zeros(max(own[-1], terms.max()) + 1)
    largest[known] = np.maximum.reduceat(values, heads)
    first, last = np.searchsorted(own, terms, "left"), np.searchsorted(own, terms, "right")
    bounds = weights * largest[terms]
    scores, query = np.zeros(len(held)), np.zeros(len(largest))
    row_size = len(own) / len(held)

    def whole(some: np.ndarray) -> np.ndarray:
        """Scores of documents from all of their terms."""
        lengths = row_starts[some + 1] - row_starts[some]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(row_starts[some] - ends + lengths, lengths)
        places = np.repeat(np.arange(len(some)), lengths)
        return np.bincount(places, query[row_terms[at]] * row_values[at], len(some))

    def add(chosen: np.ndarray) -> None:
        for i in chosen:
            at = slice(first[i], last[i])
            scores[docs[at]] += weights[i] * values[at]

    def kth(found: np.ndarray) -> float:
        return np.partition(found, -k)[-k] if len(found) >= k else 0.0

    places, found, best = [], [], []
    for q in range(len(asked)):
        mine = np.arange(begin[q], begin[q + 1])
        query[terms[mine]] = weights[mine]
        own_terms, mine = terms[mine], mine[last[mine] > first[mine]]
        rare = mine[np.argsort(last[mine] - first[mine], kind="stable")]
        sizes = last[rare] - first[rare]
        rare = rare[np.cumsum(sizes) - sizes < seeds]
        lists = [docs[first[i] : min(last[i], first[i] + seeds)] for i in rare]
        floor = kth(whole(np.unique(np.concatenate(lists)))) if lists else 0.0
        floor = max(floor, 0.0 if known_scores is None else known_scores[q, -1]) - MARGIN
        weak = mine[np.argsort(bounds[mine], kind="stable")]
        n_weak = np.searchsorted(np.cumsum(bounds[weak]), floor, "left")
        weak, leads = weak[:n_weak], weak[n_weak:]
        scores[:] = 0
        add(leads)
        rest = bounds[weak].sum()
        near = np.flatnonzero(scores >= max(floor - rest, np.nextafter(0, 1)))
        if len(near) > seeds:
            likely = near[np.argpartition(scores[near], -seeds)[-seeds:]]
            floor = max(floor, kth(whole(likely)) - MARGIN)
            near = near[scores[near] >= floor - rest]
        if len(near) * row_size * OWN_ROWS < (last[weak] - first[weak]).sum():
            rounded = np.round(whole(near), SCORE_DIGITS)
        else:
            add(weak)
            near = near[scores[near] >= floor]
            rounded = np.round(scores[near], SCORE_DIGITS)
        query[own_terms] = 0
        if len(near) > k:
            some = np.flatnonzero(rounded >= np.partition(rounded, -k)[-k])
            near, rounded = near[some], rounded[some]
        top = np.argsort(-rounded, kind="stable")[:k]
        if known_scores is not None:
            known_scores[q] = np.sort(np.append(known_scores[q], rounded[top]))[: -k - 1 : -1]
        places.append(np.full(len(top), q))
        found.append(near[top])
        best.append(rounded[top])
    return np.concatenate(places), np.concatenate(found), np.concatenate(best)


def _sparse_topk(rows: DataFrame, index: TextIndex, k: int) -> DataFrame:
    """The k best (query_id, doc_id, score) of queries (query_id, indices, values), exactly.

    Queries and documents are written once, in blocks of bounded size.  Every block of queries
    meets the blocks of documents, which are read again for it and not shuffled; a task takes a
    block of queries through all of them, or a core's share, and sends on k rows a query.  What
    it has found is a floor for the blocks that follow.  Pairs that share a term are never rows.
    """
    seeds = SEED_POSTINGS * k
    asked = materialize(_blocks(rows.filter("query_id IS NOT NULL"), "query_id", QUERY_ENTRIES), "query-blocks")
    n_held = max(1, -(-_entry_count(index.rows) // BLOCK_ENTRIES))
    held = materialize(_blocks(index.rows.coalesce(n_held), "doc_id", BLOCK_ENTRIES), "corpus-blocks")
    schema = T.StructType([rows.schema["query_id"], index.rows.schema["doc_id"]]).add("score", "double")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known_scores = None, np.zeros((0, k))
        for batch in batches:
            for row in range(len(batch)):
                cells = [batch.column(c)[row] for c in range(8)]
                left, right = _unpacked(*cells[:4]), _unpacked(*cells[4:])
                if last is None or not last.equals(left):
                    last, known_scores = left, np.zeros((len(left), k))
                queries, docs, scores = _best_in_block(left, right, k, seeds, known_scores)
                columns = [left.column("id").take(pa.array(queries)), right.column("id").take(pa.array(docs)), pa.array(scores)]
                yield from pa.table(columns, names=schema.names).combine_chunks().to_batches()

    met = asked.toDF(*[f"asked_{c}" for c in asked.columns]).crossJoin(held.hint("shuffle_replicate_nl"))
    blocks, entries = asked.agg(F.count("*"), F.sum(F.size("indices"))).first()
    shares = max(1, min(blocks, (entries or 0) // LEAST_ENTRIES))
    # pairs with the same block of queries lie next to each other; few queries leave cores
    # idle, unless the blocks of documents are dealt out too
    cores = rows.sparkSession.sparkContext.defaultParallelism
    met = met.coalesce(max(shares, min(cores, shares * held.count())))
    pairs = met.mapInArrow(best, schema)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return pairs.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def search(queries: DataFrame, index: TextIndex, k: int) -> DataFrame:
    """TF-IDF cosine top-k of queries (query_id, text): (query_id, doc_id, score, rank).

    Blank queries return nothing.  Documents of similarity zero fill the k places
    in id order when fewer documents share a term with the query.
    """
    asked = queries.filter(~tx.is_blank(F.col("text"))).select(
        F.col("query_id").alias("doc_id"), tx.ustrip(F.col("text")).alias("text")
    )
    counts = features.doc_terms(asked, ngram_max=index.ngram_max, known=index.vocab)
    rows = features.sparse_rows(counts, index.vocab).withColumnRenamed("doc_id", "query_id")
    pairs = _sparse_topk(rows, index, k)
    with session_settings(queries.sparkSession, ONE_BLOCK):
        best = materialize(pairs, "matches")
    # at most k lowest ids are taken by matches, so 2 k of them are enough to fill up
    lowest = [r["doc_id"] for r in index.ids.orderBy("doc_id").limit(2 * k).collect()]
    kind = index.ids.schema["doc_id"].dataType.simpleString()
    fillers = F.array(*[F.lit(x) for x in lowest]).cast(f"array<{kind}>")
    matched = best.groupBy(F.col("query_id").alias("doc_id")).agg(
        F.collect_list("doc_id").alias("matched")
    )
    matched_ids = F.coalesce("matched", F.array().cast(f"array<{kind}>"))
    have = F.size(matched_ids)
    filled = (
        asked.select("doc_id")
        .join(matched, "doc_id", "left")
        .select(
            F.col("doc_id").alias("query_id"),
            have.alias("have"),
            F.posexplode(F.slice(F.array_except(fillers, matched_ids), 1, F.lit(k) - have)).alias(
                "place", "doc_id"
            ),
        )
        .select(
            "query_id",
            "doc_id",
            F.lit(0.0).alias("score"),
            (F.col("have") + F.col("place") + 1).alias("rank"),
        )
    )
    return best.unionByName(filled)


def text_topk(
    queries: DataFrame, corpus: DataFrame, k: int, max_features: int | None, ngram_max: int = 2
) -> DataFrame:
    return search(queries, build_index(corpus, max_features, ngram_max), k)


def evidence_list(matches: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per query: its matches in rank order as an array of evidence structs.

    ``evidence`` has doc_id, customer_text and brand_reply; an array holds at most
    k entries.  Evidence of bounded size meets the matches where their query lies, so that
    texts are not moved once for every query that finds them.
    """
    chars = F.sum(F.coalesce(F.length("customer_text"), F.lit(0)).cast("bigint") + F.coalesce(F.length("brand_reply"), F.lit(0)))
    if (evidence.agg(chars.alias("n")).first()["n"] or 0) <= BROADCAST_CHARS:
        matches, evidence = matches.repartition("query_id"), F.broadcast(evidence)
    item = F.struct(
        "rank",
        F.col("doc_id").alias("conversation_id"),
        "customer_text",
        "brand_reply",
        F.round("score", 4).alias("similarity_score"),
        "score",
    )
    return (
        matches.join(evidence, "doc_id")
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(item)).alias("evidence"))
    )


def nearest_baseline(
    queries: DataFrame, corpus: DataFrame, p: P.Params, text: str = "text"
) -> DataFrame:
    """Label and reply of the nearest corpus row, and a keyword escalation rule.

    ``queries`` has query_id and text, ``corpus`` doc_id, text, label and reply.
    """
    lowered = queries.select("query_id", F.lower(tx.ustrip(F.col(text))).alias("text"))
    # a query without known terms is as near to every row: the first one answers
    keyed = lowered.withColumn("text", F.when(F.col("text") == "", F.lit("-")).otherwise(F.col("text")))
    best = text_topk(keyed, corpus, 1, p.classifier_features)
    answers = best.join(corpus.select("doc_id", "label", "reply"), "doc_id").drop("doc_id", "rank")
    # a corpus without rows answers nothing: the constant baseline takes its place
    constant = constant_baseline(lowered, p)
    escalate = tx.contains_any(F.col("text"), P.NEAREST_BASELINE_WORDS)
    decision = F.when(escalate, "ESCALATE").otherwise("AUTO_HANDLE")
    known = F.col("score").isNotNull()
    own = {
        "predicted_intent": F.col("label"),
        "confidence": F.greatest(F.col("score"), F.lit(p.baseline_confidence_floor)),
        "escalation_decision": decision,
        "generated_reply": F.substring("reply", 1, p.max_reply_length),
    }
    fallback = {c: F.col(f"constant_{c}") for c in own}
    met = lowered.join(answers, "query_id", "left").join(
        constant.select("query_id", *[F.col(c).alias(f"constant_{c}") for c in own]), "query_id"
    )
    return met.select("query_id", *[F.when(known, v).otherwise(fallback[c]).alias(c) for c, v in own.items()])


def constant_baseline(queries: DataFrame, p: P.Params, intent: str = "order_status") -> DataFrame:
    """The same intent, confidence, decision and reply for every query."""
    reply = (
        f"Thank you for reaching out to {p.brand_handle}. "
        "Please send us a Direct Message with your order details so we can assist you."
    )
    return queries.select(
        "query_id",
        F.lit(intent).alias("predicted_intent"),
        F.lit(0.35).alias("confidence"),
        F.lit("AUTO_HANDLE").alias("escalation_decision"),
        F.lit(reply).alias("generated_reply"),
    )


def majority_label(labels: DataFrame, column: str = "label") -> str:
    """The most frequent label, smallest on ties."""
    top = labels.groupBy(column).count().orderBy(F.desc("count"), column).first()
    return top[column]
