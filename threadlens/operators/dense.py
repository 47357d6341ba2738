"""Exact cosine top-k of dense vectors over a cell index.

Vectors are scaled to unit length and dealt to the nearest of some seeded centres.  A cell
keeps the widest angle of its members to the centre, so by the triangle inequality no
member scores more than cos(angle of query and centre - widest angle).  A query first visits
the cells with the highest bounds that hold k vectors together; the k-th score found there
is a floor, and of the other cells only those are visited whose bound reaches it.  What is
skipped cannot enter the result, whatever the centres are; good centres only skip more.

Cells lie in groups of bounded size, and a query is sent to a group once with the cells it
visits there.  A group of many visitors and a cell of many vectors are cut into blocks; one
task compares a block of each, some thousand rows at a time.
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

from threadlens.sources.tables import materialize

SCORE_DIGITS = 9  # scores are compared at this precision, ties go to the lower id
MARGIN = 1e-8  # scores that differ by less may tie after rounding
ANGLE_SLACK = 1e-7  # rounding of angles
CELL_ROWS, MAX_CELLS = 1_000, 1_024
GROUP_ROWS = 32_768  # vectors or visitors that meet in one task
NO_DIRECTION = -1  # cell of vectors of length zero, which score zero with everything


@dataclass(frozen=True)
class DenseIndex:
    """Vectors (doc_id, vector, cell) as a written table; centres and cells are bounded.

    ``centres`` has one unit row per cell, ``angles`` the widest angle and ``sizes`` the
    number of vectors by cell; ``sizes`` may also have the cell ``NO_DIRECTION``.
    """

    vectors: DataFrame
    centres: np.ndarray
    angles: np.ndarray
    sizes: dict[int, int]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors as rows of unit length; those of length zero stay zero."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def build_dense_index(corpus: DataFrame, cells: int | None = None, seed: int = 42) -> DenseIndex:
    """Index vectors (doc_id, vector); rows without a vector are left out.

    Centres are the vectors with the lowest seeded hashes of their ids, so reruns agree;
    by default one for every ``CELL_ROWS`` vectors, at most ``MAX_CELLS``.
    """
    rows = corpus.filter("vector IS NOT NULL").select("doc_id", "vector")
    if cells is None:
        cells = max(1, min(MAX_CELLS, -(-rows.count() // CELL_ROWS)))
    drawn = rows.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(cells).select("vector").toArrow()
    centres = _matrix(drawn.column(0)) if len(drawn) else np.zeros((0, 0))
    centres = centres[np.abs(centres).sum(axis=1) > 0]
    schema = T.StructType([corpus.schema["doc_id"]])
    schema = schema.add("vector", T.ArrayType(T.DoubleType())).add("cell", "integer").add("cosine", "double")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _matrix(batch.column(1)) if len(batch) else np.zeros((0, 1))
            cell, cosine = np.full(len(own), NO_DIRECTION, np.int32), np.zeros(len(own))
            some = np.flatnonzero(np.abs(own).sum(axis=1)) if len(centres) else np.zeros(0, int)
            if len(some):
                scores = own[some] @ centres.T
                cell[some] = scores.argmax(axis=1)
                cosine[some] = scores.max(axis=1)
            arrays = [batch.column(0), _lists(own), pa.array(cell), pa.array(cosine)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    vectors = materialize(rows.mapInArrow(deal, schema), "dense-cells")
    stats = vectors.groupBy("cell").agg(F.count("*").alias("n"), F.min("cosine").alias("cosine")).collect()
    sizes = {r["cell"]: r["n"] for r in stats}
    if NO_DIRECTION in sizes and not len(centres):
        return DenseIndex(vectors, centres, np.zeros(0), sizes)
    widest = {r["cell"]: np.arccos(np.clip(r["cosine"], -1, 1)) for r in stats}
    angles = np.array([widest.get(c, 0.0) for c in range(len(centres))])
    return DenseIndex(vectors, centres, angles + ANGLE_SLACK, sizes)


def _planned(queries: DataFrame, index: DenseIndex, k: int) -> DataFrame:
    """(query_id, vector, visits): every cell that has vectors with its bound and whether it is
    among the first to visit."""
    cells = np.array(sorted(index.sizes), dtype=np.int32)
    sizes = np.array([index.sizes[c] for c in cells], dtype=np.int64)
    real = cells != NO_DIRECTION
    centres, angles = index.centres, index.angles
    schema = T.StructType([queries.schema["query_id"]]).add("vector", T.ArrayType(T.DoubleType()))
    for name, kind in (("cells", T.IntegerType()), ("bounds", T.DoubleType()), ("firsts", T.BooleanType())):
        schema = schema.add(name, T.ArrayType(kind))

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _matrix(batch.column(1)) if len(batch) else np.zeros((0, 1))
            bounds = np.zeros((len(own), len(cells)))
            if real.any() and len(own):
                apart = np.arccos(np.clip(own @ centres[cells[real]].T, -1, 1)) - angles[cells[real]]
                bounds[:, real] = np.cos(np.maximum(apart, 0))
                bounds[np.abs(own).sum(axis=1) == 0] = 0
            order = np.argsort(-bounds, axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            first = np.zeros_like(bounds, bool)
            np.put_along_axis(first, order, held - sizes[order] < k, axis=1)
            arrays = [batch.column(0), _lists(own), _lists(np.tile(cells, (len(own), 1))), _lists(bounds), _lists(first)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return queries.filter("vector IS NOT NULL").select("query_id", "vector").mapInArrow(plan, schema)


def _grouped(index: DenseIndex, group_rows: int) -> tuple[dict[int, int], list[int]]:
    """Neighbouring cells in groups of about ``group_rows`` vectors: the group of every cell, and
    into how many blocks of documents each group is cut, which only a larger cell needs."""
    group, sizes = {}, []
    for cell in sorted(index.sizes):
        if not sizes or sizes[-1] + index.sizes[cell] > group_rows:
            sizes.append(0)
        group[cell] = len(sizes) - 1
        sizes[-1] += index.sizes[cell]
    return group, [-(-n // group_rows) for n in sizes]


def _first_k(rows: np.ndarray, scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Where the k best of each row are, by score and then place."""
    order = np.lexsort((places, -scores, rows))
    own = rows[order]
    nth = np.arange(len(own)) - np.searchsorted(own, own, "left")
    return order[nth < k]


def _best_pairs(
    asked: np.ndarray, held: np.ndarray, wanted: np.ndarray, cell: np.ndarray, k: int, block_rows: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and vectors, and scores, of each query's k best vectors of wanted cells.

    ``wanted`` has a row per query and a column per cell, ``cell`` a vector's column; vectors
    are in the order of ids.  Single precision tells what can be among the k best, and the
    score of that is computed in double.
    """
    slack = MARGIN + 4 * asked.shape[1] * float(np.finfo(np.float32).eps)
    by_cell = np.argsort(cell, kind="stable")
    out = []
    for start in range(0, len(asked), block_rows):
        own = asked[start : start + block_rows]
        visits, single = wanted[start : start + block_rows], own.astype(np.float32)
        floor = np.full(len(own), -np.inf)
        rows, docs, best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(held), block_rows):
            some = by_cell[at : at + block_rows]
            seen = visits[:, cell[some]]
            who = np.flatnonzero(seen.any(axis=1))
            if not len(who):
                continue
            scores = single[who] @ held[some].astype(np.float32).T
            scores[~seen[who]] = -np.inf
            limit = floor[who]
            new = np.flatnonzero(np.isneginf(limit))
            if len(new) and len(some) > k:
                limit[new] = np.partition(scores[new], -k, axis=1)[:, -k] - slack
            r, c = np.nonzero((scores >= (limit - slack)[:, None]) & np.isfinite(scores))
            r = who[r]
            exact = np.round(np.einsum("ij,ij->i", own[r], held[some[c]]), SCORE_DIGITS)
            rows, docs, best = np.concatenate([rows, r]), np.concatenate([docs, some[c]]), np.concatenate([best, exact])
            keep = _first_k(rows, best, docs, k)
            rows, docs, best = rows[keep], docs[keep], best[keep]
            ends = np.searchsorted(rows, np.arange(len(own)), "right")
            full = np.flatnonzero(np.bincount(rows, minlength=len(own)) == k)
            floor[full] = best[ends[full] - 1]
        out.append((rows + start, docs, best))
    return tuple(np.concatenate(x) for x in zip(*out))


def _best_of_visits(visits: DataFrame, index: DenseIndex, k: int, block_rows: int) -> DataFrame:
    """The k best (query_id, doc_id, score) of every block that the visits (query_id, vector, cells) meet.

    A query travels once for all cells of a group that it visits, and a vector once for every
    block of visitors of its group.
    """
    spark = visits.sparkSession
    side = max(1, int((4 * spark.sparkContext.defaultParallelism) ** 0.5))
    group_rows = min(GROUP_ROWS, max(block_rows, -(-sum(index.sizes.values()) // side)))
    group, doc_blocks = _grouped(index, group_rows)
    known = sorted(group)
    numbers = np.array([group[c] for c in known])
    query = visits.schema["query_id"]
    fields = T.StructType([query]).add("vector", T.ArrayType(T.DoubleType()))
    fields = fields.add("grp", "integer").add("cells", T.ArrayType(T.IntegerType()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(2)
            flat = cells.flatten().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(batch)), pa.compute.list_value_length(cells).to_numpy())
            own = numbers[np.searchsorted(known, flat)] if len(flat) else flat
            order = np.lexsort((own, rows))
            rows, own, flat = rows[order], own[order], flat[order]
            heads = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (own[1:] != own[:-1])][: len(rows)])
            ends = np.append(heads, len(rows)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))
            taken = pa.array(rows[heads])
            arrays = [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(own[heads].astype(np.int32)), lists]
            yield pa.RecordBatch.from_arrays(arrays, names=fields.names)

    asked = visits.select("query_id", "vector", "cells").mapInArrow(deal, fields)
    counts = {r["grp"]: r["count"] for r in asked.groupBy("grp").count().collect()}
    # one row per cell, so at most MAX_CELLS + 1
    plan = [(c, g, doc_blocks[g], -(-counts[g] // group_rows)) for c, g in group.items() if g in counts]
    table = spark.createDataFrame(plan, "cell int, grp int, doc_blocks int, query_blocks int")
    groups = F.broadcast(table.drop("cell").distinct())

    def own_block(column: str, n: str) -> Column:
        return F.pmod(F.xxhash64(column), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    asked = asked.join(groups, "grp").withColumn("query_block", own_block("query_id", "query_blocks"))
    asked = asked.withColumn("doc_block", every("doc_blocks"))
    held = index.vectors.join(F.broadcast(table), "cell").withColumn("doc_block", own_block("doc_id", "doc_blocks"))
    held = held.withColumn("query_block", every("query_blocks"))
    schema = T.StructType([query, index.vectors.schema["doc_id"]]).add("score", "double")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            none = [left.column("query_id").slice(0, 0), right.column("doc_id").slice(0, 0), pa.array([], pa.float64())]
            return pa.table(none, names=schema.names)
        ids = right.column("doc_id").combine_chunks()
        by_id = pa.compute.sort_indices(ids)
        own, cell = np.unique(right.column("cell").to_numpy()[by_id.to_numpy()], return_inverse=True)
        lists = left.column("cells").combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(left)), pa.compute.list_value_length(lists).to_numpy())
        here = np.isin(flat, own)
        wanted = np.zeros((len(left), len(own)), bool)
        wanted[rows[here], np.searchsorted(own, flat[here])] = True
        vectors = _matrix(right.column("vector"))[by_id.to_numpy()]
        queries, docs, scores = _best_pairs(_matrix(left.column("vector")), vectors, wanted, cell, k, block_rows)
        return pa.table(
            {
                "query_id": left.column("query_id").combine_chunks().take(pa.array(queries)),
                "doc_id": ids.take(by_id).take(pa.array(docs)),
                "score": pa.array(scores),
            }
        )

    keys = ["grp", "query_block", "doc_block"]
    asked = asked.select(*keys, "query_id", "vector", "cells").groupBy(*keys)
    held = held.select(*keys, "doc_id", "vector", "cell").groupBy(*keys)
    return asked.cogroup(held).applyInArrow(best, schema)


@dataclass(frozen=True)
class DenseResult:
    """``top`` (query_id, doc_id, score, rank); ``visits`` (query_id, n_cells, n_visited)."""

    top: DataFrame
    visits: DataFrame


def search_dense(queries: DataFrame, index: DenseIndex, k: int, block_rows: int) -> DenseResult:
    """Cosine top-k of queries (query_id, vector), equal to comparing with every vector.

    Scores are compared at nine digits, equal ones go to the lower id.  A vector of length
    zero scores zero with everything; queries without a vector return nothing.
    """
    planned = materialize(_planned(queries, index, k), "dense-plans")
    entries = F.arrays_zip("cells", "bounds", "firsts")
    chosen = lambda test: F.transform(F.filter(entries, test), lambda v: v["cells"]).alias("cells")
    first = planned.select("query_id", "vector", chosen(lambda v: v["firsts"]))
    found = materialize(_best_of_visits(first, index, k, block_rows), "dense-first")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    floors = ranked.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
    least = F.coalesce("floor", F.lit(-2.0)) - MARGIN
    rest = planned.join(floors, "query_id", "left").withColumn("least", least)
    rest = rest.select("query_id", "vector", chosen(lambda v: ~v["firsts"] & (v["bounds"] >= F.col("least"))))
    rest = materialize(rest.filter(F.size("cells") > 0), "dense-rest")
    more = _best_of_visits(rest, index, k, block_rows)
    top = found.unionByName(more).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    later = rest.groupBy("query_id").agg(F.sum(F.size("cells")).alias("later"))
    firsts = F.size(F.filter("firsts", lambda x: x))
    visits = planned.join(later, "query_id", "left").select(
        "query_id", F.size("cells").alias("n_cells"), (firsts + F.coalesce("later", F.lit(0))).cast("int").alias("n_visited")
    )
    return DenseResult(top, visits)


def dense_topk(queries: DataFrame, corpus: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Cosine top-k for tables (query_id, vector) and (doc_id, vector)."""
    return search_dense(queries, build_dense_index(corpus), k, block_rows).top
