"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint of 64 bits is cut into ``blocks`` blocks.  Two fingerprints that differ in
at most ``distance`` bits agree in at least ``blocks - distance`` whole blocks, so every
close pair shares a bucket for some choice of that many blocks.  Buckets are formed over
*different* fingerprints only: copies of a text meet in a pre-aggregated row.

Within a bucket no list of all pairs is made.  A search that removes what it has reached
returns the links of a spanning forest, which connects the same fingerprints.  A bucket of
more than ``bucket_rows`` fingerprints never meets in one task: its fingerprints are linked
through midpoints instead (``_midpoint_links``), exactly and with bounded groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.llm.common import bitmaps, connected_components, filter_bits, with_bit
from threadlens.sources.tables import materialize

SEED = 42
SHINGLE_CHUNK = 1 << 16
#: Group sizes up to this are compared at once for a whole batch.
SMALL_GROUP = 12


def simhash(data: bytes, shingle_words: int) -> int:
    """Signed 64-bit fingerprint of UTF-8 bytes; 0 without words."""
    words = data.lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    width = min(shingle_words, len(words))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    stops = ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLE_CHUNK):
        part = slice(at, at + SHINGLE_CHUNK)
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[part], stops[part])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, fp) per document; a null text counts as empty."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    schema = docs.select("doc_id").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = [simhash(t.as_py(), shingle_words) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"]
            )

    return rows.mapInArrow(run, schema)


def block_masks(blocks: int, distance: int) -> list[int]:
    """Signed masks, one per choice of blocks that must agree."""
    if not distance < blocks <= 64:
        raise ValueError("distance < blocks <= 64 is needed")
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    block = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    masks = [reduce(lambda a, b: a | b, c) for c in combinations(block, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # of signed numbers numpy would count the bits of the absolute value
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is connected at the distance among different fingerprints."""
    links, rest = [], fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            near = _differing(rest, one) <= distance
            if near.any():
                reached = rest[near]
                links.extend((int(one), int(x)) for x in reached)
                queue.extend(reached)
                rest = rest[~near]
    return links


def _bucket_links(masks: int, distance: int, bucket_rows: int):
    """mapInArrow function over rows sorted by (mask, key): links, and rows of hot buckets."""

    def links_of(ids, keys, fps):
        new = np.flatnonzero((ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])) + 1
        starts = np.concatenate([[0], new])
        sizes = np.diff(np.concatenate([starts, [len(fps)]]))
        group = np.repeat(np.arange(len(sizes)), sizes)
        out_a, out_b = [], []
        small = sizes[group] <= SMALL_GROUP
        f, g = fps[small], group[small]
        for lag in range(1, SMALL_GROUP):
            if lag >= len(f):
                break
            near = (g[lag:] == g[:-lag]) & (_differing(f[lag:], f[:-lag]) <= distance)
            out_a.append(f[:-lag][near])
            out_b.append(f[lag:][near])
        for s, n in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP]):
            found = np.array(_forest(fps[s : s + n], distance), np.int64).reshape(-1, 2)
            out_a.append(found[:, 0])
            out_b.append(found[:, 1])
        return np.concatenate([np.empty(0, np.int64), *out_a]), np.concatenate(
            [np.empty(0, np.int64), *out_b]
        )

    def rows(hot, mask, a, b):
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, hot)), pa.array(mask), pa.array(a), pa.array(b)],
            names=["hot", "mask", "a", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)]
        hot = None  # the key whose bound has been passed; its rows are handed on

        def cut(final: bool):
            """Hand over complete groups; the last one may go on in the next batch."""
            nonlocal carry, hot
            ids, keys, fps = carry
            if not len(ids):
                return
            if hot is not None:
                own = (ids == hot[0]) & (keys == hot[1])
                if own.any():
                    yield rows(True, ids[own], fps[own], keys[own])
                    ids, keys, fps = ids[~own], keys[~own], fps[~own]
                if len(ids):
                    hot = None
            if len(ids):
                last = (ids == ids[-1]) & (keys == keys[-1])
                if not final and last.sum() > bucket_rows:
                    hot = (ids[-1], keys[-1])
                    yield rows(True, ids[last], fps[last], keys[last])
                    ids, keys, fps = ids[~last], keys[~last], fps[~last]
                    last = np.zeros(len(ids), bool)
                done = np.ones(len(ids), bool) if final else ~last
                a, k, f = ids[done], keys[done], fps[done]
                if len(a):
                    change = np.flatnonzero((a[1:] != a[:-1]) | (k[1:] != k[:-1])) + 1
                    sizes = np.diff(np.concatenate([[0], change, [len(a)]]))
                    over = np.repeat(sizes > bucket_rows, sizes)
                    if over.any():
                        yield rows(True, a[over], f[over], k[over])
                        a, k, f = a[~over], k[~over], f[~over]
                if len(a):
                    left, right = links_of(a, k, f)
                    if len(left):
                        yield rows(False, np.zeros(len(left), np.int32), left, right)
                ids, keys, fps = ids[~done], keys[~done], fps[~done]
            carry = [ids, keys, fps]

        for batch in batches:
            fresh = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            carry = [np.concatenate(x) for x in zip(carry, fresh)]
            yield from cut(False)
        yield from cut(True)

    return run


def _midpoint_links(rows: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """Links of hot buckets (mask, fp, key) without a group that grows with the bucket.

    Two fingerprints at most ``distance`` bits apart have a common neighbour within
    ceil(distance / 2) flipped bits of each.  Every fingerprint is listed under all its
    neighbours outside the agreed blocks; those under one neighbour are few (at most the
    number of ways to flip the bits) and, for an even distance, all linked by definition.
    """
    half = -(-distance // 2)
    flips = [0] + [
        reduce(lambda a, b: a | b, (1 << i for i in bits))
        for n in range(1, half + 1)
        for bits in combinations(range(64), n)
    ]
    signed = [f - (1 << 64) if f >> 63 else f for f in flips]
    spark = rows.sparkSession
    table = spark.createDataFrame(
        [(i, f) for i, m in enumerate(masks) for f in signed if not f & m], "mask int, flip bigint"
    )
    near = rows.join(F.broadcast(table), "mask").select(
        "mask", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle")
    )
    group = Window.partitionBy("mask", "key", "middle")
    if distance % 2 == 0:
        pairs = near.withColumn("b", F.min("fp").over(group)).select(F.col("fp").alias("a"), "b")
    else:
        listed = near.withColumn("all", F.collect_list("fp").over(group))
        pairs = listed.select(F.col("fp").alias("a"), F.explode("all").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return pairs.filter((F.col("a") != F.col("b")) & close).distinct()


def close_links(
    fps: DataFrame, distance: int, blocks: int, bucket_rows: int
) -> DataFrame:
    """Links (a, b) between different fingerprints ``fp``; connect exactly the close ones."""
    masks = block_masks(blocks, distance)
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(masks)
        ]
    )
    bucketed = (
        fps.select("fp", F.explode(entries).alias("e"))
        .select("e.mask", "e.key", "fp")
        .repartition("mask", "key")
        .sortWithinPartitions("mask", "key", "fp")
    )
    run = _bucket_links(len(masks), distance, bucket_rows)
    found = materialize(
        bucketed.mapInArrow(run, "hot boolean, mask int, a bigint, b bigint"), "simhash-links"
    )
    links = found.filter("not hot").select("a", "b").distinct()
    hot = found.filter("hot").select("mask", F.col("b").alias("key"), F.col("a").alias("fp"))
    if hot.take(1):
        links = links.unionByName(_midpoint_links(hot, masks, distance))
    return links


def simhash_groups(
    docs: DataFrame,
    shingle_words: int = 4,
    distance: int = 4,
    blocks: int = 6,
    bucket_rows: int = 100_000,
) -> DataFrame:
    """(doc_id, fingerprint, component_id, fp) of every row of ``docs`` (doc_id, text).

    Documents whose fingerprints differ in at most ``distance`` bits are linked; a
    component is named by its smallest doc_id.  Null texts are empty texts; texts without
    a word have fingerprint zero and are linked like others; rows that repeat come back
    as often as they are there; rows without a doc_id take part, and a component of such
    rows alone has a null name.  Other columns of ``docs`` are not read.  More ``blocks``
    give finer buckets (for more documents) and more rows per fingerprint.
    """
    base = materialize(fingerprints(docs, shingle_words), "simhash")
    # one row per fingerprint, whatever the number of copies
    fps = materialize(base.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    roots = connected_components(close_links(fps, distance, blocks, bucket_rows), "simhash-cc")
    named = materialize(
        fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")
        ),
        "simhash-roots",
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = materialize(named.join(smallest, "root").select("fp", "component_id"), "simhash-classes")
    return base.join(classes, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "fp",
    )


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component.

    Of rows that repeat a doc_id all stay or all go; rows without a doc_id stay.
    """
    groups = simhash_groups(docs, **settings)
    gone = groups.filter("doc_id > component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return without_ids(docs, materialize(gone, "simhash-gone"))


def without_ids(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in the written table ``gone`` (_gone)."""
    bits = filter_bits(gone.count(), 16, 1 << 27)
    cell = lambda c: F.xxhash64(c).bitwiseAND(F.lit(bits - 1)) + 1
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id")
    )
    # documents that a filter of bounded size does not suspect stay where they are
    flagged = with_bit(rows, cell("_id"), bitmaps(gone.select(cell("_gone").alias("cell"))), "_some")
    left = flagged.filter("_some").join(gone, F.col("_id") == F.col("_gone"), "left_anti")
    return flagged.filter("not _some").unionByName(left).select("_row.*")
