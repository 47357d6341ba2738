"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a seeded random order, repeated up to
``epochs`` times.  A document's virtual finish time is the number of words its source has
sent, this document included, divided by the source's target.  Sorted by finish time over
all sources the documents interleave in the proportions of the targets; the sorted list
ends where the total budget is used up.

No source passes through one task: running sums are made inside ``SLICES`` equal slices
of a source's random order and offset by the sums of the slices before.  The end of the
list is found from a histogram of finish times; rows are looked at one by one only in the
histogram bin in which it lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.llm.common import text_of, word_count
from threadlens.sources.tables import materialize

#: Slices of a source's random order: values of three hexadecimal digits.
SLICE_DIGITS = 3
#: Histogram bins per unit of finish time, and the last bin, which takes all later times.
BINS, LAST_BIN = 4096, 1 << 17


def shuffle_key(seed: int) -> Column:
    """Random but repeatable order of documents, from the id or, without one, the text."""
    identity = F.coalesce(F.col("doc_id").cast("string"), F.md5(text_of()))
    return F.md5(F.concat(F.lit(f"{seed}|"), identity))


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, epochs: int
) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn.  The budget is
    ``share`` of all sizes.  A target is weight x level, at most epochs x source_size,
    where the level spends the budget: it is the largest of the levels that result when
    the k sources that fill up first are full, over all k.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") % len(weights) + 1
    )
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", weight)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    return (
        ranked.withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source",
            "rank",
            "source_size",
            F.least("cap", F.col("weight") * F.col("level")).alias("target"),
        )
    )


def _finish(epoch: Column | int) -> Column:
    sent = F.col("cum") + F.col("source_size") * epoch
    return F.when(F.col("target") > 0, sent / F.col("target")).otherwise(F.lit(0.0))


def _place(epoch: int) -> Column:
    """Position of a copy in the merged list."""
    return F.struct(
        _finish(epoch).alias("finish"),
        F.col("rank").alias("rank"),
        F.lit(epoch).alias("epoch"),
        F.col("skey").alias("skey"),
    )


def mix_decisions(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    epochs: int = 2,
    seed: int = 42,
) -> DataFrame:
    """(doc_id, source, skey, size, source_size, target, cum, rank, copies), a row per document.

    ``copies`` is how often the mix takes the document, 0 to ``epochs``.  The size of a
    document is its number of words, 0 for a null text.  Rows that share their id (or,
    without an id, their text) and source are taken together.  An empty table gives none.
    """
    base = materialize(
        docs.select(
            "doc_id",
            F.col("source").alias("source"),
            shuffle_key(seed).alias("skey"),
            word_count(text_of()).alias("size"),
        ).withColumn("slice", F.substring("skey", 1, SLICE_DIGITS)),
        "mix-sizes",
    )
    slices = base.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    slices = materialize(slices, "mix-slices")
    targets = source_targets(
        slices.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, epochs
    )
    targets = materialize(targets, "mix-targets")
    earlier = Window.partitionBy("source").orderBy("slice")
    offsets = slices.select(
        F.col("source").alias("_source"),
        F.col("slice").alias("_slice"),
        (F.sum("n").over(earlier) - F.col("n")).alias("offset"),
    )
    offsets = offsets.join(
        targets, offsets["_source"].eqNullSafe(targets["source"])
    ).drop("source")
    # rows that tie get the same running sum: the frame of an ordered window ends with them
    inside = Window.partitionBy("source", "slice").orderBy("skey")
    summed = base.withColumn("inside", F.sum("size").over(inside))
    placed = materialize(
        summed.join(
            offsets,
            summed["source"].eqNullSafe(offsets["_source"])
            & (summed["slice"] == offsets["_slice"]),
        )
        .withColumn("cum", F.col("offset") + F.col("inside"))
        .drop("_source", "_slice", "slice", "offset", "inside"),
        "mix-placed",
    )
    last = _last_place(placed, targets, share, epochs)
    if last is None:
        return placed.withColumn("copies", F.lit(0))
    end = F.struct(
        F.lit(last["finish"]).alias("finish"),
        F.lit(last["rank"]).alias("rank"),
        F.lit(last["epoch"]).alias("epoch"),
        F.lit(last["skey"]).alias("skey"),
    )
    taken = [F.when(_place(e) <= end, 1).otherwise(0) for e in range(epochs)]
    return placed.withColumn("copies", sum(taken[1:], taken[0]))


def _last_place(placed: DataFrame, targets: DataFrame, share: float, epochs: int):
    """The place of the last copy within the budget; None when nothing fits."""
    total = targets.agg(F.sum("source_size")).first()[0]
    if not total:
        return None
    limit = total * min(share, epochs)
    copies = placed.select(
        "size", F.explode(F.array(*[_place(e) for e in range(epochs)])).alias("place")
    ).withColumn(
        "bin", F.least(F.floor(F.col("place.finish") * BINS), F.lit(LAST_BIN)).cast("bigint")
    )
    running = Window.orderBy("bin")
    bins = (
        copies.groupBy("bin")
        .agg(F.sum("size").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
    )
    edge = bins.filter(F.col("upto") > limit).agg(F.min(F.struct("bin", "upto", "n"))).first()[0]
    if edge is None:
        return copies.agg(F.max("place")).first()[0]
    rest = limit - (edge["upto"] - edge["n"])
    inside = copies.filter(F.col("bin") == edge["bin"]).withColumn(
        "upto", F.sum("size").over(Window.orderBy("place"))
    )
    found = inside.filter(F.col("upto") <= rest).agg(F.max("place")).first()[0]
    return found or copies.filter(F.col("bin") < edge["bin"]).agg(F.max("place")).first()[0]


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that the mix takes, repeated as taken, in merged order."""
    names = docs.columns
    seed = settings.get("seed", 42)
    decided = mix_decisions(docs, **settings).filter("copies > 0")
    # tied rows have the same decision, so one row of each key is enough
    decided = decided.groupBy("skey", "source", "size").agg(
        F.max("copies").alias("copies"),
        F.max("cum").alias("cum"),
        F.max("source_size").alias("source_size"),
        F.max("target").alias("target"),
        F.max("rank").alias("rank"),
    )
    rows = docs.select(
        F.struct(*[docs[c] for c in names]).alias("_row"),
        F.col("source").alias("_source"),
        shuffle_key(seed).alias("_skey"),
        word_count(text_of()).alias("_size"),
    )
    met = rows.join(
        decided,
        (rows["_skey"] == decided["skey"])
        & (rows["_size"] == decided["size"])
        & rows["_source"].eqNullSafe(decided["source"]),
    )
    copies = met.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    ordered = copies.withColumn("_finish", _finish(F.col("epoch")))
    return (
        ordered.repartitionByRange("_finish", "rank", "skey")
        .sortWithinPartitions("_finish", "rank", "skey")
        .select("_row.*")
    )
