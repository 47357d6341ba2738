"""k-means by seeded mini-batches, with centres and batches as tables.

Rows are sparse (doc_id, indices, values).  A hash of the id deals rows to batches, which one
pass over the rows writes; reruns draw the same.  First centres are rows of the first batch,
each drawn in proportion to its squared distance to those drawn before, for several trials
of which the one with the least total distance goes on.  A round assigns one batch to the
nearest centres and moves every centre to the mean of all rows it has ever been given, so a
centre's learning rate is one over their number.  Every round writes its centres.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.sources.tables import materialize

DIGITS = 12  # distances are compared at this precision, ties go to the lower cluster or id
SHARES = 1 << 52


@dataclass(frozen=True)
class Centres:
    """``values`` (cluster, idx, value) without zeros, ``seen`` rows given to each of ``k`` clusters."""

    values: DataFrame
    seen: dict[int, int]
    k: int


def share(*columns: Column) -> Column:
    """A number above 0 and up to 1 that a hash of the columns decides."""
    return (F.pmod(F.xxhash64(*columns), F.lit(SHARES)) + 1) / SHARES


def entries(rows: DataFrame) -> DataFrame:
    """(doc_id, idx, x) of sparse rows."""
    pair = F.explode(F.arrays_zip("indices", "values")).alias("e")
    return rows.select("doc_id", pair).select("doc_id", F.col("e.indices").alias("idx"), F.col("e.values").alias("x"))


def _squares(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.aggregate("values", F.lit(0.0), lambda a, x: a + x * x).alias("square"))


def distances(rows: DataFrame, centres: Centres) -> DataFrame:
    """(doc_id, cluster, distance): squared distance of every row to every centre."""
    # k x vocabulary numbers at most
    values = F.broadcast(centres.values)
    dots = entries(rows).join(values, "idx").groupBy("doc_id", "cluster").agg(F.sum(F.col("x") * F.col("value")).alias("dot"))
    own = centres.values.groupBy("cluster").agg(F.sum(F.col("value") * F.col("value")).alias("n")).collect()
    square = {r["cluster"]: r["n"] for r in own}
    listed = F.array(
        *[F.struct(F.lit(c).alias("cluster"), F.lit(float(square.get(c, 0.0))).alias("n")) for c in range(centres.k)]
    )
    pairs = _squares(rows).select("doc_id", "square", F.explode(listed).alias("c"))
    pairs = pairs.select("doc_id", "square", "c.cluster", "c.n").join(dots, ["doc_id", "cluster"], "left")
    apart = F.col("square") - 2 * F.coalesce("dot", F.lit(0.0)) + F.col("n")
    return pairs.select("doc_id", "cluster", F.round(F.greatest(apart, F.lit(0.0)), DIGITS).alias("distance"))


def nearest(rows: DataFrame, centres: Centres) -> DataFrame:
    """(doc_id, cluster, distance) of the nearest centre of every row."""
    best = F.min(F.struct("distance", "cluster")).alias("best")
    return distances(rows, centres).groupBy("doc_id").agg(best).select("doc_id", "best.cluster", "best.distance")


def label_means(rows: DataFrame, labels: DataFrame, k: int) -> Centres:
    """The mean rows of given clusters 0 to k - 1: ``labels`` has (doc_id, cluster)."""
    seen = {r["cluster"]: r["count"] for r in labels.groupBy("cluster").count().collect()}
    counts = labels.groupBy("cluster").agg(F.count("*").alias("members"))
    sums = entries(rows).join(labels, "doc_id").groupBy("cluster", "idx").agg(F.sum("x").alias("total"))
    means = sums.join(F.broadcast(counts), "cluster").select("cluster", "idx", (F.col("total") / F.col("members")).alias("value"))
    return Centres(materialize(means, "mean-rows"), seen, k)


def batches(rows: DataFrame, batch_rows: int, rounds: int, seed: int) -> tuple[DataFrame, int]:
    """(slot, doc_id, indices, values) of the rows that the rounds use, and the number of slots."""
    slots = max(1, -(-rows.count() // batch_rows))
    slot = F.least(F.floor(share(F.lit(seed), F.col("doc_id")) * slots), F.lit(slots - 1)).cast("int")
    dealt = rows.select(slot.alias("slot"), "doc_id", "indices", "values").filter(F.col("slot") < rounds)
    return materialize(dealt, "cluster-batches"), slots


def first_centres(batch: DataFrame, k: int, seed: int, trials: int) -> DataFrame:
    """(cluster, doc_id): the rows of a batch that the best trial draws."""
    listed = F.explode(F.array(*[F.lit(t) for t in range(trials)])).alias("trial")
    near = _squares(batch).select("doc_id", "square", listed).withColumn("distance", F.lit(1.0))
    cells, drawn = materialize(entries(batch), "cluster-entries"), []
    for cluster in range(k):
        # the least of these is each row with a chance in proportion to its distance
        race = -F.log(share(F.lit(seed), F.lit(cluster), F.col("trial"), F.col("doc_id"))) / F.col("distance")
        raced = near.withColumn("race", F.when(F.col("distance") > 0, race).otherwise(F.lit(float("inf"))))
        won = raced.groupBy("trial").agg(F.min(F.struct("race", "doc_id", "square")).alias("w"))
        won = materialize(won.select("trial", F.lit(cluster).alias("cluster"), "w.doc_id", F.col("w.square").alias("n")), "cluster-drawn")
        drawn.append(won)
        # one row per trial, its entries are one document's
        centre = won.join(cells, "doc_id").select("trial", "idx", F.col("x").alias("value"))
        dots = cells.join(F.broadcast(centre), "idx").groupBy("trial", "doc_id").agg(F.sum(F.col("x") * F.col("value")).alias("dot"))
        met = near.join(dots, ["trial", "doc_id"], "left").join(F.broadcast(won.select("trial", "n")), "trial")
        apart = F.round(F.greatest(F.col("square") + F.col("n") - 2 * F.coalesce("dot", F.lit(0.0)), F.lit(0.0)), DIGITS)
        least = apart if cluster == 0 else F.least("distance", apart)
        near = materialize(met.select("doc_id", "square", "trial", least.alias("distance")), "cluster-near")
    total = near.groupBy("trial").agg(F.round(F.sum("distance"), 6).alias("total"))
    best = total.orderBy("total", "trial").first()["trial"]
    chosen = drawn[0]
    for more in drawn[1:]:
        chosen = chosen.unionByName(more)
    return chosen.filter(F.col("trial") == best).select("cluster", "doc_id")


def moved(batch: DataFrame, centres: Centres) -> Centres:
    """Centres after one batch: means of all rows that they have been given so far."""
    given = materialize(nearest(batch, centres).select("doc_id", "cluster"), "cluster-given")
    new = {r["cluster"]: r["count"] for r in given.groupBy("cluster").count().collect()}
    seen = {c: centres.seen.get(c, 0) + new.get(c, 0) for c in range(centres.k)}
    sums = entries(batch).join(given, "doc_id").groupBy("cluster", "idx").agg(F.sum("x").alias("added"))
    weights = [(c, float(centres.seen.get(c, 0)), float(new.get(c, 0))) for c in seen]
    table = F.broadcast(batch.sparkSession.createDataFrame(weights, "cluster int, before double, given double"))
    met = centres.values.join(sums, ["cluster", "idx"], "full").join(table, "cluster")
    total = F.coalesce("value", F.lit(0.0)) * F.col("before") + F.coalesce("added", F.lit(0.0))
    # a centre that is given nothing stays where it is
    value = F.when(F.col("given") == 0, F.col("value")).otherwise(total / (F.col("before") + F.col("given")))
    return Centres(materialize(met.select("cluster", "idx", value.alias("value")), "cluster-centres"), seen, centres.k)


def mini_batch_kmeans(
    rows: DataFrame, k: int, seed: int = 42, batch_rows: int = 1_000, rounds: int = 6, trials: int = 3
) -> Centres:
    """Centres of sparse rows (doc_id, indices, values).

    ``batch_rows`` is a mean; if the rounds need more batches than the rows fill, they begin
    with the first again.  Rows without an entry take part as zero rows.  With fewer
    different rows than ``k`` some centres are equal and the higher ones get no rows.
    """
    written = materialize(rows.select("doc_id", "indices", "values"), "cluster-rows")
    dealt, slots = batches(written, batch_rows, rounds, seed)
    by_slot = lambda r: dealt.filter(F.col("slot") == r % slots)
    chosen = first_centres(by_slot(0), k, seed, trials)
    values = chosen.join(entries(by_slot(0)), "doc_id").select("cluster", "idx", F.col("x").alias("value"))
    centres = Centres(materialize(values, "cluster-centres"), {}, k)
    for r in range(rounds):
        centres = moved(by_slot(r), centres)
    return centres
