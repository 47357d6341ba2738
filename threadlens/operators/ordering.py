"""Order within groups, and joins on group keys, for groups of any size.

A conversation (or any other group) may hold a large share of all rows.  A
window over it would put all those rows into one task.  The functions here
take a look-up of the groups that exceed a number of rows.  Groups below the
bound use ordinary windows.  Hot groups are ranked by a range-partitioned sort
instead, in which one group spreads over as many tasks as it needs.  There are at
most total rows / bound hot groups, which limits what is broadcast.

The look-up is best made once, on the narrowest table that holds all rows: groups
only shrink when rows are filtered, so it stays valid for everything downstream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.sources.tables import materialize


def nulls_last(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


@dataclass(frozen=True)
class HotGroups:
    """Keys with more than ``bound`` rows and their sizes; None when there are none."""

    table: DataFrame | None
    bound: int


def find_hot_groups(df: DataFrame, key: str, bound: int) -> HotGroups:
    """Look up the oversized groups; reads only the key column of ``df``."""
    sizes = df.groupBy(key).agg(F.count("*").alias("_rows"))
    hot = sizes.filter(F.col(key).isNotNull() & (F.col("_rows") > bound))
    return HotGroups(materialize(hot, "hot-groups") if hot.take(1) else None, bound)


def numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Add the 0-based position of every row in the given total order.

    Range partitioning sorts in parallel; a row's position is its index inside
    its partition plus the number of rows in earlier partitions.  Only one size
    per partition reaches the driver.
    """
    ranged = (
        df.repartitionByRange(*nulls_last(order))
        .sortWithinPartitions(*nulls_last(order))
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    # the position column must be computed exactly once
    ranged = materialize(ranged, "numbered").withColumn("_part", F.shiftright("_pos", 33))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("n")).collect()
    offsets, seen = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], seen))
        seen += row["n"]
    offset_table = df.sparkSession.createDataFrame(offsets, "_part bigint, _offset bigint")
    index = F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.join(F.broadcast(offset_table), "_part")
        .withColumn(out, F.col("_offset") + index)
        .drop("_part", "_pos", "_offset")
    )


def _split(df: DataFrame, key: str, hot: HotGroups) -> tuple[DataFrame, DataFrame]:
    keys = F.broadcast(hot.table.select(key))
    bounded, large = df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")
    return bounded.select(*df.columns), large.select(*df.columns)


def with_sequence(
    df: DataFrame, key: str, order: Sequence[str], hot: HotGroups, out: str = "seq"
) -> DataFrame:
    """Add the 1-based position of every row inside its group."""
    window = Window.partitionBy(key).orderBy(*nulls_last(order))
    if hot.table is None:
        return df.withColumn(out, F.row_number().over(window).cast("bigint"))
    bounded, large = _split(df, key, hot)
    bounded = bounded.withColumn(out, F.row_number().over(window).cast("bigint"))
    large = numbered(large, [key, *order], "_g")
    starts = large.groupBy(key).agg(F.min("_g").alias("_start"))
    large = (
        large.join(F.broadcast(starts), key)
        .withColumn(out, F.col("_g") - F.col("_start") + 1)
        .drop("_g", "_start")
    )
    return bounded.unionByName(large)


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    column: str,
    hot: HotGroups,
    lags: int = 1,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add ``column`` of the preceding rows of the same group as prev1, prev2, ...

    With ``within``, only rows that also agree in these columns are looked at.
    """
    names = [f"prev{i}" for i in range(1, lags + 1)]
    if not names:
        return df
    window = Window.partitionBy(key, *within).orderBy(*nulls_last(order))
    windowed = {n: F.lag(column, i + 1).over(window) for i, n in enumerate(names)}
    if hot.table is None:
        return df.withColumns(windowed)
    bounded, large = _split(df, key, hot)
    large = materialize(numbered(large, [key, *within, *order], "_g"), "hot-ordered")
    group = F.struct(key, *within)
    for i, name in enumerate(names, start=1):
        # neighbours meet on the row position, which is unique, so no task
        # receives more than its share whatever the group sizes are
        before = large.select(
            (F.col("_g") + i).alias("_g"), group.alias("_key"), F.col(column).alias(name)
        )
        after = large if i == 1 else joined
        joined = after.join(before, "_g", "left").withColumn(
            name, F.when(F.col("_key") == group, F.col(name))
        ).drop("_key")
    return bounded.withColumns(windowed).unionByName(joined.drop("_g"))


def drop_short_groups(df: DataFrame, key: str, min_rows: int, hot: HotGroups) -> DataFrame:
    """Rows of the groups that have at least ``min_rows`` rows; null keys stay.

    Bounded groups are counted by a window, so the input is computed once and
    leaves partitioned by the key.  Hot groups are counted by aggregation.
    """

    def counted(rows: DataFrame) -> DataFrame:
        size = F.count("*").over(Window.partitionBy(key))
        keep = F.col(key).isNull() | (F.col("_n") >= min_rows)
        return rows.withColumn("_n", size).filter(keep).drop("_n")

    if hot.table is None:
        return counted(df)
    bounded, large = _split(materialize(df, "hot-filter"), key, hot)
    kept = large.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_rows)
    # one row per hot group
    large = large.join(F.broadcast(kept.select(key)), key, "left_semi")
    return counted(bounded).unionByName(large)


def join_groups(
    rows: DataFrame, groups: DataFrame, key: str, row_id: str, hot: HotGroups
) -> DataFrame:
    """Inner join of rows with a table that has one row per key.

    For hot keys the group row is copied once per salt and the rows spread over
    the salts; all other keys have the single salt 0.
    """
    if hot.table is None:
        return rows.join(groups, key)
    return (
        _salted_rows(rows, key, row_id, hot)
        .join(_salted_copies(groups, key, hot), [key, "_salt"])
        .drop("_salt")
    )


def _salted_rows(df: DataFrame, key: str, row_id: str, hot: HotGroups) -> DataFrame:
    salts = F.ceil(F.col("_rows") / F.lit(hot.bound))
    salt = F.pmod(F.xxhash64(row_id), salts).cast("int")
    return (
        df.join(F.broadcast(hot.table), key, "left")
        .withColumn("_salt", F.coalesce(salt, F.lit(0)))
        .drop("_rows")
    )


def _salted_copies(groups: DataFrame, key: str, hot: HotGroups) -> DataFrame:
    salts = F.ceil(F.col("_rows") / F.lit(hot.bound)).cast("int")
    return (
        groups.join(F.broadcast(hot.table), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1)))
        .drop("_rows")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order; null keys are equal.

    The rank filter is applied before the shuffle as well, so one task receives
    at most one row of a key from every map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
