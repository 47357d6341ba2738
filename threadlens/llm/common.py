"""Pieces shared by the document operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.sources.tables import materialize

#: Characters between words: space and the five ASCII controls 9 to 13.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text, none for an empty one."""
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words: starts of words, counted without building them."""
    return F.regexp_count(text, F.lit(WORD + "+")).cast("bigint")


def bitmaps(cells: DataFrame) -> DataFrame:
    """(bucket, bitmap) of the numbers ``cell``, from 1 on; a bitmap has 32 768 bits."""
    return cells.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bitmap")
    )


def filter_bits(rows: int, bits_per_row: int, max_bits: int) -> int:
    """Size of a filter: a power of two near rows x bits_per_row, at most ``max_bits``."""
    wanted = 1 << max(16, math.ceil(math.log2(max(1, rows * bits_per_row))))
    return min(wanted, max_bits)


def with_bit(rows: DataFrame, cell: Column, table: DataFrame, name: str) -> DataFrame:
    """Add whether the bit ``cell`` is set in a table of ``bitmaps``.

    The bitmaps are broadcast, an eighth of a byte per cell of the filter at most, so the
    size of the filter bounds them and no row moves.
    """
    own = table.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))
    met = rows.join(
        F.broadcast(own), F.bitmap_bucket_number(cell) == F.col("_bucket"), "left"
    )
    at = F.bitmap_bit_position(cell)
    octet = F.substring(F.col("_bitmap"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(octet), 16, 10).cast("bigint")
    bit = F.floor(value / F.pow(F.lit(2.0), at % 8)) % 2 == 1
    return met.withColumn(name, F.coalesce(bit, F.lit(False))).drop("_bucket", "_bitmap")


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reachable.

    Alternating large-star and small-star steps.  Each step is a minimum per node
    (combined before the shuffle) and one join, so no task holds a component; a hot
    node is a skewed join key, which adaptive execution splits.  Every round is
    written to the shared folder, which cuts the lineage and survives lost executors.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        name,
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (
            small.filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        new = materialize(small, name)
        if _same_rows(edges, new):
            break
        edges = new
    # a stable set of edges is a set of stars around the smallest nodes
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two sets of edges agree, by their number and two sums of hashes."""

    def digest(df: DataFrame) -> tuple:
        return tuple(
            df.agg(
                F.count("*"),
                F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                F.sum(F.hash("u", "v").cast("bigint")),
            ).first()
        )

    return digest(a) == digest(b)
