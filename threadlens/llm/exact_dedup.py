"""Exact duplicates: two passes over a Bloom filter, then a shuffle of the suspects alone.

Pass one counts how often every cell of the filter is hit and keeps a bitmap of the cells
hit twice or more.  Pass two looks every text up in that bitmap (a broadcast of at most
``max_bits`` / 8 bytes): a text whose cells are not all set has no copy and stays where it
is.  Only the others, all copies and a few false alarms, are grouped by their digest, so
false alarms cost time and never change the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import BLANK, bitmaps, filter_bits, text_of, with_bit
from threadlens.sources.tables import materialize

HASHES = 2


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of a text with every run of blanks as one space."""
    return F.sha2(F.regexp_replace(text, BLANK + "+", " "), 256)


def _cell(digest: Column, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(bits)) + 1


def repeated_cells(digests: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap) of the filter cells that more than one ``digest`` row hits."""
    cells = digests.select(
        F.explode(F.array(*[_cell(F.col("digest"), i, bits) for i in range(HASHES)])).alias("cell")
    )
    return bitmaps(cells.groupBy("cell").count().filter("count > 1"))


def with_suspicion(rows: DataFrame, cells: DataFrame, bits: int) -> DataFrame:
    """Add ``suspect``: whether all filter cells of the row's ``digest`` are set."""
    flags = [f"_f{i}" for i in range(HASHES)]
    for i, flag in enumerate(flags):
        rows = with_bit(rows, _cell(F.col("digest"), i, bits), cells, flag)
    return rows.withColumn("suspect", reduce(Column.__and__, map(F.col, flags))).drop(*flags)


def exact_groups(
    docs: DataFrame, bits_per_row: int = 16, max_bits: int = 1 << 28
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of (doc_id, text).

    Texts are equal when they are identical after every run of blanks has become one
    space; null counts as empty.  Of equal texts the row with the smallest doc_id stays
    (null after all numbers); of rows that also share the doc_id one stays.  Rows that
    repeat come back as often as they are there.  Other columns are not read.
    """
    digests = materialize(
        docs.select("doc_id", text_digest(text_of()).alias("digest")), "exact-digests"
    )
    bits = filter_bits(digests.count(), bits_per_row, max_bits)
    cells = materialize(repeated_cells(digests, bits), "exact-cells")
    flagged = with_suspicion(digests, cells, bits)
    alone = flagged.filter("not suspect").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    # rows with the same id and text are interchangeable: count them and list them again
    rows = flagged.filter("suspect").groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
    rows = materialize(rows, "exact-suspects")
    groups = rows.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size")
    )
    met = (
        rows.join(groups, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )
    return alone.unionByName(met)


def drop_exact_duplicates(
    docs: DataFrame, bits_per_row: int = 16, max_bits: int = 1 << 28
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows without a suspected copy pass straight through; suspects move once.  Rows that
    share text and doc_id but differ elsewhere leave one of them, any.
    """
    names = docs.columns
    rows = docs.select(
        F.struct(*[docs[c] for c in names]).alias("_row"),
        F.col("doc_id").alias("_id"),
        text_digest(text_of()).alias("digest"),
    )
    digests = materialize(rows.select("_id", "digest"), "exact-digests")
    bits = filter_bits(digests.count(), bits_per_row, max_bits)
    cells = materialize(repeated_cells(digests, bits), "exact-cells")
    keepers = (
        with_suspicion(digests, cells, bits)
        .filter("suspect")
        .groupBy("digest")
        .agg(F.min("_id").alias("_keep"))
        .withColumnRenamed("digest", "_d")
    )
    flagged = with_suspicion(rows, cells, bits)
    suspects = flagged.filter("suspect")
    # the id is part of the key, so the copies of one text do not meet in one task
    met = suspects.join(
        keepers,
        (suspects["digest"] == keepers["_d"]) & suspects["_id"].eqNullSafe(keepers["_keep"]),
        "left_semi",
    ).dropDuplicates(["digest"])
    return flagged.filter("not suspect").select("_row.*").unionByName(met.select("_row.*"))
