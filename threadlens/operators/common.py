"""Small building blocks shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row table to every row, as a scalar subquery."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_row"))
    return rows.withColumn("_row", packed.scalar()).select(
        *[F.col(c) for c in rows.columns], "_row.*"
    )
