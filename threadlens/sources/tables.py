"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of intermediate tables: ``spark.checkpoint.dir``.

    Where it is unset, the session's warehouse folder, which executors share too.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def write_table(df: DataFrame, name: str) -> str:
    """Write ``df`` to a new folder and return its path."""
    folder = checkpoint_folder(df.sparkSession).rstrip("/")
    path = f"{folder}/threadlens/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage of iterative plans and fixes values that would otherwise
    be recomputed; the written files survive the loss of executors.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, name))


def materialize_by(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """Like ``materialize``, in buckets of ``key``, so that steps per key need no shuffle.

    There are as many buckets as shuffle partitions if no number is given.  Rows that lie by ``key`` already,
    as after a grouping by it, are written as they lie.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{checkpoint_folder(spark).rstrip('/')}/threadlens/{table}"
    df.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


@contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs run inside; what was set before is set again after."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
