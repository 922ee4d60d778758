"""Intermediate tables written once to the shared folder and read back.

A frame that several branches of one report consume would otherwise be
recomputed per branch (Spark only reuses an exchange when the subtrees are
identical after column pruning, which branches with different projections
never are).  Writing it as Parquet under ``spark.checkpoint.dir`` computes it
once, cuts the lineage (a lost executor costs a re-read, not a recompute of
the joins), and gives later joins real file-size statistics, so AQE can
broadcast it only when it is actually small.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame

from meterbill.session import scratch_path

Materializer = Callable[[DataFrame, str], DataFrame]


def lazy(df: DataFrame, name: str) -> DataFrame:
    """No materialisation: the frame stays part of each consumer's plan."""
    return df


def to_shared_parquet(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class SharedParquet:
    """``to_shared_parquet`` that remembers what it wrote, so the folders can
    be released once every consumer has run (``release``): each is
    overwritten by an empty table, which makes Spark clear its files."""

    def __init__(self) -> None:
        self.written: list[tuple[str, object]] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        spark = df.sparkSession
        path = scratch_path(spark, name)
        df.write.mode("overwrite").parquet(path)
        self.written.append((path, df.schema))
        return spark.read.parquet(path)

    def release(self, spark) -> None:
        """Empty every folder written so far.  Only after the frames built on
        them have been consumed (written or collected)."""
        for path, schema in self.written:
            release_path(spark, path, schema)
        self.written.clear()


def release_path(spark, path: str, schema) -> None:
    """Empty a scratch folder (an overwrite with no rows clears its files)."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
