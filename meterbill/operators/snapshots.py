"""Snapshot tables sharded over several databases: newest stamp, completeness."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_snapshot_per_base(df: DataFrame, base: str = "base", stamp: str = "data_my") -> DataFrame:
    """Rows carrying the newest ``stamp`` of their own shard.

    The newest stamp is per shard (each shard answered its own ``max``), never
    global; every shard that has rows is kept.  Plan: aggregate the maxima
    (partial aggregation, so a shard holding a third of all rows is no hot
    spot), then a semi-join on (base, stamp) whose right side has one row per
    shard; AQE broadcasts it when its measured size is small.
    """
    newest = df.groupBy(base).agg(F.max(stamp).alias(stamp))
    return df.join(newest, on=[base, stamp], how="left_semi")


def newest_rows(df: DataFrame, stamp: str = "data_my") -> DataFrame:
    """The rows of one shard that carry its newest ``stamp``.

    The newest stamp is a scalar subquery: an aggregate over the stamp alone, whose answer is known before the rows
    are scanned.  On snapshots laid out by stamp it prunes partitions at run time, and reads no column
    file of an old snapshot; on other Parquet tables it reaches the scan as a filter.  No rows, or NULL stamps only: no rows.
    """
    return df.filter(F.col(stamp) == df.agg(F.max(stamp)).scalar())


def missing_bases(read: DataFrame, bases: Sequence[int], base: str = "base") -> DataFrame:
    """Expected shard ids that were not read: ``read`` has one row per shard whose
    read succeeded, with any number of rows (an empty shard is a read shard)."""
    expected = read.sparkSession.createDataFrame([(int(b),) for b in bases],
                                                 T.StructType([T.StructField(base, T.IntegerType(), False)]))
    present = read.select(F.col(base).cast("int").alias(base)).distinct()
    return expected.join(present, on=base, how="left_anti")


class IncompleteShards(RuntimeError):
    """A shard could not be read, or a shard nobody expects was."""


def assert_complete(read: Sequence[int], bases: Sequence[int]) -> None:
    """Fail before any target is touched if a shard was not read or is unknown."""
    missing, unknown = sorted(set(bases) - set(read)), sorted(set(read) - set(bases))
    if missing or unknown:
        raise IncompleteShards(f"shards not read: {missing}, unknown shards: {unknown}")
