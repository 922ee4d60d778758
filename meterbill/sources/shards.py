"""Identically shaped shards read as one DataFrame."""

from __future__ import annotations

import logging
from functools import reduce
from types import MappingProxyType
from typing import Callable, Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbill.operators.snapshots import newest_rows

from meterbill.sources.materialize import to_shared_parquet

log = logging.getLogger(__name__)
SOURCE_ERRORS = (PySparkException, Py4JError, OSError)      # what a database, a file system or Spark raises for a source

# ---------------------------------------------------------------------------
# Fixed values of the consolidation job: shard ids and the concurrent-read cap.
# ---------------------------------------------------------------------------
BASES = (15, 20, 27, 29, 30, 43, 56, 71, 73)
MAX_PARALLEL_READS = 4
# Target column order of the consolidated table.
TARGET_COLUMNS = ("base", "ls", "fio", "address", "close_ls")
# ---------------------------------------------------------------------------


def read_shards(read_one: Callable[[int], DataFrame], bases: Sequence[int], *,
                names: Sequence[str] | None = None, base_col: str = "base") -> DataFrame:
    """Union of one read per shard, each row tagged with its shard id.

    ``names`` renames the shard columns positionally (the shard answers with
    its own column names).  To read databases under a cap of connections,
    stage the union first (``stage_shards``).
    """
    parts = []
    for b in bases:
        df = read_one(b)
        if names is not None:
            df = df.toDF(*names)
        parts.append(df.withColumn(base_col, F.lit(int(b))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def newest_snapshot_sql(table: str, stamp: str = "data_my", columns: Sequence[str] = ("*",)) -> str:
    """The query a shard database should answer: its newest snapshot only, so
    that older snapshots never leave it (``sources.jdbc.read_query``)."""
    return f"select {', '.join(columns)} from {table} where {stamp} = (select max({stamp}) from {table})"


class ShardTypes(ValueError):
    """A shard's table has a column of another type than the first shard's, or other columns."""


def assert_same_types(frames: dict[int, DataFrame], table: str) -> None:
    """Fail, naming the shards, if a table differs between them: a union would widen the types in silence."""
    (first, expected), *others = [(b, df.dtypes) for b, df in frames.items()]
    for b, found in others:
        if found != expected:
            raise ShardTypes(f"{table} of shard {b} is {found}, of shard {first} {expected}")


def stage_shards(read_one: Callable[[int], dict[str, DataFrame]], bases: Sequence[int], names: Sequence[str], *,
                 max_parallel: int = MAX_PARALLEL_READS, base_col: str = "base", newest: Mapping[str, str] = MappingProxyType({}),
                 columns: Mapping[str, Sequence[str]] = MappingProxyType({})) -> tuple[dict[str, DataFrame], list[int]]:
    """Every shard's tables, each read once and kept in the shared folder, and the
    shards that were read.

    ``newest`` names the stamp column of snapshot tables: of those each shard hands out its newest snapshot only (``newest_rows``), so
    no older row is written.  ``columns`` names what is needed of a table; a shard's other columns are not read.

    One write job per table, coalesced to ``max_parallel`` tasks: at most that
    many source partitions are read at a time, and what works on the staged
    tables afterwards uses the whole cluster.  A shard that cannot be opened is
    left out of the list; one that fails while it is read fails the job.  A shard
    without rows is a read shard.
    """
    shards: dict[int, dict[str, DataFrame]] = {}
    for b in bases:
        try:
            shards[b] = read_one(b)
        except SOURCE_ERRORS as e:      # the shard is reported as not read; a programming error is raised
            log.warning("shard %s not read: %s", b, e)
    if not shards:
        return {}, []
    staged = {}
    for name in names:
        frames = {b: tables[name].select(*columns.get(name, ["*"])) for b, tables in shards.items()}
        assert_same_types(frames, name)
        if name in newest:
            frames = {b: newest_rows(df, newest[name]) for b, df in frames.items()}
        union = read_shards(frames.__getitem__, list(frames), base_col=base_col)
        staged[name] = to_shared_parquet(union.coalesce(max_parallel), f"shards-{name}")
    return staged, list(shards)
