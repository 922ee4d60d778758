"""Identically shaped shards as one data source: ``spark.read.format("shards")``.

The partitions of a scan are lanes: at most ``lanes`` (the connection cap) tasks, each of which opens its shards one after the other, so
no more readers are open at once than the cap allows, whatever the plan above does with the rows (a ``coalesce`` over a union holds
only as long as nothing between it and the scan shuffles).  All shards answer in one declared schema; one whose
column is missing or has another type fails by name instead of being widened.  Filters on the shard id drop shards
before a lane is planned; other simple filters go to every shard's own reader, and what it cannot do stays with Spark.

Options: ``path`` with ``{base}`` in it (Parquet files or folders), or ``opener`` = ``module:function`` for any other source;
``bases`` (comma-separated), ``lanes``, ``newest`` (stamp column: each shard answers with its newest snapshot only).
An opener is called as ``opener(base, columns, filters, options)`` and returns Arrow batches; ``filters`` are
(column, operator, value) triples that all must hold, ``options`` the source's own.
"""

from __future__ import annotations

from dataclasses import dataclass
from importlib import import_module
from typing import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as S
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from meterbill.sources.shards import BASES, MAX_PARALLEL_READS

BASE = "base"
OPERATORS = {S.EqualTo: "=", S.GreaterThan: ">", S.GreaterThanOrEqual: ">=", S.LessThan: "<", S.LessThanOrEqual: "<=",
             S.In: "in", S.IsNotNull: "is not null"}


class ShardSchema(ValueError):
    """A shard does not answer in the declared schema."""


@dataclass
class Lane(S.InputPartition):
    """The shards one task reads, in turn."""
    bases: tuple[int, ...]


def lanes(bases: Sequence[int], most: int) -> list[Lane]:
    """The shards dealt over at most ``most`` lanes."""
    return [Lane(tuple(bases[i::most])) for i in range(min(most, len(bases)))]


def _expression(filters) -> pc.Expression | None:
    out = None
    for column, operator, value in filters:
        f = pc.field(column)
        e = {"=": lambda: f == value, ">": lambda: f > value, ">=": lambda: f >= value, "<": lambda: f < value, "<=": lambda: f <= value,
             "in": lambda: f.isin(list(value)), "is not null": lambda: f.is_valid()}[operator]()
        out = e if out is None else out & e
    return out


def parquet_opener(base: int, columns: Sequence[str], filters, options) -> Iterator[pa.RecordBatch]:
    """A shard kept as Parquet under ``path``; filters reach its row groups."""
    path, store = _located(options["path"].format(base=base))
    table = ds.dataset(path, filesystem=store, format="parquet")
    missing = [c for c in columns if c not in table.schema.names]
    if missing:
        raise ShardSchema(f"shard {base} has no column {missing[0]}")
    where, newest = _expression(filters), options.get("newest")
    if newest:
        # Of the newest snapshot, not of the rows that pass the filters: the stamp alone is read first.
        stamps = [pc.max(b.column(0)) for b in table.to_batches(columns=[newest]) if b.num_rows]
        top = max((s.as_py() for s in stamps if s.is_valid), default=None)
        if top is None:
            return
        stamp = pc.field(newest) == top
        where = stamp if where is None else where & stamp
    yield from table.to_batches(columns=list(columns), filter=where)


def _located(path: str) -> tuple[str, fs.FileSystem | None]:
    """A path and the store it names, if it names one."""
    if "://" not in path and not path.startswith("file:"):
        return path, None
    store, at = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return at, store


class ShardsReader(S.DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        self.schema, self.options = schema, dict(options)
        self.bases = [int(b) for b in self.options.get("bases", ",".join(map(str, BASES))).split(",") if b.strip()]
        self.most = int(self.options.get("lanes", MAX_PARALLEL_READS))
        self.filters: list[tuple] = []

    def pushFilters(self, filters):
        declared = set(self.schema.names) - {BASE}
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            operator = OPERATORS.get(type(f))
            value = None if operator == "is not null" else getattr(f, "value", None)
            if column == BASE and operator in ("=", "in"):
                wanted = set(value) if operator == "in" else {value}
                self.bases = [b for b in self.bases if b in wanted]
            elif column in declared and operator and (operator == "is not null" or value is not None):
                self.filters.append((column, operator, value))
            elif not (column == BASE and operator == "is not null"):
                yield f

    def partitions(self):
        return lanes(self.bases, self.most) or [Lane(())]

    def read(self, lane: Lane) -> Iterator[pa.RecordBatch]:
        opener = parquet_opener
        if "opener" in self.options:
            module, name = self.options["opener"].split(":")
            opener = getattr(import_module(module), name)
        for base in lane.bases:
            for batch in opener(base, [c for c in self.schema.names if c != BASE], self.filters, self.options):
                yield self._typed(base, batch)

    def _typed(self, base: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = []
        for field in self.schema:
            wanted = to_arrow_type(field.dataType)
            if field.name == BASE:
                cols.append(pa.array([base] * batch.num_rows, wanted))
                continue
            found = batch.schema.field(field.name).type if field.name in batch.schema.names else None
            if found is None or T.StructType([field]) != T.StructType([T.StructField(field.name, _spark_type(found), field.nullable)]):
                raise ShardSchema(f"{field.name} of shard {base} is {found}, declared {wanted}")
            col = batch.column(batch.schema.names.index(field.name))
            cols.append(col.cast(wanted) if col.type != wanted else col)
        return pa.RecordBatch.from_arrays(cols, names=self.schema.names)


def _spark_type(arrow: pa.DataType) -> T.DataType:
    from pyspark.sql.pandas.types import from_arrow_type
    return from_arrow_type(arrow, prefer_timestamp_ntz=True)


class ShardsSource(S.DataSource):
    """The source; give it the shards' schema with a ``base`` column: ``spark.read.format("shards").schema(...)``."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def reader(self, schema: T.StructType) -> ShardsReader:
        return ShardsReader(schema, self.options)


def register(spark: SparkSession) -> None:
    """Make ``format("shards")`` known to the session, with filters handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ShardsSource)
