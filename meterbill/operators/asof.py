"""As-of join: for every lookup row the version that is valid at the row's own date.

``attributes.attribute_as_of`` answers one date for all objects with an aggregate.  Here every lookup brings its own
date, so versions and lookups are merged into one stream, sorted by (key, time) with range partitioning: time is part
of what is sorted, so an object that holds a third of all rows is cut into as many time ranges as its rows need.  A task sweeps its
range and keeps the versions that may still answer: a later one that lasts as long takes the place of those before it.
A lookup is answered within its range if a version that began there covers it (it is newer than any that began earlier).  The others, which
can only belong to the key with which the range begins, wait for the carries: what earlier ranges of that key were still keeping at
their end.  Carries are a few rows per range; they meet the waiting rows by an equi-join on the range's number.

No window and no group holds a key's rows; the stream is shuffled once.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.sources.materialize import Materializer, to_shared_parquet

ANSWERED, WAITING, CARRY, FIRST = range(4)


def _stack_below(end: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For every version in order, the nearest one before it of the same key that lasts longer, -1 if none."""
    below = np.full(len(end), -1)
    stack: list[int] = []
    ends, keys = end.tolist(), key.tolist()
    for i, (e, k) in enumerate(zip(ends, keys)):
        while stack and (keys[stack[-1]] != k or ends[stack[-1]] <= e):
            stack.pop()
        if stack:
            below[i] = stack[-1]
        stack.append(i)
    return below


def sweep(key: np.ndarray, time: np.ndarray, is_lookup: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a stream sorted by key, time and versions before lookups: for every lookup (in order) the version that
    answers it or -1, and the versions of the last key that later lookups may still need, oldest first."""
    versions = np.flatnonzero(~is_lookup)
    lookups = np.flatnonzero(is_lookup)
    below = _stack_below(end[versions], key[versions])
    at = np.searchsorted(versions, lookups) - 1           # the last version before each lookup
    at = np.where((at >= 0) & (key[versions[at]] == key[lookups]), at, -1) if len(versions) else np.full(len(lookups), -1)
    while True:
        short = np.flatnonzero(at >= 0)
        short = short[end[versions[at[short]]] < time[lookups[short]]]
        if not len(short):
            break
        at[short] = below[at[short]]
    last = len(versions) - 1
    if last < 0 or not len(key) or key[versions[last]] != key[-1]:
        return np.where(at >= 0, versions[at] if len(versions) else -1, -1), np.zeros(0, np.int64)
    kept = []
    while last >= 0:
        kept.append(versions[last])
        last = below[last]
    return np.where(at >= 0, versions[at], -1), np.array(kept[::-1], np.int64)


def _numbers(col: pa.Array) -> np.ndarray:
    """Dates, timestamps and whole numbers as 64-bit numbers in the same order (NULL as 0; not read)."""
    if pa.types.is_date32(col.type):
        col = col.cast(pa.int32())
    return col.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)


def _sweeper(keys: int):
    """The task of one range: batches of (key columns, _time, _lookup, _end, _value, _row) -> answers, waiting rows, carries."""
    def run(batches):
        number = TaskContext.get().partitionId()
        first, carry, last_batch = None, None, None     # the range's first key; versions kept so far, as a batch
        for batch in batches:
            if not batch.num_rows:
                continue
            joined = pa.Table.from_batches([b for b in (carry, batch) if b is not None]).combine_chunks().to_batches()[0]
            cols = joined.columns
            names = list(zip(*[c.to_pylist() for c in cols[:keys]]))
            if first is None:
                first = names[0]
            changed = np.array([a != b for a, b in zip(names[1:], names)], bool)
            key = np.concatenate(([0], np.cumsum(changed)))
            is_lookup = cols[keys + 1].to_numpy(zero_copy_only=False)
            found, kept = sweep(key, _numbers(cols[keys]), is_lookup, _numbers(cols[keys + 2]))
            lookups = np.flatnonzero(is_lookup)
            if len(lookups):
                in_first = np.array([names[i] == first for i in lookups], bool)
                yield _rows(joined, keys, number, lookups,
                            np.where((found < 0) & in_first, WAITING, ANSWERED), np.where(found < 0, None, found))
            carry = joined.take(pa.array(kept)) if len(kept) else None
            last_batch = joined.slice(joined.num_rows - 1)
        if first is not None:
            if carry is not None:
                yield _rows(carry, keys, number, np.arange(carry.num_rows), np.full(carry.num_rows, CARRY), np.arange(carry.num_rows))
            head = pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(first, last_batch.schema)] + [pa.nulls(1, c.type) for c in last_batch.columns[keys:]],
                names=last_batch.schema.names)
            yield _rows(head, keys, number, np.zeros(1, np.int64), np.array([FIRST]), np.array([None]))
    return run


def _rows(batch: pa.RecordBatch, keys: int, number: int, at: np.ndarray, kind: np.ndarray, version: np.ndarray) -> pa.RecordBatch:
    rows = batch.take(pa.array(at))
    values = batch.column(keys + 3).take(pa.array(version, pa.int64(), from_pandas=True))
    cols = [*rows.columns[:keys], rows.column(keys), rows.column(keys + 2), values, rows.column(keys + 4),
            pa.array(kind, pa.int32()), pa.array([number] * len(at), pa.int32())]
    names = batch.schema.names
    return pa.RecordBatch.from_arrays(cols, names=[*names[:keys + 1], *names[keys + 2:], "_kind", "_range"])


def as_of_join(lookups: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, *, begin: str = "date_begin",
               end: str = "date_end", value: str = "value", out: str = "value",
               materialize: Materializer = to_shared_parquet) -> DataFrame:
    """Every row of ``lookups`` with the ``value`` of the version of its ``keys`` that is valid at its ``at`` (both ends
    included) as column ``out``.

    Several valid versions: the newest ``begin`` wins, then the larger value; none valid, or a NULL key or date:
    NULL.  A version with a NULL key or end, or that ends before it begins, answers nothing.  Equal lookups
    are all answered.  Dates and timestamps may meet; they are compared as Spark compares them.
    """
    keys = list(keys)
    time = versions.select(begin).union(lookups.select(at)).schema[0].dataType
    row = F.struct(*[F.col(f"`{c}`") for c in lookups.columns])
    typed = lambda c: F.col(c).cast(time)
    names = [f"_k{i}" for i in range(len(keys))]
    kinds = [versions.select(k).union(lookups.select(k)).schema[0].dataType for k in keys]
    keyed = [F.col(k).cast(t).alias(n) for k, t, n in zip(keys, kinds, names)]
    row_type = lookups.select(row.alias("r")).schema[0].dataType
    value_type = versions.schema[value].dataType
    told = versions.filter(F.col(begin) <= F.col(end)).select(
        *keyed, typed(begin).alias("_time"), F.lit(False).alias("_lookup"), typed(end).alias("_end"), F.col(value).alias("_value"),
        F.lit(None).cast(row_type).alias("_row"))
    asked = lookups.select(
        *keyed, typed(at).alias("_time"), F.lit(True).alias("_lookup"), F.lit(None).cast(time).alias("_end"),
        F.lit(None).cast(value_type).alias("_value"), row.alias("_row"))
    known = F.lit(True)
    for c in (*names, "_time"):
        known = known & F.col(c).isNotNull()
    stream = told.union(asked).filter(known)
    order = [*names, "_time", "_lookup", "_value"]
    schema = T.StructType([*[T.StructField(n, t) for n, t in zip(names, kinds)], T.StructField("_time", time), T.StructField("_end", time),
                           T.StructField("_value", value_type), T.StructField("_row", row_type),
                           T.StructField("_kind", T.IntegerType()), T.StructField("_range", T.IntegerType())])
    swept = materialize(stream.repartitionByRange(*order).sortWithinPartitions(*order)
                        .mapInArrow(_sweeper(len(keys)), schema), "as-of")
    of = lambda k: swept.filter(F.col("_kind") == k)
    carries = of(CARRY).select(*names, F.col("_range").alias("_from"), F.struct("_time", "_value", "_end").alias("_version"))
    # newest first: the first that still lasts is the answer
    passed = (of(FIRST).select(*names, "_range").join(carries, names).filter(F.col("_from") < F.col("_range"))
              .groupBy("_range").agg(F.sort_array(F.collect_list("_version"), asc=False).alias("_kept")))
    lasting = F.filter("_kept", lambda v: v["_end"] >= F.col("_time"))
    late = of(WAITING).join(passed, "_range", "left").select("_row", F.get(lasting, F.lit(0))["_value"].alias(out))
    done = of(ANSWERED).select("_row", F.col("_value").alias(out))
    never = asked.filter(~known).select("_row", F.lit(None).cast(value_type).alias(out))
    columns = [F.col(f"_row.`{c}`").alias(c) for c in lookups.columns]
    return done.union(late).union(never).select(*columns, out)
