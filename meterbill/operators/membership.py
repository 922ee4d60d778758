"""Approximate membership of a key, tested where rows are scanned.

A Bloom filter built by aggregates only: the wanted keys are hashed to bits of a bit set of a stated size,
the bits of each 64-bit word are combined before the shuffle, and the words become one array, a scalar subquery of
the plan that uses it.  A test is two array lookups inside the scan's own code; nothing is joined or shuffled.  It
never drops a wanted key.  More keys than the size is meant for let more others through, never fewer wanted ones.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20       # 128 KB; with 50,000 keys about 1 in 100 others passes
HASHES = 2


def _slots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))


def key_filter(wanted: DataFrame, bits: int = BITS) -> Callable[[Column | str], Column]:
    """A test for columns: false only for keys that are not in the one column of ``wanted`` (NULL is never in it)."""
    key = F.col(wanted.columns[0])
    kind = wanted.schema[0].dataType
    slots = wanted.filter(key.isNotNull()).select(F.explode(F.array(*_slots(key, bits))).alias("slot"))
    words = slots.groupBy((F.col("slot") / 64).cast("int").alias("word")).agg(F.bit_or(_bit(F.col("slot"))).alias("set"))
    every = wanted.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"))
    dense = every.join(words, "word", "left").select("word", F.coalesce("set", F.lit(0).cast("long")).alias("set"))
    array = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda w: w["set"])).scalar()

    def test(column: Column | str) -> Column:
        col = (F.col(column) if isinstance(column, str) else column).cast(kind)
        found = col.isNotNull()
        for slot in _slots(col, bits):
            found = found & (F.get(array, (slot / 64).cast("int")).bitwiseAND(_bit(slot)) != 0)
        return found
    return test
