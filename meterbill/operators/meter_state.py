"""Readings kept as mergeable state: the last reading of every meter and period.

Volumes and last readings need no more of the past than that, so a run reads the new readings and the state, not all
readings of all time.  The state is cut into a fixed number of buckets by the meter's hash; a merge reads and writes the
buckets its readings fall into and leaves the files of the others where they are.  A version is a manifest (bucket -> folder) in
a chain of versions: readers see the old version or the new one, a merge that fails changes nothing, and of two
merges at once one is published and the other fails by name.

The last reading of a period is a maximum, so late readings merge in any order and equal ones any number of times.
A reading that is put right, or withdrawn, cannot be taken out of a maximum: the meter's period is named in ``corrected``
and delivered whole, and replaces what the state held of it.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.operators.readings import READING_ORDER
from meterbill.sources import versions
from meterbill.sources.materialize import to_shared_parquet

BUCKETS = 1024


class MeterState:
    """The state at ``path``.  ``order`` says which reading is the last, ``carry`` what else is kept of it."""

    def __init__(self, spark: SparkSession, path: str, *, key: str = "cd_cntr_kid", period: str = "bl_bill_id",
                 order: Sequence[str] = READING_ORDER, value: str = "value", carry: Sequence[str] = ("cd_indic_src_id",),
                 buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.period, self.value, self.buckets = spark, path.rstrip("/"), key, period, value, buckets
        self.fields = list(dict.fromkeys([*order, value, *carry]))

    def _last(self, readings: DataFrame) -> DataFrame:
        """(bucket, key, period, last): one row per meter and period, combined before the shuffle."""
        last = readings.groupBy(self.key, self.period).agg(F.max(F.struct(*self.fields)).alias("last"))
        return last.select(F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket"), self.key, self.period, "last")

    def manifest(self) -> dict[int, str]:
        """Folder of every bucket that has rows in the current version; at most ``buckets`` entries."""
        return self._buckets(versions.current(self.spark, self.path)[1])

    @staticmethod
    def _buckets(content: dict | None) -> dict[int, str]:
        return {int(b): v for b, v in content["buckets"].items()} if content else {}

    def merge(self, readings: DataFrame, corrected: DataFrame | None = None) -> str | None:
        """Merge new readings and publish; the folder of the new version, None if there was nothing to merge.

        ``corrected``: (key, period) pairs whose rows in the state are replaced by those of ``readings``.
        A merge during which another one was published changes nothing and fails (``PublishConflict``); run it again."""
        after, content = versions.current(self.spark, self.path)
        new = to_shared_parquet(self._last(readings), "meter-state-new")
        hit = new.select("bucket")
        if corrected is not None:
            pairs = corrected.select(self.key, self.period).distinct()
            hit = hit.union(pairs.select(F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")))
        touched = sorted(r.bucket for r in hit.distinct().collect())         # at most ``buckets`` numbers
        if not touched:
            return None
        manifest = self._buckets(content)
        old = self._rows({b: manifest[b] for b in touched if b in manifest}, new.schema)
        if corrected is not None:
            same = old[self.key].eqNullSafe(pairs[self.key]) & old[self.period].eqNullSafe(pairs[self.period])
            old = old.join(pairs, same, "left_anti")
        merged = old.unionByName(new).groupBy("bucket", self.key, self.period).agg(F.max("last").alias("last"))
        version = f"v-{uuid.uuid4().hex}"
        # one file a bucket, whatever the number of tasks
        merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{version}")
        kept = {r.bucket for r in self.spark.read.schema(new.schema).parquet(f"{self.path}/{version}").select("bucket").distinct().collect()}
        manifest = {b: v for b, v in manifest.items() if b not in set(touched)} | {b: version for b in kept}
        versions.publish(self.spark, self.path, {"buckets": manifest, "folders": sorted(set(manifest.values()) | {version})}, after)
        return version

    def _rows(self, folders: dict[int, str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        inner = T.StructType([f for f in schema if f.name != "bucket"])
        rows = self.spark.read.schema(inner).parquet(*[f"{self.path}/{v}/bucket={b}" for b, v in sorted(folders.items())])
        return rows.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")).select(*schema.names)

    def last_per_period(self) -> DataFrame:
        """(key, period, the last reading's fields) of the current version."""
        folders = self.manifest()
        if not folders:
            raise versions.Unpublished(f"no readings were merged into {self.path}")
        rows = self.spark.read.parquet(*[f"{self.path}/{v}/bucket={b}" for b, v in sorted(folders.items())])
        return rows.select(self.key, self.period, *[F.col(f"last.{c}").alias(c) for c in self.fields])

    def volumes(self) -> DataFrame:
        """``readings.period_volume`` of everything merged so far; the window holds one row per period of a meter."""
        before = F.lag(self.value).over(Window.partitionBy(self.key).orderBy(self.period))
        rows = self.last_per_period().withColumn("_before", before)
        return rows.select(self.key, self.period, F.col(self.value).alias("last_value"), F.col("_before").alias("prev_value"),
                           (F.col(self.value) - F.col("_before")).alias("volume"))

    def last(self) -> DataFrame:
        """``readings.last_reading`` of everything merged so far."""
        out = self.last_per_period().groupBy(self.key).agg(F.max(F.struct(*self.fields)).alias("_last"))
        return out.select(self.key, *[F.col(f"_last.{c}").alias(c) for c in self.fields])
