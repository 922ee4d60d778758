"""Writers: full-refresh target, small report files, the run ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterbill.session import scratch_path
from meterbill.sources import versions
from meterbill.sources.claims import file_system
from meterbill.sources.materialize import release_path


def full_refresh(df: DataFrame, path: str, *, fmt: str = "parquet", retry: bool = True) -> int:
    """Replace the whole target with ``df``; the number of the new version.

    The rows are written to a new folder below ``path``; only after that
    job has succeeded does a manifest name it (see ``versions``).  A
    failure before that leaves the old version current, readers never see a
    part, and task retries never duplicate rows (file commit protocol).
    If another run published meanwhile, this one follows it; with ``retry`` off it fails instead (``PublishConflict``).
    Read with ``read_target``; ``versions.expire`` removes old versions.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    after = versions.current(spark, path)[0]
    folder = f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").format(fmt).save(f"{path}/{folder}")
    return publish_folder(spark, path, folder, after, retry=retry)


def publish_folder(spark: SparkSession, path: str, folder: str, after: int, *, retry: bool, **more) -> int:
    """Publish one folder as the version after ``after``, or after whichever is current if ``retry``."""
    while True:
        try:
            return versions.publish(spark, path, {"folders": [folder], **more}, after)
        except versions.PublishConflict:
            if not retry:
                raise
            after = versions.current(spark, path)[0]


def read_target(spark: SparkSession, path: str, *, fmt: str = "parquet", manifest: dict | None = None) -> DataFrame:
    """The current version of a refreshed target, or the one of a ``manifest`` (``versions.pinned``);
    ``Unpublished`` if there is none yet."""
    path = path.rstrip("/")
    found = manifest or versions.current(spark, path)[1]
    if found is None:
        raise versions.Unpublished(f"nothing was published at {path}")
    return spark.read.format(fmt).load(f"{path}/{found['folders'][0]}")


def ordered_sink(report: DataFrame, path: str, *, header: bool = True) -> int:
    """Publish a sorted report of any size as numbered CSV parts; the number of the version.

    ``report`` ends with its ``orderBy``: Spark sorts it by ranges, so every task writes a part of its own and the parts, in the order of
    their names, are the report in order.  The manifest lists them.  Read with ``read_parts``; an empty text comes
    back as NULL, which it is in the reports' source.
    """
    spark, path = report.sparkSession, path.rstrip("/")
    after = versions.current(spark, path)[0]
    folder = f"v-{uuid.uuid4().hex}"
    report.write.mode("errorifexists").option("header", header).option("escape", '"').csv(f"{path}/{folder}")
    fs, at = file_system(spark, f"{path}/{folder}")
    names = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-"))
    return publish_folder(spark, path, folder, after, retry=True, parts=names, header=header)


def read_parts(spark: SparkSession, path: str, schema: T.StructType) -> list[DataFrame]:
    """The parts of the current version of an ordered report, in its order."""
    path = path.rstrip("/")
    found = versions.current(spark, path)[1]
    if found is None:
        raise versions.Unpublished(f"nothing was published at {path}")
    read = spark.read.schema(schema).option("header", found["header"]).option("escape", '"').option("multiLine", True)
    return [read.csv(f"{path}/{found['folders'][0]}/{name}") for name in found["parts"]]


def full_refresh_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Same for a JDBC target: staged first, then ``truncate`` + insert (the
    table definition is kept)."""
    spark = df.sparkSession
    staged = scratch_path(spark, "full-refresh-stage")
    df.write.mode("overwrite").parquet(staged)
    copy = spark.read.parquet(staged)
    (copy.write.format("jdbc").mode("overwrite")
     .option("url", url).option("dbtable", table).option("truncate", "true")
     .options(**options).save())
    release_path(spark, staged, copy.schema)


def report_sink(report: DataFrame, path: str, *, header: bool = True) -> None:
    """Write a report as one CSV file with a header row.

    ``coalesce(1)`` is only for reports that are small by construction (a
    fixed list of metrics); it never applies to a fact-sized frame.
    """
    report.coalesce(1).write.mode("overwrite").option("header", header).csv(path)


def append_ledger(rows: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Record processed periods (append-only)."""
    rows.write.mode("append").format(fmt).save(path)
