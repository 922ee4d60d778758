"""Helpers shared by the corpus operators."""

from __future__ import annotations

from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterbill.sources.materialize import to_shared_parquet

# Rows handled at once inside a task, so that a batch of very long texts stays small in memory.
CHUNK_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables, read by Spark only (the path may be in any store Spark reads)."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once under ``spark.checkpoint.dir`` and read back (cuts the lineage, survives lost executors)."""
    return to_shared_parquet(df, f"llm-{name}")


def packed(df: DataFrame) -> DataFrame:
    """All columns in one struct ``row``, so that no column an operator adds can clash with an input's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The inverse of ``packed`` for the named columns."""
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def chunks(batches: Iterator[pa.RecordBatch], rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into pieces of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_chunks(df: DataFrame, one: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
               rows: int = CHUNK_ROWS) -> DataFrame:
    """``mapInArrow`` over pieces of at most ``rows`` rows; ``one`` maps a piece to a record batch."""
    def run(batches):
        for piece in chunks(batches, rows):
            yield one(piece)
    return df.mapInArrow(run, schema)
