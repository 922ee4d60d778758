"""Incremental batch: run a periodic job once per open billing period.

The billing jobs are bounded batches; the only incremental state is a run
ledger ``(dag_name, exec_period)``.  A run computes the gate (one row when the
open period differs from the ledger's latest period for the job), does its
work, and appends the gate row only after the work succeeded - so a failed
run is retried next time instead of being skipped for the whole period.
"""

from __future__ import annotations

from typing import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterbill.operators.periods import period_gate
from meterbill.sources.claims import Claim, ClaimLost
from meterbill.sources.sinks import append_ledger

STALE_AFTER = 2 * 60 * 60.0     # seconds; twice the longest a job may run

LEDGER_SCHEMA = T.StructType([T.StructField("dag_name", T.StringType(), False),
                              T.StructField("exec_period", T.LongType(), False)])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table; an absent ledger is an empty one.  A row that was appended twice is one row."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path).distinct()
    except Exception as e:  # noqa: BLE001 - only "path does not exist" is expected
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def run_once_per_period(periods: DataFrame, ledger_path: str, job: str,
                        work: Callable[[int], None], *, stale_after: float = STALE_AFTER) -> int | None:
    """Run ``work(period)`` if the open period was not processed yet.

    Returns the processed period, or None when the gate is closed or another run holds the period.  The gate
    frame has at most one row, so taking it to the driver is bounded.

    Two schedulers may start at once: both can find the gate open, one gets the claim on (job, period).  The gate is
    asked again under the claim, for a run that ended in between.  A claim older than ``stale_after`` seconds is a dead
    run's and is taken over; a run that lost its claim that way appends nothing (``ClaimLost``).  Work that fails
    gives the claim up, so the next run tries again.
    """
    spark = periods.sparkSession
    row = period_gate(periods, read_ledger(spark, ledger_path), job).first()
    if row is None:
        return None
    period = int(row["exec_period"])
    claim = Claim(spark, f"{ledger_path.rstrip('/')}-claims/{quote(job, safe='')}-{period}", stale_after)
    if not claim.take():
        return None
    try:
        again = period_gate(periods, read_ledger(spark, ledger_path), job).first()
        if again is None or int(again["exec_period"]) != period:
            return None
        work(period)
        if not claim.held():
            raise ClaimLost(f"{job} {period}: another run took the period over")
        append_ledger(spark.createDataFrame([(job, period)], LEDGER_SCHEMA), ledger_path)
    finally:
        claim.release()
    return period
