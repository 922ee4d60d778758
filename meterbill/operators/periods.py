"""Billing periods: the current open/closed period and the once-per-period gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN = "O"
CLOSED = "C"


def current_period(periods: DataFrame, status: str = CLOSED, *, id_col: str = "bl_bill_id",
                   date_col: str = "bill_date", name_col: str = "bill_name",
                   status_col: str = "period_status") -> DataFrame:
    """The period with the largest id among those with ``status``, as one row.

    A global aggregate: always exactly one row (all NULL when no period has the
    status), so it is safe to broadcast or to use as a scalar subquery.  Date
    and name come from the same row via ``max_by`` - no join back, and never
    the "more than one row" error of a duplicated scalar subquery.
    """
    return (periods.filter(F.col(status_col) == F.lit(status))
            .agg(F.max(id_col).alias(id_col),
                 F.max_by(date_col, id_col).alias(date_col),
                 F.max_by(name_col, id_col).alias(name_col)))


def period_scalar(periods: DataFrame, field: str = "bill_date", status: str = CLOSED) -> Column:
    """A field of the current period as an uncorrelated scalar subquery.

    Spark runs it once per query and reuses the value in every filter
    (``ReusedSubquery``); NULL when no such period exists, so every
    ``BETWEEN`` against it is false and counts come out 0.
    """
    return current_period(periods, status).select(field).scalar()


def open_and_closed(periods: DataFrame, *, id_col: str = "bl_bill_id", date_col: str = "bill_date",
                    name_col: str = "bill_name", status_col: str = "period_status") -> DataFrame:
    """Open and closed period (id, date, name) side by side: one aggregate, one row."""
    out = []
    for prefix, status in (("open", OPEN), ("closed", CLOSED)):
        key = F.when(F.col(status_col) == F.lit(status), F.col(id_col))
        out += [F.max(key).alias(f"{prefix}_id"),
                F.max_by(date_col, key).alias(f"{prefix}_date"),
                F.max_by(name_col, key).alias(f"{prefix}_name")]
    return periods.agg(*out)


def period_gate(periods: DataFrame, ledger: DataFrame, job: str) -> DataFrame:
    """Rows to run now: ``(dag_name, exec_period)`` for the open period if the
    ledger's highest recorded period for ``job`` differs from it, else no row.

    ``coalesce(max(exec_period), 0)`` makes an empty ledger a "never ran"; the
    comparison is ``<>``, as in the original, so a ledger ahead of the
    database also triggers a run.  The open period is a single-row aggregate,
    the ledger side a scalar subquery; no join.
    """
    done = (ledger.filter(F.col("dag_name") == F.lit(job))
            .agg(F.coalesce(F.max("exec_period"), F.lit(0)).cast("bigint")).scalar())
    return (current_period(periods, OPEN)
            .select(F.lit(job).alias("dag_name"), F.col("bl_bill_id").cast("bigint").alias("exec_period"))
            .filter(F.col("exec_period") != done))
