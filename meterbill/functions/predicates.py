"""Row predicates of the billing SQL, as built-in Column expressions.

All of them stay inside whole-stage codegen and, where the operands are plain
columns and literals, Catalyst pushes them into the Parquet/JDBC scan.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = Column | _dt.date | _dt.datetime | str


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_value(as_of: AsOf) -> Column:
    """A point in time as a Column (a literal, a scalar subquery, or a column).

    Date-times are wall-clock values: a Python ``datetime`` or a string with a
    time part becomes a timestamp in the *session* time zone, the same zone in
    which Spark compares ``TIMESTAMP_NTZ`` columns and DATE bounds with it, so
    the result does not depend on the session's zone setting.  (``lit`` of a
    naive ``datetime`` would instead use the Python process's zone.)
    """
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp") if " " in as_of or "T" in as_of else F.lit(as_of).cast("date")
    return F.lit(as_of)


def valid_at(as_of: AsOf, begin: str | Column = "date_begin", end: str | Column = "date_end") -> Column:
    """``as_of BETWEEN begin AND end``: both ends included; a NULL bound or a NULL
    point gives NULL, which a filter drops.  A timestamp point with a time part is
    compared against midnight of a DATE bound, so it is *not* inside on the last
    day after midnight (the original ``sysdate`` behaviour)."""
    return as_of_value(as_of).between(_col(begin), _col(end))


def flag_is(c: str | Column, value: int = 1) -> Column:
    """Flag equality; flags are integers in the schema, compared as integers."""
    return _col(c) == F.lit(value)


def like_any(c: str | Column, patterns: Iterable[str]) -> Column:
    """OR of case-sensitive LIKE patterns (prefix ``'x%'`` or contains ``'%x%'``)."""
    col = _col(c)
    return reduce(lambda a, b: a | b, [col.like(p) for p in patterns])


def not_like(c: str | Column, pattern: str) -> Column:
    """``NOT LIKE``; a NULL operand stays NULL, so the row is dropped."""
    return ~_col(c).like(pattern)


def in_list(c: str | Column, values: Iterable) -> Column:
    return _col(c).isin(list(values))
