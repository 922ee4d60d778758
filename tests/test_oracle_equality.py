"""Every query key equals its DuckDB oracle (original SQL shape) at sf0.001."""

import datetime as dt
import math

import pytest

import __spark_entry__ as entry
from meterbill.catalog import QUERIES
from meterbill.oracle import ORACLE
from tests.conftest import SF_SMALL

KEYS = sorted(QUERIES)
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
                 "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_key_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = duck.sql(ORACLE[key])
    assert sorted(got_cols) == sorted(res.columns)
    duck_types = {c: str(t) for c, t in zip(res.columns, res.types)}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    assert _rows(got_cols, got) == _rows(res.columns, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert [c for c in df.columns] == ["seq", "parameter", "value"]
    assert len(rows) >= 22


@pytest.mark.parametrize("key", ["as_of_attribute", "meter_extract", "case_expr", "monthly_report"])
def test_independent_of_session_time_zone(spark, duck, key):
    """Wall-clock timestamps: results do not move with the session zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        test_matches_oracle(spark, duck, key)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
