"""The metrics of all periods at once, against one report per period and against definitions."""

import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterbill.functions.rules import FIXTURE
from meterbill.plans.history import Calendar, MonthlyHistory, intersected, sums_at, united
from meterbill.plans.monthly import MonthlyStats
from meterbill.sources.materialize import to_shared_parquet
from meterbill.sources.standins import Standins
from tests.conftest import SF_SMALL

D0 = dt.date(2024, 1, 1)
SPAN = "k int, begin date, end date"
span = st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 40), st.integers(0, 15))


def day(n):
    return D0 + dt.timedelta(days=n)


def spans(rows):
    return [(k, day(b), day(b + n)) for k, b, n in rows]


class UpTo:
    """The tables as they are while ``period`` is the last closed one."""

    def __init__(self, tables, period):
        self.tables, self.period = tables, period

    def __getitem__(self, name):
        df = self.tables[name]
        return df.filter(df["bl_bill_id"] <= self.period) if name == "bl_bill_periods" else df


@pytest.fixture(scope="module")
def history(spark):
    out = defaultdict(dict)
    for r in MonthlyHistory(Standins.of(spark, SF_SMALL), FIXTURE).metrics().collect():
        out[r.bl_bill_id][r.metric, r.channel] = r.value
    return out


@pytest.mark.parametrize("at", [3, 40, -1])
def test_each_period_equals_its_own_report(spark, history, at):
    period = sorted(history)[at]
    stats = MonthlyStats(UpTo(Standins.of(spark, SF_SMALL), period), FIXTURE, materialize=to_shared_parquet)
    want = {}
    for frame in (stats.m01(), stats.m02(), stats.m03(), stats.m05(), stats.houses(), stats.meter_service_counts()):
        want |= {(m, None): v for m, v in frame.first().asDict().items()}
    want |= {("M04", r.channel): r.accounts for r in stats.m04().collect()}
    assert history[period] == want and len(want) >= 18


def test_every_closed_period_has_every_metric(spark, history):
    closed = {r.bl_bill_id for r in Standins.of(spark, SF_SMALL)["bl_bill_periods"].filter("period_status = 'C'").collect()}
    assert set(history) == closed
    assert all({m for m, _ in h} >= {f"M{i:02d}" for i in range(1, 20) if i != 4} for h in history.values())


@settings(max_examples=10, deadline=None)
@given(st.lists(span, max_size=20))
def test_united_intervals_cover_the_same_days_once(spark, rows):
    got = united(spark.createDataFrame(spans(rows), SPAN), ("k",)).collect()
    days = [(r.k, r.begin + dt.timedelta(days=i)) for r in got for i in range((r.end - r.begin).days + 1)]
    assert len(days) == len(set(days))
    assert set(days) == {(k, b + dt.timedelta(days=i)) for k, b, e in spans(rows) for i in range((e - b).days + 1)}


@settings(max_examples=8, deadline=None)
@given(st.lists(span, max_size=15), st.lists(span, max_size=15), st.lists(st.integers(-3, 60), min_size=1, max_size=6))
def test_intersections_summed_at_points_match_definition(spark, left, right, points):
    a, b = (spark.createDataFrame(spans(r), SPAN) for r in (left, right))
    pairs = intersected(a, b, "k").selectExpr("concat('m', k) as metric", "begin", "end", "cast(k + 1 as long) as weight")
    at = spark.createDataFrame([(i, day(p)) for i, p in enumerate(points)], "i int, d date")
    got = {(r.i, r.metric): r.value for r in sums_at(pairs, at, "d", ("m0", "m1", "m2"), to_shared_parquet).collect()}
    assert got == {(i, f"m{k}"): (k + 1) * sum(1 for x, b1, e1 in spans(left) for y, b2, e2 in spans(right)
                                             if x == y == k and b1 <= day(p) <= e1 and b2 <= day(p) <= e2)
                   for i, p in enumerate(points) for k in range(3)}


def test_sets_of_periods_match_definition(spark):
    periods = [(100 + i, day(30 * i)) for i in range(70)] + [(100, day(5)), (100, day(2100)), (101, day(30)), (None, day(3)), (7, None)]
    bounds = [(-9, 5), (0, 0), (1, 29), (5, 2100), (30, 1900), (1861, 1890), (2071, 9999), (40, 10), (3000, 4000)]
    rows = [(i, day(b), day(e)) for i, (b, e) in enumerate(bounds)] + [(90, None, day(9)), (91, day(9), None)]
    calendar = Calendar(spark.createDataFrame(periods, "bl_bill_id long, bill_date date"), to_shared_parquet)
    table = spark.createDataFrame(rows, "k int, begin date, end date")
    for frame in (table, table.selectExpr("k", "cast(begin as timestamp) as begin", "cast(end as timestamp) + interval 3 hours as end")):
        held = frame.select("k", *[c.alias(m) for c, m in zip(calendar.in_force(), calendar.masks)])
        got = [(r.k, r.bl_bill_id) for r in calendar.exploded(held.filter(calendar.some())).collect()]
        assert len(calendar.masks) == 2 and len(got) == len(set(got))
        assert set(got) == {(k, p) for k, b, e in rows for p, d in periods if b and e and p and d and b <= d <= e}
    late = frame.selectExpr("k", "begin + interval 1 hour as begin", "end").filter("k = 1").select(*[c.alias(m) for c, m in zip(calendar.in_force(), calendar.masks)])
    assert late.filter(calendar.some()).isEmpty()          # begins after the day's midnight
    none = Calendar(spark.createDataFrame([], "bl_bill_id long, bill_date date"), to_shared_parquet)
    empty = table.select("k", *[c.alias(m) for c, m in zip(none.in_force(), none.masks)]).filter(none.some())
    assert none.exploded(empty).isEmpty()
