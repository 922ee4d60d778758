"""Point-in-interval joins: version rows x the periods whose date they cover."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterbill.sources.materialize import Materializer, to_shared_parquet


def _month(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def range_join(intervals: DataFrame, points: DataFrame, point: str, begin: str = "date_begin",
               end: str = "date_end") -> DataFrame:
    """Inner join of every interval row with every point row inside it
    (``point BETWEEN begin AND end``, both ends included).

    An equi-join on a month bucket: each interval is expanded to the months
    it spans (clamped to the months that hold points, so open-ended intervals
    do not explode), and the exact BETWEEN is applied after the join.  One
    plan for every size; AQE broadcasts the points if they are small.
    """
    months = points.agg(F.min(_month(F.col(point))).alias("lo"), F.max(_month(F.col(point))).alias("hi"))
    lo = F.greatest(_month(F.col(begin)), months.select("lo").scalar())
    hi = F.least(_month(F.col(end)), months.select("hi").scalar())
    spread = intervals.withColumn("_month", F.explode(F.when(lo <= hi, F.sequence(lo, hi))))
    keyed = points.withColumn("_month", _month(F.col(point)))
    return spread.join(keyed, "_month").filter(F.col(point).between(F.col(begin), F.col(end))).drop("_month")


def running_sum(rows: DataFrame, order: Sequence[str], value: str, *, out: str = "total",
                materialize: Materializer = to_shared_parquet) -> DataFrame:
    """``rows`` with the sum of ``value`` over all rows up to each, in ``order`` (which no two rows share): a scan over
    the whole table without a window over it.

    Range partitioning cuts the order into ranges by a sample of the rows; each range is summed up by itself and, over one row per
    range, what the ranges before it hold is carried in.  The ranges are written first, so that both passes see the same.
    """
    ranges = materialize(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "running-sum")
    totals = ranges.groupBy("_range").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    carried = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (ranges.withColumn("_run", F.sum(value).over(inside)).join(carried, "_range")
            .select(*rows.columns, (F.col("_run") + F.col("_carried")).alias(out)))


def covering_counts(intervals: DataFrame, points: DataFrame, point: str, begin: str = "date_begin",
                    end: str = "date_end", *, out: str = "versions",
                    materialize: Materializer = to_shared_parquet) -> DataFrame:
    """For every point row, how many interval rows contain it (``BETWEEN``,
    both ends included) - the result of ``range_join(...).groupBy(point
    columns).count()`` without pairing any interval row with a point.

    An interval with a NULL bound or ``begin > end`` contains nothing.  For
    the others, count(p) = #(begin <= p) - #(end < p): a running sum over
    dates or timestamps.  Begins and ends are first reduced to totals per date (partial
    aggregation), and summed up by ``running_sum``; the counts come back to the points by an equi-join on the
    date alone, so NULLs in other point columns do not matter.  Points
    contained in no interval are absent, as with an inner join.
    """
    valid = intervals.filter(F.col(begin) <= F.col(end))
    # at one date: begins count, then the point itself is read, ends count only later
    begins = valid.groupBy(F.col(begin).alias("_d")).agg(F.count("*").alias("_n")).withColumn("_step", F.lit(0))
    reads = points.select(F.col(point).alias("_d")).filter("_d is not null").distinct() \
        .withColumn("_n", F.lit(0).cast("bigint")).withColumn("_step", F.lit(1))
    ends = valid.groupBy(F.col(end).alias("_d")).agg((-F.count("*")).alias("_n")).withColumn("_step", F.lit(2))
    steps = begins.unionByName(reads).unionByName(ends)
    at = running_sum(steps, ("_d", "_step"), "_n", out=out, materialize=materialize).filter((F.col("_step") == 1) & (F.col(out) > 0)).select("_d", out)
    return points.join(at, F.col(point) == F.col("_d")).select(*points.columns, out)
