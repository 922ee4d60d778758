"""Meter readings: which reading counts for a period, the last reading, volumes.

Readings are the largest fact.  Every operator here pre-aggregates per key
before anything is joined back, so one meter holding a third of all readings
still becomes one partially aggregated row per map task rather than one
enormous window partition.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def grouped_multi_max(readings: DataFrame, keys: Sequence[str] = ("bl_bill_id", "cd_cntr_kid"),
                      date: str = "date_ind_take", value: str = "value") -> DataFrame:
    """Per key, the largest date and, independently, the largest value."""
    return readings.groupBy(*keys).agg(F.max(date).alias(date), F.max(value).alias(value))


def latest_max_reading(readings: DataFrame, keys: Sequence[str] = ("cd_cntr_kid", "bl_bill_id"),
                       date: str = "date_ind_take", value: str = "value") -> DataFrame:
    """Readings that are both the newest and the largest of their key group.

    Not ``row_number() = 1``: the maximum date and the maximum value are taken
    independently and a row survives only when it carries both, so a group
    whose newest reading is not its largest contributes nothing; exact ties
    all survive; a NULL date or value never matches.

    Plan: partial+final aggregate of the maxima (map-side combine, skew-proof),
    then an equi-join back on all four columns (keys, date, value).  Hashing on
    the four columns spreads a hot meter over many partitions; a window over
    ``keys`` would put all of its readings in one task.
    """
    maxima = grouped_multi_max(readings, keys, date, value)
    return readings.join(maxima, on=[*keys, date, value], how="inner")


# Tables with a reading id order by (date, id); the stand-ins have none and order by value, then source.
READING_ORDER = ("date_ind_take", "cd_ind_id")
_ORDER_FIELDS = ("date_ind_take", "value", "cd_indic_src_id")


def last_reading(readings: DataFrame, key: str = "cd_cntr_kid", order: Sequence[str] = _ORDER_FIELDS,
                 carry: Sequence[str] = ("value", "cd_indic_src_id")) -> DataFrame:
    """Per meter, the reading with the greatest ``order`` tuple, with the ``carry`` columns.

    One ``max(struct(...))`` aggregate: deterministic (ties broken by the
    later fields; exact duplicates give the same output row) and partially
    aggregated before the shuffle.  Meters with no readings are absent; join
    with ``how='left'`` to keep them as NULLs.
    """
    fields = list(dict.fromkeys([*order, *carry]))
    out = readings.groupBy(key).agg(F.max(F.struct(*fields)).alias("_best"))
    return out.select(key, *[F.col(f"_best.{c}").alias(c) for c in fields])


def period_last_values(readings: DataFrame, key: str = "cd_cntr_kid", period: str = "bl_bill_id",
                       order: Sequence[str] = _ORDER_FIELDS, value: str = "value") -> DataFrame:
    """Per (meter, period), the value of the last reading in that period."""
    best = F.max(F.struct(*dict.fromkeys([*order, value]))).alias("_best")
    return (readings.groupBy(key, period).agg(best)
            .select(key, period, F.col(f"_best.{value}").alias("last_value")))


def period_volume(readings: DataFrame, key: str = "cd_cntr_kid", period: str = "bl_bill_id",
                  order: Sequence[str] = _ORDER_FIELDS, value: str = "value") -> DataFrame:
    """Per (meter, period): last value in the period minus the last value of the
    meter's previous period that has readings; NULL when there is none.

    The window runs over the per-period aggregate, so a partition holds one
    row per period of one meter (bounded by the calendar), not its readings.
    """
    last = period_last_values(readings, key, period, order, value)
    w = Window.partitionBy(key).orderBy(period)
    prev = F.lag("last_value").over(w)
    return last.select(key, period, "last_value", prev.alias("prev_value"),
                       (F.col("last_value") - prev).alias("volume"))


def meter_summary(readings: DataFrame, period_id, key: str = "cd_cntr_kid", period: str = "bl_bill_id",
                  order: Sequence[str] = _ORDER_FIELDS, value: str = "value",
                  carry: Sequence[str] = ("date_ind_take", "cd_indic_src_id")) -> DataFrame:
    """Per meter, in one aggregate over the readings: the volume of ``period_id``
    (``period_volume`` of that period, NULL if the meter has no reading in it
    or none before) and the last reading overall (``last_reading``).

    Three conditional maxima: the last reading in the period, the last reading
    of the latest earlier period, and the last reading of all.  They are
    combined before the shuffle, so a meter with a third of all readings
    arrives as one row per map task; no window, and no raw reading is shuffled.
    """
    fields = [F.col(c) for c in dict.fromkeys([*order, value, *carry])]
    last = F.struct(*fields)
    out = readings.groupBy(key).agg(
        F.max(F.when(F.col(period) == period_id, last)).alias("_now"),
        F.max(F.when(F.col(period) < period_id, F.struct(F.col(period), *fields))).alias("_before"),
        F.max(last).alias("_last"))
    return out.select(key, (F.col(f"_now.{value}") - F.col(f"_before.{value}")).alias("volume"),
                      *[F.col(f"_last.{c}").alias(c) for c in dict.fromkeys([*carry, value])])
