"""Exact distinct counts that roll up: members as bitmaps, merged by OR.

A distinct count cannot be added up over channels or periods; the set of members can.  Members with whole-number ids become
bits of 4 KB bitmaps, one for every 32,768 ids, built while rows are aggregated; a bitmap per group and id range is all
that is shuffled or kept.  Coarser counts come from the bitmaps alone, without meeting the members again.  Meant for
dense ids; sparse ones are counted as exactly, in more bitmaps.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def member_bitmaps(rows: DataFrame, by: Sequence[str], member: str) -> DataFrame:
    """(by ..., bucket, members): the members of every group as bitmaps; repeated rows count once, NULL members do not."""
    known = rows.filter(F.col(member).isNotNull())
    return known.groupBy(*by, F.bitmap_bucket_number(member).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias("members"))


def rolled_up(bitmaps: DataFrame, by: Sequence[str], out: str = "members") -> DataFrame:
    """(by ..., out): distinct members per group of the coarser grouping ``by``; without ``by`` one row, 0 if there are none."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("members").alias("members"))
    counts = merged.groupBy(*by) if by else merged
    return counts.agg(F.coalesce(F.sum(F.bitmap_count("members")), F.lit(0)).alias(out))
