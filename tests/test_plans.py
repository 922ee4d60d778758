"""Plan-shape guards: properties of the physical plans that matter at scale."""

import re

import pytest

from meterbill.catalog import QUERIES
from tests.conftest import SF_SMALL


def _plan(df):
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_and_no_unplanned_nested_loop(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_needed_columns(spark):
    df = QUERIES["scan_table"](spark, SF_SMALL)
    plan = _plan(df)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == sorted(df.columns)


def test_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from meterbill.functions.predicates import like_any
    from meterbill.sources.standins import Standins
    r = Standins.of(spark, SF_SMALL).part.filter(like_any("p_name", ("cold%",)) & (F.col("p_size") > 5))
    plan = _plan(r)
    assert re.search(r"PushedFilters: \[[^\]]*StringStartsWith\(p_name,cold\)", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(p_size,5\)", plan)


def test_newest_snapshot_meets_one_row_per_shard(spark):
    """The rows are joined with per-shard maxima, which are combined before the shuffle."""
    from pyspark.sql import functions as F
    from meterbill.operators.snapshots import latest_snapshot_per_base
    df = spark.range(0, 10000).select((F.col("id") % 9).cast("int").alias("base"),
                                      (F.col("id") % 5).alias("data_my"), "id")
    plan = _plan(latest_snapshot_per_base(df))
    assert "LeftSemi" in plan and "partial_max" in plan


def test_readings_reach_the_extract_as_one_row_per_meter(spark):
    """Without broadcasts, the only exchange of the readings is the one between the partial and the final
    aggregate per meter: no raw reading is shuffled, and no window runs over them."""
    from meterbill.catalog import _extract
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _extract(spark, SF_SMALL).meter_facts(199801)._jdf.queryExecution().sparkPlan().toString()
        physical = _extract(spark, SF_SMALL).meter_facts(199801)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Window" not in plan
    lines = physical.splitlines()
    at = max(i for i, line in enumerate(lines) if "lineitem" in line and "l_quantity" in line)
    above = [line for line in lines[:at] if "Exchange" in line or "partial_max" in line]
    assert "partial_max" in above[-1] and "Exchange" in above[-2]


def test_each_shard_table_is_read_once(spark, monkeypatch):
    """Consolidation writes every shard table once, under the read cap, and works on what it wrote."""
    from meterbill.catalog import _consolidated_accounts
    from meterbill.sources import shards
    written = []
    keep = shards.to_shared_parquet
    monkeypatch.setattr(shards, "to_shared_parquet", lambda df, name: written.append((name, df.rdd.getNumPartitions())) or keep(df, name))
    plan = _plan(_consolidated_accounts(spark, SF_SMALL))
    assert [n for n, _ in written] == ["shards-nanim", "shards-dom", "shards-ulicy", "shards-city"]
    assert all(n <= shards.MAX_PARALLEL_READS for _, n in written)
    assert "orders.parquet" not in plan


def test_report_writes_every_shared_base_once(spark):
    from meterbill.functions.rules import FIXTURE
    from meterbill.plans.monthly import MonthlyStats
    from meterbill.sources.materialize import to_shared_parquet
    from meterbill.sources.standins import Standins
    names = []

    def kept(df, name):
        names.append(name)
        return to_shared_parquet(df, name)
    report = MonthlyStats(Standins.of(spark, SF_SMALL), FIXTURE, materialize=kept).report()
    assert sorted(names) == ["account_services", "meter_channels", "open_accounts", "service_keys", "valid_bindings"]
    assert report.count() > 20


def test_rows_without_a_key_are_dealt_over_the_partitions(spark):
    from pyspark.sql import functions as F

    from meterbill.plans.extract import left_join_spread
    rows = spark.range(4000).selectExpr("id", "case when id % 10 = 0 then id % 7 end as meter")
    facts = spark.createDataFrame([(i, i * 10) for i in range(5)] + [(3, 31), (None, 99)], "meter long, fact int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = left_join_spread(rows, facts.hint("merge"), "meter", "id").withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want = rows.join(facts, "meter", "left").collect()
    assert sorted((r.id, r.meter, r.fact) for r in got if r.meter is not None) == sorted((r.id, r.meter, r.fact) for r in want if r.meter is not None)
    empty = [r for r in got if r.meter is None]
    assert len(empty) == 3600 and all(r.fact is None for r in empty)
    parts = [r.part for r in empty]
    assert max(parts.count(p) for p in set(parts)) < 2000
