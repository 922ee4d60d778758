"""As-of join, meter state, membership filter, claims, sharded source, running sums and bitmaps."""

import datetime as dt
import random
import threading
import time
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterbill.operators.asof import as_of_join
from meterbill.operators.bitmaps import member_bitmaps, rolled_up
from meterbill.operators.intervals import covering_counts, running_sum
from meterbill.operators.membership import key_filter
from meterbill.operators.meter_state import MeterState
from meterbill.operators.readings import last_reading, period_volume
from meterbill.operators.snapshots import newest_rows
from meterbill.plans.tables import FrameMap, TypedTables
from meterbill.sources import sharded, versions
from meterbill.sources.claims import Claim, ClaimLost
from meterbill.sources.shards import ShardTypes, stage_shards
from meterbill.sources.sinks import full_refresh, ordered_sink, read_parts, read_target
from meterbill.sources.versions import Unpublished
from meterbill.streaming.ledger import LEDGER_SCHEMA, read_ledger, run_once_per_period

NEVER = dt.datetime(9999, 12, 31)


def hour(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


@pytest.fixture
def many_ranges(spark):
    """Range partitioning keeps its small ranges, so that keys are cut."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


# ------------------------------------------------------------------ as-of join
def brute_as_of(lookups, versions):
    out = []
    for i, o, c, at in lookups:
        valid = [(b, v is not None, v or "") for vo, vc, v, b, e in versions
                 if None not in (o, at, b, e) and vo == o and vc == c and b <= at <= e]
        out.append((i, o, c, at, (max(valid)[2] if max(valid)[1] else None) if valid else None))
    return sorted(out, key=repr)


def check_as_of(spark, lookups, versions, parts=3):
    look = spark.createDataFrame(lookups, "i int, object_id int, ch string, at timestamp").repartition(parts)
    vers = spark.createDataFrame(versions, "object_id int, ch string, value string, date_begin timestamp, date_end timestamp")
    got = as_of_join(look, vers, ("object_id", "ch"), "at")
    assert got.columns == ["i", "object_id", "ch", "at", "value"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_as_of(lookups, versions)


version = st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from(["x", "y"]), st.sampled_from(["1", "2", "30", None]),
                    st.one_of(st.none(), st.integers(0, 30)), st.integers(-2, 30))
lookup = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["x", "y"]), st.one_of(st.none(), st.integers(0, 40)))


@settings(max_examples=8, deadline=None)
@given(st.lists(lookup, max_size=25), st.lists(version, max_size=25))
def test_as_of_join_matches_definition(spark, lookups, versions):
    check_as_of(spark, [(i, o, c, hour(a)) for i, (o, c, a) in enumerate(lookups)],
                [(o, c, v, hour(b), None if b is None else hour(b + n)) for o, c, v, b, n in versions])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_of_join_of_a_hot_object_cut_into_ranges(spark, many_ranges, seed):
    """One object holds nearly all rows: nested and open versions, ties, versions that end long before a lookup."""
    rnd = random.Random(seed)
    versions = [(1, "x", f"v{n}", hour(b := rnd.randrange(4000)), hour(b + rnd.choice([0, 5, 60, 900, 9000]))) for n in range(400)]
    versions += [(1, "x", "first", hour(0), NEVER), (0, "x", "before", hour(3), NEVER), (2, "x", "after", hour(1), NEVER), (1, "y", "other", hour(9), hour(10))]
    lookups = [(i, 1, "x", hour(rnd.randrange(-5, 4200))) for i in range(1500)] + [(9000 + i, o, c, hour(7)) for i, (o, c) in enumerate([(0, "x"), (2, "x"), (1, "y"), (3, "x")])]
    check_as_of(spark, lookups, versions)


def test_as_of_join_has_no_window_and_cuts_the_key(spark, many_ranges):
    look = spark.range(20000).select(F.lit(1).alias("o"), F.timestamp_seconds(F.col("id") * 60).alias("at"), "id")
    vers = spark.range(2000).select(F.lit(1).alias("o"), F.col("id").cast("string").alias("value"), F.timestamp_seconds(F.col("id") * 600).alias("date_begin"),
                                    F.timestamp_seconds(F.col("id") * 600 + 599).alias("date_end"))
    kept = []
    out = as_of_join(look, vers, ["o"], "at", materialize=lambda df, name: kept.append(df) or __import__(
        "meterbill.sources.materialize", fromlist=["x"]).to_shared_parquet(df, name))
    plan = kept[0]._jdf.queryExecution().toString() + out._jdf.queryExecution().toString()
    assert "Window" not in plan and "rangepartitioning(_k0" in plan
    assert out.filter(F.col("value").cast("long") != F.floor(F.col("id") / 10)).count() == 0
    assert kept[0].groupBy("_range").count().filter("count > 500").count() >= 3        # one key, several ranges


def test_as_of_join_of_dates_and_clashing_columns(spark):
    look = spark.createDataFrame([(1, dt.date(2024, 1, 2), "keep"), (1, dt.date(2023, 1, 1), "k2"), (1, None, "k3")], "o int, at date, date_begin string")
    vers = spark.createDataFrame([(1, 5.0, dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "o long, value double, date_begin date, date_end date")
    got = sorted(map(tuple, as_of_join(look, vers, ["o"], "at", out="x").collect()), key=repr)
    assert got == sorted([(1, dt.date(2024, 1, 2), "keep", 5.0), (1, dt.date(2023, 1, 1), "k2", None), (1, None, "k3", None)], key=repr)


# ------------------------------------------------------------------ meter state
READINGS = "cd_cntr_kid int, bl_bill_id int, date_ind_take date, cd_ind_id int, value double, cd_indic_src_id string"
D0 = dt.date(2024, 1, 1)


def reading_rows(seed, n=300):
    rnd = random.Random(seed)
    return [(rnd.randrange(40), rnd.choice([202401, 202402, 202403]), D0 + dt.timedelta(days=rnd.randrange(60)), i, float(rnd.randrange(50)), rnd.choice("AB"))
            for i in range(n)]


def test_state_after_merges_equals_one_pass(spark, tmp_path):
    rows = reading_rows(1)
    whole = spark.createDataFrame(rows, READINGS)
    state = MeterState(spark, str(tmp_path / "state"), buckets=8)
    wrong = [r for r in rows if r[1] == 202402 and r[0] % 4 == 0]
    # a value too large, a date too late and a reading that never was
    told_wrong = [(m, p, d + dt.timedelta(days=90), i, v + 1000, s) for m, p, d, i, v, s in wrong] + [(4, 202402, D0 + dt.timedelta(days=300), 999, 1.0, "A")]
    state.merge(spark.createDataFrame([r for r in rows if r[1] == 202401 and r[3] % 3], READINGS))
    state.merge(spark.createDataFrame([r for r in rows if r[1] == 202402 and r[0] % 4] + told_wrong, READINGS))
    state.merge(spark.createDataFrame([r for r in rows if r[1] == 202403 or r[1] == 202401 and r[3] % 3 == 0], READINGS))       # late ones too
    state.merge(spark.createDataFrame([r for r in rows if r[1] == 202403][:20], READINGS))                                     # delivered twice
    pairs = spark.createDataFrame(sorted({(m, p) for m, p, *_ in wrong} | {(4, 202402)}), "cd_cntr_kid int, bl_bill_id int")
    state.merge(spark.createDataFrame(wrong, READINGS), corrected=pairs)
    order = ("date_ind_take", "cd_ind_id")
    assert sorted(map(tuple, state.volumes().collect()), key=repr) == sorted(map(tuple, period_volume(whole, order=order).collect()), key=repr)
    want = last_reading(whole, order=order).select("cd_cntr_kid", "cd_ind_id", "value", "cd_indic_src_id")
    assert sorted(map(tuple, state.last().select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_merge_leaves_other_buckets_where_they_are(spark, tmp_path):
    state = MeterState(spark, str(tmp_path / "state"), buckets=8)
    first = state.merge(spark.createDataFrame(reading_rows(2), READINGS))
    before = state.manifest()
    assert set(before.values()) == {first} and len(before) > 4
    second = state.merge(spark.createDataFrame([(7, 202404, D0, 5000, 1.0, "A")], READINGS))
    changed = {b for b, v in state.manifest().items() if before.get(b) != v}
    assert len(changed) == 1 and {state.manifest()[b] for b in changed} == {second}
    assert state.merge(spark.createDataFrame([], READINGS)) is None and state.manifest()[next(iter(changed))] == second


def test_state_before_a_merge_and_after_a_withdrawal(spark, tmp_path):
    state = MeterState(spark, str(tmp_path / "state"), buckets=4)
    with pytest.raises(Unpublished):
        state.volumes()
    state.merge(spark.createDataFrame([(1, 202401, D0, 1, 5.0, "A"), (2, 202401, D0, 2, 6.0, "A")], READINGS))
    state.merge(spark.createDataFrame([], READINGS), corrected=spark.createDataFrame([(1, 202401)], "cd_cntr_kid int, bl_bill_id int"))
    assert [r.cd_cntr_kid for r in state.last().collect()] == [2]


def test_of_two_merges_at_once_one_is_published(spark, tmp_path, monkeypatch):
    state = MeterState(spark, str(tmp_path / "state"), buckets=4)
    batch = spark.createDataFrame(reading_rows(3, 5), READINGS)
    keep = MeterState._last

    def overtaken(self, readings):
        monkeypatch.setattr(MeterState, "_last", keep)
        state.merge(batch)          # another run merges and ends in between
        return keep(self, readings)

    monkeypatch.setattr(MeterState, "_last", overtaken)
    with pytest.raises(versions.PublishConflict):
        state.merge(spark.createDataFrame([(99, 202409, D0, 7000, 1.0, "A")], READINGS))
    assert state.last().filter("cd_cntr_kid = 99").count() == 0 and len(versions.numbers(spark, state.path)) == 1


# ------------------------------------------------------------------ membership
def test_key_filter_keeps_every_wanted_key_and_few_others(spark):
    wanted = spark.range(0, 300000, 300).select((F.col("id") - 7).alias("k")).union(spark.createDataFrame([(None,)], "k long"))
    rows = spark.range(-10, 300000).select(F.col("id").cast("int").alias("k"))
    passed = rows.filter(key_filter(wanted)("k"))
    assert passed.join(wanted, "k", "left_semi").count() == 1000
    assert passed.count() < 2000
    assert rows.filter(key_filter(wanted.filter("k is null"))("k")).count() == 0
    assert rows.filter(key_filter(wanted, bits=64)("k")).join(wanted, "k", "left_semi").count() == 1000    # far too small: lets all through


def test_whitelisted_extract_aggregates_readings_of_its_meters_only(spark, monkeypatch):
    from meterbill import catalog
    from meterbill.plans import extract
    from tests.conftest import SF_SMALL
    seen = []
    keep = extract.meter_summary
    monkeypatch.setattr(extract, "meter_summary", lambda readings, *a, **k: seen.append(readings) or keep(readings, *a, **k))
    catalog.QUERIES["meter_extract"](spark, SF_SMALL)
    catalog.QUERIES["meter_extract_whitelisted"](spark, SF_SMALL)
    everything, wanted = (r.count() for r in seen)
    assert 0 <= wanted < everything / 20
    plan = seen[1]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0]


# ------------------------------------------------------------------ claims
def periods_of(spark):
    return spark.createDataFrame([(202402, D0, "P2", "O")], "bl_bill_id long, bill_date date, bill_name string, period_status string")


def test_two_schedulers_at_once_one_works(spark, tmp_path):
    ledger, inside, go, out = str(tmp_path / "ledger"), threading.Event(), threading.Event(), {}
    periods = periods_of(spark)

    def work(period):
        inside.set()
        go.wait(60)

    first = threading.Thread(target=lambda: out.setdefault("first", run_once_per_period(periods, ledger, "job", work)))
    first.start()
    assert inside.wait(60)
    out["second"] = run_once_per_period(periods, ledger, "job", lambda p: pytest.fail("both work"))
    out["other job"] = run_once_per_period(periods, ledger, "job 2/x", lambda p: None)
    go.set()
    first.join()
    assert out == {"first": 202402, "second": None, "other job": 202402}
    assert run_once_per_period(periods, ledger, "job", lambda p: pytest.fail("again")) is None
    assert sorted(map(tuple, read_ledger(spark, ledger).collect())) == [("job", 202402), ("job 2/x", 202402)]


def test_claim_of_a_dead_run_is_taken_over_and_the_late_one_appends_nothing(spark, tmp_path):
    ledger, periods = str(tmp_path / "ledger"), periods_of(spark)

    def overtaken(period):
        time.sleep(0.3)       # longer than the claim lasts: another run takes the period over and ends
        assert run_once_per_period(periods, ledger, "job", lambda p: None, stale_after=0.1) == 202402

    with pytest.raises(ClaimLost):
        run_once_per_period(periods, ledger, "job", overtaken, stale_after=0.1)
    assert spark.read.schema(LEDGER_SCHEMA).parquet(ledger).count() == 1


def test_only_one_of_many_takes_a_claim(spark, tmp_path):
    for stale in (False, True):
        path = f"{tmp_path}/claim-{stale}"
        if stale:
            assert Claim(spark, path, 0).take()
            time.sleep(0.05)
        claims = [Claim(spark, path, 0.01 if stale else 60) for _ in range(8)]
        won = []
        threads = [threading.Thread(target=lambda c=c: won.append(c.take())) for c in claims]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert sum(c.held() for c in claims) == 1 and sum(won) >= 1
        if not stale:
            assert sum(won) == 1


# ------------------------------------------------------------------ shards
def test_newest_rows_prune_partitions_at_run_time(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    spark.range(90).select("id", (F.col("id") % 3).cast("int").alias("base"), F.date_add(F.lit(D0), (F.col("id") % 5).cast("int")).alias("data_my")) \
        .write.partitionBy("base", "data_my").parquet(path)
    df = newest_rows(spark.read.parquet(path).filter("base = 1"))
    rows = df.collect()
    assert {r.data_my for r in rows} == {D0 + dt.timedelta(days=4)} and len(rows) == 6
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(base" in plan and "data_my" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "ubquery" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    files = [scans.apply(i).metrics().apply("numFiles").value() for i in range(scans.size())] if scans.apply(0).metrics().contains("numFiles") else [0]
    assert all(f <= 12 for f in files)


def test_only_the_newest_snapshot_is_staged(spark):
    def read(base):
        return {"nanim": spark.createDataFrame([(base, D0, 1), (base + 1, D0 + dt.timedelta(days=base), 2), (base + 2, D0, 3)], "lic int, data_my date, other int")}
    staged, bases = stage_shards(read, (15, 20), ("nanim",), newest={"nanim": "data_my"}, columns={"nanim": ("lic", "data_my")})
    assert bases == [15, 20] and staged["nanim"].columns == ["lic", "data_my", "base"]
    assert sorted((r.base, r.lic) for r in staged["nanim"].collect()) == [(15, 16), (20, 21)]


def test_shards_of_other_types_and_programming_errors_are_no_missing_shards(spark):
    def read(base):
        if base == 27:
            raise OSError("no route to host")
        return {"nanim": spark.range(2).select(F.col("id").cast("long" if base == 15 else "string").alias("lic"))}
    with pytest.raises(ShardTypes, match="shard 20"):
        stage_shards(read, (15, 20), ("nanim",))
    assert stage_shards(read, (15, 27), ("nanim",))[1] == [15]
    with pytest.raises(KeyError):
        stage_shards(lambda b: {}["nanim"], (15,), ("nanim",))


SHARD = "base int, ls long, fio string, data_my date"


def shard_folders(spark, tmp_path, bases):
    rows = [(b, b * 100 + i, f"n{i}", D0 + dt.timedelta(days=i % 3 + b % 2)) for b in bases for i in range(7)]
    spark.createDataFrame(rows, SHARD).write.partitionBy("base").parquet(str(tmp_path / "s"))
    return rows, str(tmp_path / "s") + "/base={base}"


def test_sharded_source_reads_filters_and_prunes(spark, tmp_path):
    rows, path = shard_folders(spark, tmp_path, (1, 2, 3, 4, 5, 6))
    sharded.register(spark)
    load = lambda **o: spark.read.format("shards").schema(SHARD).options(path=path, bases="1,2,3,4,5,6", **o).load()
    assert sorted(map(tuple, load().collect())) == sorted(rows)
    assert load().rdd.getNumPartitions() == 4 and load(lanes="2").rdd.getNumPartitions() == 2
    got = load().filter("base in (2, 5) and ls > 203 and fio is not null and length(fio) = 2")
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] in (2, 5) and r[1] > 203)
    top = {b: max(r[3] for r in rows if r[0] == b) for b in range(1, 7)}
    assert sorted(map(tuple, load(newest="data_my").collect())) == sorted(r for r in rows if r[3] == top[r[0]])
    # the newest snapshot of the shard, not of the rows that pass
    assert sorted(map(tuple, load(newest="data_my").filter("fio = 'n0'").collect())) == sorted(r for r in rows if r[3] == top[r[0]] and r[2] == "n0")


def counting_opener(base, columns, filters, options):
    """A shard that notes in files who is open at the same time."""
    import os
    import pyarrow as pa
    me = f"{options['path']}/{base}"
    open(me, "w").close()
    now = len([f for f in os.listdir(options["path"]) if "." not in f])
    time.sleep(0.4)
    os.rename(me, f"{me}.{now}")
    yield pa.RecordBatch.from_arrays([pa.array([base], pa.int64())], names=["ls"])


def test_a_fifth_reader_never_opens(spark, tmp_path):
    import os
    sharded.register(spark)
    source = (spark.read.format("shards").schema("base int, ls long")
              .options(path=str(tmp_path), opener="tests.test_state_and_shards:counting_opener", lanes="3").load())
    assert source.repartition(16).groupBy("base").count().count() == 9        # whatever the plan above
    seen = [int(f.split(".")[1]) for f in os.listdir(tmp_path)]
    assert len(seen) == 9 and 1 < max(seen) <= 3


def test_a_shard_with_another_type_fails_by_name(spark, tmp_path):
    spark.range(3).select(F.col("id").alias("ls")).write.parquet(str(tmp_path / "1"))
    spark.range(3).select(F.col("id").cast("double").alias("ls")).write.parquet(str(tmp_path / "2"))
    spark.range(3).select(F.col("id").alias("other")).write.parquet(str(tmp_path / "3"))
    sharded.register(spark)
    load = lambda bases: spark.read.format("shards").schema("base int, ls long").options(path=str(tmp_path) + "/{base}", bases=bases).load()
    assert load("1").count() == 3
    with pytest.raises(Exception, match="ls of shard 2 is double"):
        load("1,2").collect()
    with pytest.raises(Exception, match="shard 3 has no column ls"):
        load("1,3").collect()


# ------------------------------------------------------------------ flags, targets, sums, bitmaps
@pytest.mark.parametrize("kind,good,bad", [("decimal(38,10)", ["0", "1", None], "0.5"), ("double", ["0", "1", None], "1.5"), ("boolean", ["false", "true", None], None),
                                           ("bigint", ["0", "1", None], "5000000000"), ("float", ["1", "0", None], "NaN"), ("smallint", ["1", "0", None], None)])
def test_flags_of_every_type_become_integers(spark, kind, good, bad):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(good)], "id int, v string").select("id", F.col("v").cast(kind).alias("is_active"))
    typed = TypedTables(FrameMap({"t": rows}))["t"]
    assert dict(typed.dtypes)["is_active"] == "int"
    assert [r.is_active for r in typed.orderBy("id").collect()] == [None if g is None else int(g in ("1", "true")) for g in good]
    if bad:
        more = rows.union(spark.createDataFrame([(9, bad)], "id int, v string").select("id", F.col("v").cast(kind)))
        with pytest.raises(Exception, match="is no flag"):
            TypedTables(FrameMap({"t": more}))["t"].collect()


def test_an_unpublished_target_is_named(spark, tmp_path):
    with pytest.raises(Unpublished, match="nothing was published"):
        read_target(spark, str(tmp_path / "none"))
    with pytest.raises(Unpublished), versions.pinned(spark, str(tmp_path / "none")):
        pass


def test_a_racing_publisher_follows_or_fails(spark, tmp_path):
    path = str(tmp_path / "target")
    assert full_refresh(spark.range(3), path) == 1
    with pytest.raises(versions.PublishConflict):
        versions.publish(spark, path, {"folders": ["late"]}, 0)
    results = []
    threads = [threading.Thread(target=lambda i=i: results.append(full_refresh(spark.range(i), path))) for i in (4, 5, 6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(results) == [2, 3, 4] and versions.numbers(spark, path) == [1, 2, 3, 4]
    assert read_target(spark, path).count() in (4, 5, 6)


def test_a_pinned_version_outlives_a_publish_and_retention(spark, tmp_path):
    path = str(tmp_path / "target")
    for n in (1, 2, 3):
        full_refresh(spark.range(n), path)
    with versions.pinned(spark, path) as seen:
        for n in (4, 5, 6):
            full_refresh(spark.range(n), path)
        assert versions.expire(spark, path, keep=2) == []                              # all of them young
        assert versions.expire(spark, path, keep=2, older_than=0) == [1, 2, 4]
        assert read_target(spark, path, manifest=seen).count() == 3 and read_target(spark, path).count() == 6
    assert versions.expire(spark, path, keep=1, older_than=0) == [3, 5]
    assert versions.numbers(spark, path) == [6] and read_target(spark, path).count() == 6
    import os
    assert len([f for f in os.listdir(path) if f.startswith("v-")]) == 1


def test_retention_spares_folders_that_newer_state_versions_use(spark, tmp_path):
    state = MeterState(spark, str(tmp_path / "state"), buckets=8)
    state.merge(spark.createDataFrame(reading_rows(2), READINGS))
    for i in range(3):
        state.merge(spark.createDataFrame([(7, 202404 + i, D0, 5000 + i, 1.0, "A")], READINGS))
    before = sorted(map(tuple, state.last().collect()))
    assert versions.expire(spark, state.path, keep=1, older_than=0) == [1, 2, 3]
    assert sorted(map(tuple, state.last().collect())) == before


def test_ordered_report_parts_give_the_report_order(spark, tmp_path, many_ranges):
    rnd = random.Random(8)
    rows = [(rnd.randrange(500), rnd.choice([None, 'say "hi"', "a,b", "two\nlines", "plain"]), rnd.random()) for _ in range(1000)]
    df = spark.createDataFrame(rows, "k int, t string, v double")
    report = df.orderBy("k", F.col("t").asc_nulls_last(), "v")
    path = str(tmp_path / "report")
    ordered_sink(report, path)
    parts = read_parts(spark, path, df.schema)
    assert len(parts) > 2
    got = [tuple(r) for p in parts for r in p.coalesce(1).collect()]
    assert got == [tuple(r) for r in report.collect()]


def test_running_sum_uses_several_tasks_for_one_month(spark, many_ranges):
    rows = spark.range(100000).select(F.timestamp_seconds(F.col("id") * 20).alias("t"), (F.col("id") % 7 - 3).alias("n"))
    kept = []
    from meterbill.sources.materialize import to_shared_parquet
    out = running_sum(rows, ("t",), "n", materialize=lambda df, name: kept.append(to_shared_parquet(df, name)) or kept[0])
    want, total = {}, 0
    for i in range(100000):
        total += i % 7 - 3
        want[i * 20] = total
    assert {r.s: r.total for r in out.select(F.unix_seconds("t").alias("s"), "total").collect()} == want
    sizes = [r["count"] for r in kept[0].groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 50000


def test_covering_counts_of_timestamps_in_one_month(spark, many_ranges):
    rnd = random.Random(3)
    ivs = [(hour(b := rnd.randrange(700)) + dt.timedelta(seconds=rnd.randrange(3600)), hour(b + rnd.randrange(40))) for _ in range(300)]
    pts = [(i, hour(rnd.randrange(700)) + dt.timedelta(seconds=rnd.randrange(3600))) for i in range(200)]
    got = covering_counts(spark.createDataFrame(ivs, "date_begin timestamp, date_end timestamp"), spark.createDataFrame(pts, "i int, at timestamp"), "at", out="n")
    want = {i: n for i, p in pts if (n := sum(b <= p <= e for b, e in ivs))}
    assert {r.i: r.n for r in got.collect()} == want


def test_bitmaps_count_distinct_members_of_any_grouping(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([1, 2]), rnd.choice("abc"), rnd.choice([None, 0, -1, rnd.randrange(200), rnd.randrange(10**9)])) for _ in range(500)]
    bitmaps = member_bitmaps(spark.createDataFrame(rows, "p int, ch string, m long"), ("p", "ch"), "m")
    for by in ((), ("p",), ("ch",), ("p", "ch")):
        want = defaultdict(set)
        for p, ch, m in rows:
            if m is not None:
                want[tuple({"p": p, "ch": ch}[b] for b in by)].add(m)
        assert {tuple(r)[:-1]: r.members for r in rolled_up(bitmaps, by).collect()} == {k: len(v) for k, v in want.items()}
    assert rolled_up(bitmaps.filter("p = 3"), ()).first().members == 0
