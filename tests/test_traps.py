"""One test per semantic trap of the billing SQL (literal rows)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterbill.functions.predicates import flag_is, like_any, valid_at
from meterbill.functions.text import (FIXTURE_FIREBIRD_LABELS, FIXTURE_ORACLE_LABELS,
                                      address_null_as_empty, address_null_propagating,
                                      concat_null_as_empty, concat_null_propagating)
from meterbill.operators.attributes import attribute_as_of, characteristic_id
from meterbill.operators.periods import current_period, period_gate
from meterbill.operators.readings import last_reading, latest_max_reading, period_volume
from meterbill.operators.snapshots import (IncompleteShards, assert_complete,
                                           latest_snapshot_per_base, missing_bases)
from meterbill.plans.extract import rendered_addresses, whitelist_frame
from meterbill.plans.tables import FrameMap
from tests.conftest import SF_SMALL

D = dt.date


def test_t1_oracle_concat_null_is_empty(spark):
    df = spark.createDataFrame([(None, None, None, None, 5, None, None, None)],
                               "tn string, tt string, sn string, st string, h int, k int, b int, f int")
    addr = address_null_as_empty(*[F.col(c) for c in df.columns], labels=FIXTURE_ORACLE_LABELS)
    assert df.select(addr).first()[0] == "City , d. 5"
    # all parts NULL -> NULL, like the source database's empty string
    assert df.select(concat_null_as_empty(F.col("tn"), F.col("sn"))).first()[0] is None


def test_t2_firebird_concat_propagates(spark):
    schema = "city string, street string, dom string, dom2 string, korp string, kv int, kv2 string"
    rows = [(None, "Main", "5", None, None, 1, None),      # unmatched city -> NULL
            ("Oak", "Main", "5", None, None, None, None),  # NULL flat -> NULL
            ("", "Main", "5", None, None, 0, None),        # empty city, flat 0
            ("Oak", "Main", "5", "a", "2", 3, "b")]
    df = spark.createDataFrame(rows, schema)
    addr = address_null_propagating(*[F.col(c) for c in df.columns], labels=FIXTURE_FIREBIRD_LABELS)
    got = [r[0] for r in df.select(addr).collect()]
    assert got[0] is None and got[1] is None
    assert got[2] == "c. Town, st. Main, h. 5"
    assert got[3] == "c. Town (Oak), st. Main, h. 5a k. 2, f. 3b"
    assert df.select(concat_null_propagating(F.lit("a"), F.col("dom2"))).first()[0] is None


def test_t3_section_rows_are_null(spark):
    from meterbill.catalog import QUERIES
    from meterbill.functions.rules import SECTION_SEQS
    rows = QUERIES["monthly_report"](spark, SF_SMALL).collect()
    for r in rows:
        if r.seq in SECTION_SEQS:
            assert r.value is None
        else:
            assert r.value is not None or r.seq == 1


def test_t4_null_counts_once_in_distinct(spark):
    from meterbill.plans.monthly import MonthlyStats
    from meterbill.functions.rules import FIXTURE
    t = _world(spark, houses=[1, None, None])
    got = MonthlyStats(t, FIXTURE).houses().first()
    assert got["M06"] == 2  # house 1 and the NULL house
    df = spark.createDataFrame([(1,), (None,), (None,)], "x int")
    assert df.agg(F.count_distinct("x")).first()[0] == 1


def test_t6_latest_is_not_row_number(spark):
    schema = "cd_cntr_kid int, bl_bill_id int, date_ind_take date, value double, cd_indic_src_id string"
    newest_not_largest = spark.createDataFrame(
        [(1, 1, D(2024, 1, 1), 10.0, "A"), (1, 1, D(2024, 1, 2), 7.0, "A")], schema)
    assert latest_max_reading(newest_not_largest).count() == 0
    tie = spark.createDataFrame([(1, 1, D(2024, 1, 2), 10.0, "A"), (1, 1, D(2024, 1, 2), 10.0, "B")], schema)
    assert latest_max_reading(tie).count() == 2
    nulls = spark.createDataFrame([(1, 1, None, 10.0, "A")], schema)
    assert latest_max_reading(nulls).count() == 0


def test_last_reading_and_volume(spark):
    schema = "cd_cntr_kid int, bl_bill_id int, date_ind_take date, value double, cd_indic_src_id string"
    df = spark.createDataFrame([(1, 202401, D(2024, 1, 5), 10.0, "A"), (1, 202401, D(2024, 1, 9), 12.0, "A"),
                                (1, 202403, D(2024, 3, 2), 20.0, "B"), (2, 202403, D(2024, 3, 1), 5.0, "A")],
                               schema)
    last = {r.cd_cntr_kid: r.value for r in last_reading(df).collect()}
    assert last == {1: 20.0, 2: 5.0}
    vol = {(r.cd_cntr_kid, r.bl_bill_id): r.volume for r in period_volume(df).collect()}
    assert vol == {(1, 202401): None, (1, 202403): 8.0, (2, 202403): None}


def test_t8_like_rules_case_sensitive(spark):
    df = spark.createDataFrame([("Hot water",), ("hot water",), ("cold for hot",)], "name string")
    got = [r[0] for r in df.filter(like_any("name", ("%hot%",))).collect()]
    assert sorted(got) == ["cold for hot", "hot water"]
    assert df.filter(like_any("name", ("hot%",))).count() == 1


def test_t9_timestamp_after_midnight_is_outside(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 15)), (D(2024, 1, 1), D(2024, 1, 16))],
                               "date_begin date, date_end date")
    got = [r[0] for r in df.select(valid_at(dt.datetime(2024, 1, 15, 12, 0))).collect()]
    assert got == [False, True]
    assert df.filter(valid_at(dt.date(2024, 1, 15))).count() == 2


def test_t11_no_closed_period_gives_zero_counts(spark):
    from meterbill.functions.rules import FIXTURE
    from meterbill.plans.monthly import MonthlyStats
    from meterbill.sources.standins import Standins
    st = Standins(spark, SF_SMALL)
    frames = {n: st[n] for n in st.names}
    frames["bl_bill_periods"] = st.bl_bill_periods.withColumn("period_status", F.lit("O"))
    rows = MonthlyStats(FrameMap(frames), FIXTURE).report().collect()
    values = {r.seq: r.value for r in rows if r.seq not in (1, 2, 5, 7, 9, 16, 17, 22)}
    assert set(values.values()) == {"0"}
    assert not [r for r in rows if r.seq == 7]
    assert [r.value for r in rows if r.seq == 1] == [None]


def test_t12_newest_snapshot_is_per_shard(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), 1), (1, D(2024, 2, 1), 2), (2, D(2024, 1, 1), 3)],
                               "base int, data_my date, ls int")
    got = sorted(r.ls for r in latest_snapshot_per_base(df).collect())
    assert got == [2, 3]


def test_t13_whitelist_duplicates_do_not_multiply(spark):
    from meterbill.catalog import _extract
    ex = _extract(spark, SF_SMALL)
    first = ex.rows().filter(F.col("h_hos_id").isNotNull()).first()
    pair_once = ((first.contract_nmbr, (first.h_hos_id,)),)
    pair_twice = ((first.contract_nmbr, (first.h_hos_id, first.h_hos_id)),) * 2
    assert whitelist_frame(spark, pair_twice).count() == 1
    assert ex.rows(pair_twice).count() == ex.rows(pair_once).count() > 0


def test_t14_missing_shard_keeps_the_old_target(spark, tmp_path):
    from meterbill.catalog import _shard_reader
    from meterbill.functions.text import FIXTURE_FIREBIRD_LABELS
    from meterbill.plans.consolidate import refresh_target
    from meterbill.sources.shards import BASES
    from meterbill.sources.sinks import read_target
    from meterbill.sources.standins import Standins
    status = spark.createDataFrame([(15, 0), (20, 2)], "base int, rows int")
    assert [r[0] for r in missing_bases(status, (15, 20, 27)).collect()] == [27]   # 15 has no rows, but was read
    assert_complete([15, 20], (15, 20))
    with pytest.raises(IncompleteShards):
        assert_complete([15, 20, 99], (15, 20))
    same = _shard_reader(Standins.of(spark, SF_SMALL))
    target = str(tmp_path / "target")
    refresh_target(same, BASES, FIXTURE_FIREBIRD_LABELS, target)
    before = read_target(spark, target).count()

    def broken(b):
        if b == 29:
            raise ConnectionError("no route to shard")
        return same(b)
    with pytest.raises(IncompleteShards):
        refresh_target(broken, BASES, FIXTURE_FIREBIRD_LABELS, target)
    assert read_target(spark, target).count() == before > 0


def test_t5_flags_are_integers_whatever_the_source_says(spark):
    from meterbill.plans.tables import TypedTables
    rows = spark.createDataFrame([(1, "1"), (2, " 0 "), (3, None)], "id int, is_active string")
    typed = TypedTables(FrameMap({"t": rows}))
    assert dict(typed["t"].dtypes)["is_active"] == "int"
    assert [r.id for r in typed.t.filter(flag_is("is_active")).collect()] == [1]
    assert typed["t"].filter("is_active is null").count() == 1
    with pytest.raises(Exception, match="is no flag"):
        TypedTables(FrameMap({"t": rows.union(spark.createDataFrame([(4, "Y")], "id int, is_active string"))}))["t"].collect()


def test_t10_failed_work_is_tried_again(spark, tmp_path):
    from meterbill.streaming.ledger import run_once_per_period
    periods = spark.createDataFrame([(202402, D(2024, 2, 1), "P2", "O")],
                                    "bl_bill_id long, bill_date date, bill_name string, period_status string")

    def fail(period):
        raise RuntimeError("report failed")
    ledger, calls = str(tmp_path / "ledger"), []
    with pytest.raises(RuntimeError):
        run_once_per_period(periods, ledger, "job", fail)
    assert run_once_per_period(periods, ledger, "job", calls.append) == 202402 and calls == [202402]


def _catalogue(spark, rows):
    return FrameMap({"cn_char_type": spark.createDataFrame([(1, "object"), (2, "other")], "char_type_id int, name string"),
                     "cn_chrctrstc_group": spark.createDataFrame([(10, 1), (20, 2)], "cn_chrctrstc_group_id int, char_type_id int"),
                     "cn_characteristic_ref": spark.createDataFrame(rows, "cn_chrct_id string, code string, name string, cn_chrctrstc_group_id int")})


def test_catalogue_lookup_needs_type_code_and_name(spark):
    cat = _catalogue(spark, [("right", "X", "n", 10), ("wrong", "X", "other name", 10), ("zz", "X", "n", 20), ("zy", "Y", "n", 10)])
    one = spark.range(1)
    assert one.select(characteristic_id(cat, "object", "X", "n")).first()[0] == "right"
    assert one.select(characteristic_id(cat, "object", "X")).first()[0] == "wrong"
    assert one.select(characteristic_id(cat, "object", "Z", "n")).first()[0] is None


def test_last_reading_of_a_day_is_the_one_with_the_greater_id(spark):
    from meterbill.operators.readings import READING_ORDER, meter_summary
    rows = [(100, 1, 202401, D(2024, 1, 5), 9.0, "a"), (101, 1, 202401, D(2024, 1, 5), 3.0, "b"), (99, 1, 202312, D(2023, 12, 5), 1.0, "a")]
    df = spark.createDataFrame(rows, "cd_ind_id int, cd_cntr_kid int, bl_bill_id int, date_ind_take date, value double, cd_indic_src_id string")
    r = meter_summary(df, 202401, order=READING_ORDER).first()
    assert (r.value, r.cd_indic_src_id, r.volume) == (3.0, "b", 2.0)


def test_extract_order_puts_nulls_last_and_now_is_fixed(spark):
    from meterbill.catalog import _extract
    from meterbill.functions.rules import FIXTURE
    from meterbill.plans.extract import MeterExtract
    from meterbill.sources.standins import Standins
    ex = _extract(spark, SF_SMALL)
    rows = [(r.contract_nmbr, r.cntr_contract_key_id, r.address) for r in ex.rows().collect()]
    want = sorted(rows, key=lambda r: [(x is None, x) for x in r])
    number, address = ex.report().columns[0], ex.report().columns[3]
    assert [(r[number], r[address]) for r in ex.report().collect()] == [(a, c) for a, _, c in want]
    plan = ex.report()._jdf.queryExecution().optimizedPlan().toString()
    assert "NULLS LAST" in plan and "NULLS FIRST" not in plan.split("Sort")[1].split("\n")[0]
    now = MeterExtract(Standins.of(spark, SF_SMALL), FIXTURE, FIXTURE_ORACLE_LABELS)
    assert "current_timestamp" not in now.as_of._jc.toString()


def test_t16_town_name_and_type_coalesce_independently(spark):
    t = FrameMap({
        "ns_address": spark.createDataFrame([(1, 10, None)], "ns_adr_id long, ns_hos_id long, flat long"),
        "ns_house": spark.createDataFrame([(10, 10, None, None, 7, 2)],
                                          "ns_hos_id long, house long, corpus long, building long, "
                                          "ns_strt_id long, ns_twn_id long"),
        "ns_street": spark.createDataFrame([(7, "Main", 1, 1)],
                                           "ns_strt_id long, name string, ns_strttyp_id int, ns_twn_id long"),
        "ns_street_type": spark.createDataFrame([(1, "st.")], "ns_strttyp_id int, short_name string"),
        # the town via the street has a name but no type row; the house's town has a type
        "ns_town": spark.createDataFrame([(1, "Oak", 9), (2, "Elm", 1)],
                                         "ns_twn_id long, name string, ns_twntyp_id int"),
        "ns_town_type": spark.createDataFrame([(1, "t.")], "ns_twntyp_id int, short_name string"),
    })
    r = rendered_addresses(t, FIXTURE_ORACLE_LABELS).first()
    assert (r.town_name, r.town_type) == ("Oak", "t.")
    assert r.address == "t. Oak, st. Main, d. 10"


def test_t17_catalogue_duplicates_stay_scalar(spark):
    cat = _catalogue(spark, [("a", "X", "n", 10), ("b", "X", "n", 10)])
    attrs = spark.createDataFrame([(1, "b", "5", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)),
                                   (1, "b", "6", dt.datetime(2024, 1, 10), dt.datetime(2024, 2, 1))],
                                  "object_id int, cn_chrct_id string, value string, "
                                  "date_begin timestamp, date_end timestamp")
    ch = characteristic_id(cat, "object", "X")
    got = attribute_as_of(attrs, ch, dt.datetime(2024, 1, 15)).collect()
    assert [(r.object_id, r.value) for r in got] == [(1, "6")]  # newest version wins


def test_gate_once_per_period(spark, tmp_path):
    from meterbill.streaming.ledger import LEDGER_SCHEMA, run_once_per_period
    periods = spark.createDataFrame([(202401, D(2024, 1, 1), "P1", "C"), (202402, D(2024, 2, 1), "P2", "O")],
                                    "bl_bill_id long, bill_date date, bill_name string, period_status string")
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    assert [tuple(r) for r in period_gate(periods, empty, "job").collect()] == [("job", 202402)]
    done = spark.createDataFrame([("job", 202402), ("other", 1)], LEDGER_SCHEMA)
    assert period_gate(periods, done, "job").count() == 0
    assert current_period(periods, "C").first().bl_bill_id == 202401
    ledger = str(tmp_path / "ledger")
    calls = []
    assert run_once_per_period(periods, ledger, "job", calls.append) == 202402
    assert run_once_per_period(periods, ledger, "job", calls.append) is None
    assert calls == [202402]


def _world(spark, houses):
    """A minimal billing world: one open account per house id, all services cold."""
    n = len(houses)
    per = spark.createDataFrame([(202401, D(2024, 1, 1), "P1", "C")],
                                "bl_bill_id long, bill_date date, bill_name string, period_status string")
    fa = spark.createDataFrame([(i, i, i, 1, None, D(2020, 1, 1), D(9999, 12, 31)) for i in range(n)],
                               "us_flat_account_kid long, num_account long, tu_rlty_kid long, is_active int, "
                               "us_baseclose_doc_id long, date_begin date, date_end date")
    rk = spark.createDataFrame([(i, i, "HOUSEHOLD") for i in range(n)],
                               "tu_rlty_kid long, ns_adr_id long, tu_rlty_spcs_id string")
    ref = spark.createDataFrame([("HOUSEHOLD", "HOUSEHOLD")], "tu_rlty_spcs_id string, name string")
    na = spark.createDataFrame([(i, h, None) for i, h in enumerate(houses)],
                               "ns_adr_id long, ns_hos_id long, flat long")
    ck = spark.createDataFrame([(i, i, i) for i in range(n)],
                               "cntr_contract_key_id long, us_account_id long, us_counteragent_id long")
    sk = spark.createDataFrame([(i, i, 1, i) for i in range(n)],
                               "cntr_service_key_id long, cntr_contract_key_id long, ns_svc_id long, "
                               "tu_rlty_kid long")
    svc = spark.createDataFrame([(1, "cold water")], "ns_svc_id long, name string")
    b = spark.createDataFrame([(i, 1, 1, D(2020, 1, 1), D(9999, 12, 31)) for i in range(n)],
                              "us_cntr_svc_id long, cd_cntr_kid long, is_active int, date_begin date, "
                              "date_end date")
    return FrameMap({"bl_bill_periods": per, "us_flat_account_ver": fa, "tu_realty_key": rk,
                     "tu_realty_species_ref": ref, "ns_address": na, "cn_contract_key": ck,
                     "cn_service_key": sk, "ns_svc_ref": svc, "cd_const_service_bunch": b})


def test_counts_do_not_depend_on_other_point_columns(spark):
    """A NULL in a carried column, or two points on one date, change no count."""
    from meterbill.operators.intervals import covering_counts
    iv = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 10)), (D(2024, 1, 1), D(2024, 3, 1))], "date_begin date, date_end date")
    pts = spark.createDataFrame([(D(2024, 2, 1), None), (D(2024, 2, 1), "x"), (D(2024, 1, 10), "y"), (None, "z"), (D(2025, 1, 1), "w")],
                                "d date, label string")
    got = sorted((r.d, r.label or "", r.n) for r in covering_counts(iv, pts, "d", out="n").collect())
    assert got == [(D(2024, 1, 10), "y", 2), (D(2024, 2, 1), "", 1), (D(2024, 2, 1), "x", 1)]


def test_t8_production_rules_differ_by_section(spark):
    """The fourth house prefix (cold water used for hot water) is hot for
    houses, but its lower-case word does not match the meter pattern."""
    from meterbill.functions.rules import PRODUCTION
    name = "Холодная вода для приготовления горячей воды"
    df = spark.createDataFrame([(name,), ("Горячее водоснабжение",), ("Водоснабжение",)], "name string")
    house_hot = [r[0] for r in df.filter(like_any("name", PRODUCTION.hot_service_house)).collect()]
    meter_hot = [r[0] for r in df.filter(like_any("name", PRODUCTION.hot_service_meter)).collect()]
    cold = [r[0] for r in df.filter(like_any("name", PRODUCTION.cold_service)).collect()]
    assert sorted(house_hot) == sorted([name, "Горячее водоснабжение"])
    assert meter_hot == ["Горячее водоснабжение"]
    assert cold == ["Водоснабжение"]
