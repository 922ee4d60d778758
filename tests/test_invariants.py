"""Report invariants that hold at any scale (sf0.01)."""

import pytest

from meterbill.catalog import QUERIES
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def report(spark):
    rows = QUERIES["monthly_report"](spark, SF_MID).collect()
    return rows


def _v(report, seq):
    return int(next(r.value for r in report if r.seq == seq))


def test_order_and_shape(report):
    seqs = [r.seq for r in report]
    assert seqs == sorted(seqs)
    assert set(seqs) == set(range(1, 27))


def test_fixture_values(report):
    assert report[0].value == "P200107"
    expected = {3: 811, 4: 6247, 6: 667, 8: 210, 10: 213, 11: 183, 12: 197, 13: 218, 14: 189, 15: 204,
                18: 962, 19: 376, 20: 867, 21: 638, 23: 2061, 24: 802, 25: 1868, 26: 764}
    assert {s: _v(report, s) for s in expected} == expected
    channels = {r.parameter[-2:]: int(r.value) for r in report if r.seq == 7}
    assert channels == {"AF": 395, "NO": 365, "RF": 326, "RO": 133}


def test_subset_invariants(report):
    assert _v(report, 19) <= _v(report, 18)      # M13 <= M12
    assert _v(report, 24) <= _v(report, 23)      # M17 <= M16
    assert _v(report, 11) <= _v(report, 10)      # M07 <= M06
    assert _v(report, 14) <= _v(report, 13)      # M10 <= M09
    assert sum(int(r.value) for r in report if r.seq == 7) >= _v(report, 6)


def test_consolidation_sums_shards(spark):
    from pyspark.sql import functions as F
    out = QUERIES["consolidated_accounts"](spark, SF_MID)
    per = {r.base: r.n for r in out.groupBy("base").agg(F.count("*").alias("n")).collect()}
    assert len(per) == 9 and sum(per.values()) == out.count() == 149


def test_every_shard_uses_its_own_dimensions(spark):
    """The same dimension id may mean another street in another shard; an empty shard is no error."""
    from pyspark.sql import functions as F
    from meterbill.catalog import _shard_reader
    from meterbill.functions.text import FIXTURE_FIREBIRD_LABELS
    from meterbill.plans.consolidate import consolidated_accounts
    from meterbill.sources.shards import BASES
    from meterbill.sources.standins import Standins
    same = _shard_reader(Standins(spark, SF_MID))

    def read(b):
        t = dict(same(b))
        t["ulicy"] = t["ulicy"].withColumn("name", F.concat("name", F.lit(f" {b}")))
        if b == BASES[-1]:
            t["nanim"] = t["nanim"].limit(0)
        return t
    plain = consolidated_accounts(same, BASES, FIXTURE_FIREBIRD_LABELS, max_parallel=2).collect()
    own = consolidated_accounts(read, BASES, FIXTURE_FIREBIRD_LABELS).collect()
    assert {r.base for r in own} == set(BASES[:-1])
    street = lambda r, tail: r.address and (r.base, r.ls, r.fio, r.address.replace(f" {r.base}{tail}", tail))
    tail = FIXTURE_FIREBIRD_LABELS.house
    assert sorted(x for r in own if (x := street(r, tail))) == \
        sorted((r.base, r.ls, r.fio, r.address) for r in plain if r.address and r.base != BASES[-1])


def test_period_filter_prunes_partitioned_readings(spark, tmp_path):
    """With readings stored partitioned by period, the closed-period filter of
    the report reaches the scan as a partition filter (a scalar subquery
    evaluated at run time) and gives the same counting meters."""
    from meterbill.functions.rules import FIXTURE
    from meterbill.plans.monthly import MonthlyStats
    from meterbill.plans.tables import FrameMap
    from meterbill.sources.standins import Standins
    st = Standins(spark, SF_MID)
    path = str(tmp_path / "readings")
    st.cd_indication.write.partitionBy("bl_bill_id").parquet(path)
    frames = {n: st[n] for n in st.names}
    frames["cd_indication"] = spark.read.parquet(path)
    got = MonthlyStats(FrameMap(frames), FIXTURE).meter_channels()
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "bl_bill_id" in line]
    assert scans and all("PartitionFilters: [isnotnull(bl_bill_id" in s and "subquery" in s.lower()
                         for s in scans)
    want = MonthlyStats(st, FIXTURE).meter_channels()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_production_rules_end_to_end(spark):
    """The report with the original (Cyrillic) rule set over the stand-ins
    relabelled into the original vocabulary equals the fixture-rule report.
    The relabelling keeps, for every name, which rules select it."""
    from pyspark.sql import functions as F
    from meterbill.functions.rules import FIXTURE, PRODUCTION, REPORT_LABELS
    from meterbill.plans.monthly import MonthlyStats
    from meterbill.plans.tables import FrameMap
    from meterbill.sources.standins import Standins
    st = Standins.of(spark, SF_MID)
    n = F.col("name")
    meter_hot = n.like("%hot%") | n.like("%gizmo%")
    prefix = (F.when(n.like("cold%"), F.lit("Водоснабжение "))
              .when(n.like("hot%"), F.lit("ГВС "))
              .when(n.like("red g%"), F.lit("Холодная вода для приготовления горячей "))
              .otherwise(F.lit("Прочее ")))
    suffix = F.when(meter_hot & ~n.like("hot%"), F.lit(" Горячая")).otherwise(F.lit(""))
    species = {"HOUSEHOLD": "МКД", "BUILDING": "Комната", "FURNITURE": "Частный дом",
               "MACHINERY": "Квартира в ЧД"}
    channels = dict(zip(FIXTURE.reading_channels, PRODUCTION.reading_channels))

    def relabel(col, mapping):
        out = F.col(col)
        for k, v in mapping.items():
            out = F.when(F.col(col) == k, F.lit(v)).otherwise(out)
        return out

    frames = {name: st[name] for name in st.names}
    frames["ns_svc_ref"] = st.ns_svc_ref.withColumn("name", F.concat(prefix, n, suffix))
    frames["ns_tariff_plan"] = st.ns_tariff_plan.withColumn(
        "name", F.when(n.like("%ROM%"), F.concat(F.lit("Нулевой "), n)).otherwise(n))
    frames["tu_realty_species_ref"] = st.tu_realty_species_ref.withColumn("name", relabel("name", species))
    frames["ns_user_type"] = st.ns_user_type.withColumn(
        "name", relabel("name", {"HOUSEHOLD": PRODUCTION.individual_user_type}))
    frames["cd_indication_source"] = st.cd_indication_source.withColumn("name", relabel("name", channels))

    prod = {(r.seq, r.parameter): r.value
            for r in MonthlyStats(FrameMap(frames), PRODUCTION).report().collect()}
    label = dict(REPORT_LABELS)[7]
    fix = {}
    for r in MonthlyStats(st, FIXTURE).report().collect():
        param = r.parameter
        if r.seq == 7:  # per-channel rows are labelled with the channel name
            param = label + channels[param[len(label):]]
        fix[(r.seq, param)] = r.value
    assert prod == fix
    assert prod[(3, dict(REPORT_LABELS)[3])] == "811"


def test_production_extract_end_to_end(spark):
    """The extract with the original rule set and address wording over
    relabelled stand-ins equals the fixture extract (addresses aside, which
    use the original wording)."""
    from pyspark.sql import functions as F
    from meterbill.catalog import AS_OF, READING_ORDER
    from meterbill.functions.rules import FIXTURE, PRODUCTION
    from meterbill.functions.text import FIXTURE_ORACLE_LABELS, ORACLE_LABELS
    from meterbill.plans.extract import MeterExtract
    from meterbill.plans.tables import FrameMap
    from meterbill.sources.standins import Standins
    st = Standins.of(spark, SF_MID)
    frames = {name: st[name] for name in st.names}
    n = F.col("name")
    frames["ns_svc_ref"] = st.ns_svc_ref.withColumn(
        "name", F.when(n == FIXTURE.stormwater_service, F.lit(PRODUCTION.stormwater_service)).otherwise(n))
    code = F.col("code")
    frames["cn_characteristic_ref"] = (st.cn_characteristic_ref
        .withColumn("code", F.when(code == FIXTURE.stormwater_code, F.lit(PRODUCTION.stormwater_code))
                    .when(code == FIXTURE.inspector_code, F.lit(PRODUCTION.inspector_code)).otherwise(code))
        .withColumn("name", F.when(n == FIXTURE.inspector_name, F.lit(PRODUCTION.inspector_name)).otherwise(n)))
    frames["cn_char_type"] = st.cn_char_type.withColumn("name", F.lit(PRODUCTION.attribute_type))
    cols = ["contract_nmbr", "cntr_contract_key_id", "party", "inspector", "ser_number", "volume",
            "last_value", "last_date", "src_name"]
    prod = MeterExtract(FrameMap(frames), PRODUCTION, ORACLE_LABELS, AS_OF, READING_ORDER).rows()
    fix = MeterExtract(st, FIXTURE, FIXTURE_ORACLE_LABELS, AS_OF, READING_ORDER).rows()
    assert sorted(map(tuple, prod.select(*cols).collect()), key=repr) == \
        sorted(map(tuple, fix.select(*cols).collect()), key=repr)
    addresses = [r.address for r in prod.select("address").distinct().collect()]
    assert any(a.startswith(ORACLE_LABELS.default_city + " ,") for a in addresses)
    assert all(ORACLE_LABELS.house in a for a in addresses)


def test_service_accounts_cover_meter_accounts(spark):
    """M15 >= distinct accounts of the M14 pairs (and M19 for M18): an account
    with a metered service has the service."""
    from pyspark.sql import functions as F
    from meterbill.functions.rules import FIXTURE
    from meterbill.plans.monthly import MonthlyStats
    from meterbill.sources.standins import Standins
    ms = MonthlyStats(Standins.of(spark, SF_MID), FIXTURE)
    pairs = ms._meter_pairs().filter(F.col("n_meter") > 0)
    counts = ms.meter_service_counts().first()
    assert counts.M15 >= pairs.filter("cold").select("num_account").distinct().count()
    assert counts.M19 >= pairs.filter("hot").select("num_account").distinct().count()
    assert counts.M14 >= pairs.filter("cold").select("num_account").distinct().count()


def test_fixture_probe_numbers(spark):
    """The expected values FIXTURES.md records for the stand-ins at sf0.01."""
    from pyspark.sql import functions as F
    lr = QUERIES["last_reading_lookup"](spark, SF_MID).agg(F.count("value"), F.sum("value")).first()
    assert tuple(lr) == (100, 2606.0)
    pv = (QUERIES["period_volume"](spark, SF_MID).filter("bl_bill_id = 200107")
          .agg(F.count("volume"), F.sum("volume")).first())
    assert tuple(pv) == (100, -173.0)
    ad = QUERIES["address_null_as_empty"](spark, SF_MID)
    got = ad.agg(F.count("*"), F.countDistinct("address"), F.sum(F.length("address")),
                 F.count_if(F.col("address").startswith("City")),
                 F.count_if(F.col("address").contains(" , d."))).first()
    assert tuple(got) == (1500, 1500, 67295, 75, 150)
    samples = {r.ns_adr_id: r.address for r in ad.filter(F.col("ns_adr_id").isin(20, 23, 27)).collect()}
    assert samples == {20: "City , d. 20, f. 6", 23: "t. EUROPE, st. NATION_23, d. 23, k. 3, b. 3, f. 2",
                       27: "t. ASIA, st. NATION_2, d. 27, k. 3, b. 2, f. 6"}
    attr = QUERIES["as_of_attribute"](spark, SF_MID).agg(F.count("*"), F.round(F.sum("value"), 2)).first()
    assert tuple(attr) == (150, 8048.22)
    latest = QUERIES["latest_max_reading"](spark, SF_MID).agg(F.count("*"), F.sum("value")).first()
    assert tuple(latest) == (1646, 68529.0)
