"""Every operator and report as a query over one scale-factor directory.

``QUERIES[name](spark, sf_dir) -> DataFrame``; the DuckDB SQL that must give
the same rows is ``meterbill.oracle.ORACLE[name]``.  Stand-in views map the
test tables to billing shapes (``meterbill.sources.standins``); the rule set
is ``FIXTURE`` (which stand-in rows play which billing roles).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.functions import predicates
from meterbill.functions.predicates import flag_is, in_list, like_any, valid_at
from meterbill.functions.rules import FIXTURE
from meterbill.functions.text import FIXTURE_FIREBIRD_LABELS, FIXTURE_ORACLE_LABELS
from meterbill.operators.asof import as_of_join
from meterbill.operators.attributes import attribute_as_of, characteristic_id, to_number
from meterbill.operators.bitmaps import rolled_up
from meterbill.operators.intervals import covering_counts, range_join
from meterbill.operators import periods as P
from meterbill.operators.meter_state import MeterState
from meterbill.operators.periods import CLOSED, OPEN, open_and_closed, period_scalar
from meterbill.operators.readings import (grouped_multi_max, last_reading, latest_max_reading,
                                          period_volume)
from meterbill.operators.snapshots import latest_snapshot_per_base, missing_bases
from meterbill.plans.consolidate import consolidated_accounts, shard_accounts
from meterbill.plans.extract import MeterExtract, left_join_spread, rendered_addresses
from meterbill.plans.history import MonthlyHistory
from meterbill.plans.monthly import MonthlyStats, metric_rows
from meterbill.session import scratch_path
from meterbill.sources import charset, sharded, sinks
from meterbill.sources.shards import BASES, read_shards
from meterbill.sources.materialize import SharedParquet, to_shared_parquet
from meterbill.sources.standins import Standins
from meterbill.plans.tables import FrameMap, TypedTables
from meterbill.streaming.ledger import LEDGER_SCHEMA, read_ledger, run_once_per_period

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the fixture runs (FIXTURES.md): the extract's "now", the
# attribute used by the attribute keys, a whitelist of three pairs listed twice.
AS_OF = dt.datetime(2024, 1, 15, 12, 0, 0)
ATTRIBUTE_CODE = "CLICK"
WHITELIST = (("42-10017", (130, 130)), ("42-1032", (33, 33)), ("42-10380", (91, 91)))
MISSING_SHARD = 29
MONTHLY_JOB = "monthly report"
READING_ORDER = ("date_ind_take", "value", "cd_indic_src_id")   # the stand-in readings have no id
LEDGER_ROWS = ((MONTHLY_JOB, 0), ("other_job", 209912))


def query(arg: Query | str):
    """Register a query under its function name, or ``@query("name")`` under
    a name its operator already uses in this module."""
    if isinstance(arg, str):
        def register(fn: Query) -> Query:
            QUERIES[arg] = fn
            return fn
        return register
    QUERIES[arg.__name__] = arg
    return arg


def _t(spark: SparkSession, sf_dir: str) -> Standins:
    return Standins.of(spark, sf_dir)


def _stats(spark, sf_dir) -> MonthlyStats:
    return MonthlyStats(_t(spark, sf_dir), FIXTURE)


def _extract(spark, sf_dir) -> MeterExtract:
    return MeterExtract(_t(spark, sf_dir), FIXTURE, FIXTURE_ORACLE_LABELS, AS_OF, READING_ORDER)


def _shard_reader(t: Standins):
    def read(b: int) -> dict[str, DataFrame]:
        idx = BASES.index(b)
        nanim = t.nanim.filter(F.col("shard_idx") == idx).drop("shard_idx")
        return {"nanim": nanim, "dom": t.dom, "ulicy": t.ulicy, "city": t.city}
    return read


# ------------------------------------------------------------ scans, sources
@query
def scan_table(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query
def current_period(spark, sf_dir):
    return open_and_closed(_t(spark, sf_dir).bl_bill_periods)


@query
def period_gate(spark, sf_dir):
    ledger = spark.createDataFrame(list(LEDGER_ROWS), LEDGER_SCHEMA)
    return P.period_gate(_t(spark, sf_dir).bl_bill_periods, ledger, MONTHLY_JOB)


@query
def period_gate_append(spark, sf_dir):
    """The gate, the work, the ledger row, and the gate again: a second run in the
    same period does nothing."""
    path = scratch_path(spark, "ledger")
    periods = _t(spark, sf_dir).bl_bill_periods
    ran = [run_once_per_period(periods, path, MONTHLY_JOB, lambda period: None) for _ in range(2)]
    schema = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("processed", T.LongType())])
    runs = spark.createDataFrame([(i + 1, p) for i, p in enumerate(ran)], schema)
    return runs.withColumn("in_ledger", read_ledger(spark, path).agg(F.count("*")).scalar())


@query
def flag_types(spark, sf_dir):
    """Account versions by activity, from sources that hold the flag as text, as a number without a scale, as a
    floating-point number and as a boolean (a quarter of the accounts each)."""
    rows = _t(spark, sf_dir).us_flat_account_ver.select("us_flat_account_kid", "is_active")
    flag = F.col("is_active")
    sources = [F.concat(F.lit(" "), flag.cast("string")), flag.cast("decimal(38,10)"), flag.cast("double"), flag.cast("boolean")]
    parts = [TypedTables(FrameMap({"v": rows.filter(F.col("us_flat_account_kid") % 4 == i).withColumn("is_active", c)}))["v"]
             for i, c in enumerate(sources)]
    return (reduce(DataFrame.union, parts).groupBy("is_active").agg(F.count("*").alias("versions"), F.count_if(flag_is("is_active")).alias("active"))
            .select("is_active", "versions", "active"))


@query
def shard_union(spark, sf_dir):
    read = _shard_reader(_t(spark, sf_dir))
    return read_shards(lambda b: read(b)["nanim"].select("lic", "fio", "close_ls", "data_my"), BASES,
                       names=("ls", "fio", "close_ls", "data_my"))


@query
def sharded_source(spark, sf_dir):
    """The shards, kept as one Parquet folder each, read as one source: newest snapshots, four readers at most."""
    rows = reduce(DataFrame.unionByName, [_shard_reader(_t(spark, sf_dir))(b)["nanim"].withColumn("base", F.lit(b)) for b in BASES])
    path = scratch_path(spark, "file-shards")
    rows.write.partitionBy("base").parquet(path)
    sharded.register(spark)
    shards = (spark.read.format("shards").schema(rows.schema).option("path", path + "/base={base}")
              .option("bases", ",".join(map(str, BASES))).option("newest", "data_my").load())
    return shards.select("base", F.col("lic").alias("ls"), "fio", "close_ls", "data_my")


@query
def shard_completeness(spark, sf_dir):
    # one shard is not read; the others count as read by their status, with or without rows
    read = _shard_reader(_t(spark, sf_dir))
    present = [b for b in BASES if b != MISSING_SHARD]
    status = [read(b)["nanim"].agg(F.count("*").alias("rows")).select(F.lit(b).alias("base"), "rows") for b in present]
    return missing_bases(reduce(DataFrame.union, status), BASES)


@query("consolidated_accounts")
def _consolidated_accounts(spark, sf_dir):
    return consolidated_accounts(_shard_reader(_t(spark, sf_dir)), BASES, FIXTURE_FIREBIRD_LABELS)


@query
def full_refresh(spark, sf_dir):
    df = QUERIES["consolidated_accounts"](spark, sf_dir)
    target = scratch_path(spark, "nanim-target")
    sinks.full_refresh(df, target)
    sinks.full_refresh(df, target)  # a second run replaces, never appends
    return sinks.read_target(spark, target)


@query
def report_sink(spark, sf_dir):
    shared = SharedParquet()
    report = MonthlyStats(_t(spark, sf_dir), FIXTURE, materialize=shared).report()
    path = scratch_path(spark, "monthly-report")
    sinks.report_sink(report, path)
    shared.release(spark)  # the report file is written; its inputs can go
    schema = T.StructType([T.StructField("seq", T.IntegerType()),
                           T.StructField("parameter", T.StringType()),
                           T.StructField("value", T.StringType())])
    return spark.read.option("header", True).schema(schema).csv(path)


@query
def extract_sink(spark, sf_dir):
    """The meter extract as sorted CSV parts, read back."""
    report = _extract(spark, sf_dir).report()
    path = scratch_path(spark, "meter-extract")
    sinks.ordered_sink(report, path)
    return reduce(DataFrame.union, sinks.read_parts(spark, path, report.schema))


@query
def decode_legacy_charset(spark, sf_dir):
    """Customer names with a Cyrillic prefix as WIN1251 bytes, and back."""
    src = _t(spark, sf_dir).customer.select("c_custkey", F.concat(F.lit("Абонент "), "c_name").alias("name"))
    stored = src.select("c_custkey", charset.encode_text("name").alias("bytes"))
    return stored.select("c_custkey", charset.decode_text("bytes").alias("name"))


# ------------------------------------------------------------------- filters
@query
def filter_active(spark, sf_dir):
    fa = _t(spark, sf_dir).us_flat_account_ver
    return (fa.filter(flag_is("is_active") & F.col("us_baseclose_doc_id").isNull())
            .select("us_flat_account_kid", "date_begin", "date_end"))


@query
def filter_in_list(spark, sf_dir):
    ci = _t(spark, sf_dir).cd_indication
    return ci.filter(in_list("cd_indic_src_id", ("AF", "NO", "RF")))


@query
def semi_join_period(spark, sf_dir):
    t = _t(spark, sf_dir)
    cp = P.current_period(t.bl_bill_periods, CLOSED).select("bl_bill_id")
    return t.cd_indication.join(F.broadcast(cp), "bl_bill_id", "left_semi")


@query
def valid_at_filter(spark, sf_dir):
    t = _t(spark, sf_dir)
    bd = period_scalar(t.bl_bill_periods, "bill_date", CLOSED)
    return (t.us_flat_account_ver.filter(valid_at(bd))
            .select("us_flat_account_kid", "is_active", "date_begin", "date_end"))


@query
def like_prefix_any(spark, sf_dir):
    r = _t(spark, sf_dir).ns_svc_ref
    return r.filter(like_any("name", ("cold%", "hot%")))


@query
def like_contains_any(spark, sf_dir):
    r = _t(spark, sf_dir).ns_svc_ref
    return r.filter(like_any("name", FIXTURE.hot_service_meter))


@query
def not_like(spark, sf_dir):
    part = _t(spark, sf_dir).part
    named = part.select("p_partkey", F.nullif(F.col("p_type"), F.lit("SMALL")).alias("name"))
    return named.filter(predicates.not_like("name", FIXTURE.zero_tariff))


@query
def pair_whitelist(spark, sf_dir):
    rows = _extract(spark, sf_dir).base_rows(whitelist=WHITELIST)
    return rows.select("contract_nmbr", "cntr_contract_key_id", "h_hos_id", "service", "ser_number")


@query
def optional_meter_or_attr(spark, sf_dir):
    rows = _extract(spark, sf_dir).candidate_rows()
    return rows.select("cntr_service_key_id", "service", "ser_number", "storm_attr")


@query
def case_expr(spark, sf_dir):
    ex = _extract(spark, sf_dir)
    t = _t(spark, sf_dir)
    open_id = period_scalar(t.bl_bill_periods, "bl_bill_id", OPEN)
    rows = ex.service_meters().join(ex.attribute(FIXTURE.stormwater_code, "storm_attr"), "tu_rlty_kid", "left")
    rows = left_join_spread(rows, ex.volumes(open_id), "meter_id", "cntr_service_key_id")
    volume = F.when(F.col("service") == F.lit(FIXTURE.stormwater_service),
                    to_number("storm_attr")).otherwise(F.col("meter_volume"))
    return rows.select("cntr_service_key_id", volume.alias("volume"))


# --------------------------------------------------------------------- joins
@query
def join_chain(spark, sf_dir):
    ms = _stats(spark, sf_dir)
    t = ms.t
    fa = ms.open_accounts().select("us_flat_account_kid", "num_account")
    ck = t.cn_contract_key.select("cntr_contract_key_id", "us_account_id")
    sk = t.cn_service_key.select("cntr_service_key_id", "cntr_contract_key_id")
    cc = t.cd_counter.filter(flag_is("is_active")).select("cd_cntr_kid", "ser_number")
    return (fa.join(ck, fa.us_flat_account_kid == ck.us_account_id)
            .join(sk, "cntr_contract_key_id").join(ms.valid_bindings(), "cntr_service_key_id")
            .join(cc, "cd_cntr_kid")
            .select("num_account", "cntr_contract_key_id", "cntr_service_key_id", "cd_cntr_kid",
                    "ser_number"))


@query
def left_join_lookup(spark, sf_dir):
    ms = _stats(spark, sf_dir)
    fa = ms.open_accounts().select("us_flat_account_kid", "num_account")
    ck = ms.t.cn_contract_key.select("cntr_contract_key_id", "us_account_id")
    return (ck.join(fa, ck.us_account_id == fa.us_flat_account_kid, "left")
            .select("cntr_contract_key_id", "us_account_id", "num_account"))


@query
def range_join_periods(spark, sf_dir):
    t = _t(spark, sf_dir)
    fa = t.us_flat_account_ver.select("date_begin", "date_end")
    bp = t.bl_bill_periods.select("bl_bill_id", "bill_date")
    # counted per period without pairing versions with periods (see covering_counts)
    counts = covering_counts(fa, bp, "bill_date", out="versions")
    return counts.select("bl_bill_id", F.col("versions").cast("bigint").alias("versions"))


@query
def range_join_pairs(spark, sf_dir):
    """Account versions with every period they cover, as pairs."""
    t = _t(spark, sf_dir)
    fa = t.us_flat_account_ver.select("us_flat_account_kid", "date_begin", "date_end")
    pairs = range_join(fa, t.bl_bill_periods.select("bl_bill_id", "bill_date"), "bill_date")
    return pairs.select("us_flat_account_kid", "date_begin", "bl_bill_id")


@query
def valid_at_join(spark, sf_dir):
    ms = _stats(spark, sf_dir)
    sk = ms.t.cn_service_key.select("cntr_service_key_id", "cntr_contract_key_id")
    return sk.join(ms.valid_bindings(), "cntr_service_key_id")


@query
def composite_join(spark, sf_dir):
    t = _t(spark, sf_dir)
    sk = t.cn_service_key.select("cntr_contract_key_id", "cntr_service_key_id", "ns_svc_id")
    s = t.cn_service.select("cntr_contract_key_id", "cntr_service_key_id", "ns_tariff_plan_id")
    return sk.join(s, ["cntr_contract_key_id", "cntr_service_key_id"])


@query("latest_max_reading")
def _latest_max_reading(spark, sf_dir):
    return latest_max_reading(_t(spark, sf_dir).cd_indication)


@query("grouped_multi_max")
def _grouped_multi_max(spark, sf_dir):
    return grouped_multi_max(_t(spark, sf_dir).cd_indication)


@query
def anti_join(spark, sf_dir):
    ms = _stats(spark, sf_dir)
    fa = ms.open_accounts().select("us_flat_account_kid")
    ck = ms.t.cn_contract_key.select("cntr_contract_key_id", "us_account_id")
    return ck.join(fa, ck.us_account_id == fa.us_flat_account_kid, "left_anti")


@query
def cross_join_period(spark, sf_dir):
    t = _t(spark, sf_dir)
    # the comma join with the one-row open period, as a scalar column: no
    # open period -> no rows, like the join
    open_id = P.current_period(t.bl_bill_periods, OPEN).select("bl_bill_id").scalar()
    c = t.cn_contract.select("cntr_contract_key_id", "contract_nmbr")
    return c.withColumn("bl_bill_id", open_id).filter(F.col("bl_bill_id").isNotNull())


@query
def role_playing_dim(spark, sf_dir):
    addr = rendered_addresses(_t(spark, sf_dir), FIXTURE_ORACLE_LABELS)
    return addr.select("ns_adr_id", "town_name", "town_type")


# ----------------------------------------------------------- text functions
@query
def address_null_as_empty(spark, sf_dir):
    addr = rendered_addresses(_t(spark, sf_dir), FIXTURE_ORACLE_LABELS)
    return addr.select("ns_adr_id", "address")


@query("address_null_propagating")
def _address_null_propagating(spark, sf_dir):
    t = _t(spark, sf_dir)
    tables = {"nanim": t.nanim, "dom": t.dom, "ulicy": t.ulicy, "city": t.city}
    rows = shard_accounts(tables, FIXTURE_FIREBIRD_LABELS)
    return rows.select("ls", "address")


# ------------------------------------------------- readings and attributes
@query
def last_reading_lookup(spark, sf_dir):
    t = _t(spark, sf_dir)
    src = t.cd_indication_source.select("cd_indic_src_id", F.col("name").alias("src_name"))
    last = last_reading(t.cd_indication).join(src, "cd_indic_src_id", "left")
    return (t.cd_counter.select("cd_cntr_kid").join(last, "cd_cntr_kid", "left")
            .select("cd_cntr_kid", "value", "date_ind_take", "src_name"))


@query
def as_of_attribute(spark, sf_dir):
    t = _t(spark, sf_dir)
    ch = characteristic_id(t, FIXTURE.attribute_type, ATTRIBUTE_CODE, ATTRIBUTE_CODE.lower())
    a = attribute_as_of(t.attributes, ch, AS_OF, out="text_value")
    return a.select("object_id", to_number("text_value").alias("value"))


@query("as_of_join")
def _as_of_join(spark, sf_dir):
    """Every event's user looked up at a date of the event's own, in versions that overlap."""
    t = _t(spark, sf_dir)
    own = F.when(F.col("event_id") % 2 == 0, F.lit(ATTRIBUTE_CODE.lower())).otherwise(F.col("event_type"))
    taken = F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 97 - 48).cast("int"))
    lookups = t.events.select("event_id", F.col("user_id").alias("object_id"), own.alias("cn_chrct_id"),
                              F.when(F.col("event_id") % 11 != 0, taken).alias("taken_at"))
    longer = F.when(F.col("date_end") < F.lit("9999-01-01").cast("date"), F.col("date_end") + F.make_dt_interval(days=F.lit(2))) \
        .otherwise(F.col("date_end"))
    versions = t.attributes.withColumn("date_end", longer)
    return as_of_join(lookups, versions, ("object_id", "cn_chrct_id"), "taken_at")


@query("meter_state_merge")
def _meter_state_merge(spark, sf_dir):
    """Volumes from a state that the readings reach in three deliveries, some of them late, some wrong at first."""
    readings = _t(spark, sf_dir).cd_indication
    state = MeterState(spark, scratch_path(spark, "meter-state"), order=READING_ORDER, buckets=16)
    part, late, wrong = F.col("bl_bill_id") % 2, F.col("cd_cntr_kid") % 5 == 0, F.col("cd_cntr_kid") % 7 == 0
    state.merge(readings.filter((part == 0) & ~late))
    state.merge(readings.filter(part == 1).withColumn("value", F.when(wrong, F.col("value") + 1000).otherwise(F.col("value"))))
    put_right = readings.filter((part == 1) & wrong)
    state.merge(readings.filter((part == 0) & late).union(put_right), corrected=put_right.select("cd_cntr_kid", "bl_bill_id"))
    return state.volumes()


@query("period_volume")
def _period_volume(spark, sf_dir):
    return period_volume(_t(spark, sf_dir).cd_indication)


@query
def distinct_pairs(spark, sf_dir):
    return _t(spark, sf_dir).cd_indication.select("cd_indic_src_id", "cd_cntr_kid").distinct()


@query("latest_snapshot_per_base")
def _latest_snapshot_per_base(spark, sf_dir):
    read = _shard_reader(_t(spark, sf_dir))
    union = read_shards(lambda b: read(b)["nanim"].select("lic", "fio", "close_ls", "data_my"), BASES,
                        names=("ls", "fio", "close_ls", "data_my"))
    return latest_snapshot_per_base(union, "base", "data_my")


# ------------------------------------------------------------------ metrics
def _metrics(method: str, *names: str) -> Query:
    def q(spark, sf_dir):
        frame = getattr(_stats(spark, sf_dir), method)()
        return metric_rows(frame.select(*names))
    return q


QUERIES.update({
    "open_accounts": _metrics("m01", "M01"),
    "contracts_active": _metrics("m02", "M02"),
    "accounts_with_readings": _metrics("m03", "M03"),
    "contracts_with_readings": _metrics("m05", "M05"),
    "houses_by_species": _metrics("houses", "M06", "M09"),
    "houses_with_cold_meter": _metrics("houses", "M07", "M10"),
    "houses_with_hot_meter": _metrics("houses", "M08", "M11"),
    "meters_cold": _metrics("meters", "M12"),
    "meters_cold_multi": _metrics("meters", "M13"),
    "meters_hot": _metrics("meters", "M16"),
    "meters_hot_multi": _metrics("meters", "M17"),
    "accounts_with_meter": _metrics("meter_accounts", "M14", "M18"),
    "accounts_with_service": _metrics("service_accounts", "M15", "M19"),
})


@query
def accounts_by_source(spark, sf_dir):
    return _stats(spark, sf_dir).m04()


@query
def accounts_by_source_bitmap(spark, sf_dir):
    """Accounts with a counting reading per channel, and in all (channel NULL), from one set of bitmaps."""
    bitmaps = to_shared_parquet(_stats(spark, sf_dir).reading_bitmaps(), "reading-bitmaps")
    total = rolled_up(bitmaps, (), out="accounts").select(F.lit(None).cast("string").alias("channel"), "accounts")
    return rolled_up(bitmaps, ("channel",), out="accounts").union(total)


# ------------------------------------------------------------------ reports
@query
def monthly_report(spark, sf_dir):
    return MonthlyStats(_t(spark, sf_dir), FIXTURE, materialize=to_shared_parquet).report()


@query
def monthly_report_all_periods(spark, sf_dir):
    """The report's metrics for every closed period."""
    return MonthlyHistory(_t(spark, sf_dir), FIXTURE).metrics()


@query
def meter_extract(spark, sf_dir):
    return _extract(spark, sf_dir).report()


@query
def meter_extract_whitelisted(spark, sf_dir):
    extract = MeterExtract(_t(spark, sf_dir), FIXTURE, FIXTURE_ORACLE_LABELS, AS_OF, READING_ORDER, materialize=to_shared_parquet)
    return extract.report(whitelist=WHITELIST)
