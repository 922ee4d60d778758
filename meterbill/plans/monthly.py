"""Monthly statistics (M01-M19) and the report that lists them.

The original report is a 26-branch ``UNION ALL`` whose branches re-join the
same five to ten tables over and over.  Here the metrics come from a few
shared base frames:

* ``open_accounts``    - account versions open at the closed period's date;
* ``account_services`` - open account x contract x contract service (+ name);
* ``valid_bindings``   - service-to-meter bindings valid at the period date;
* ``meter_channels``   - (meter, channel) with a counting reading in the period;
* ``reading_accounts`` - distinct (channel, account) built from the above.

For the report the shared frames - ``meter_channels`` (from the readings, the
largest fact), ``account_services`` (a four-way join read by three branches),
``open_accounts`` (read by three), ``valid_bindings`` (by four) and ``service_keys``
(by two) - are written once to the shared folder (see ``sources.materialize``): the rows in force at one date are
few, and a source may have to aggregate a table for them.  Every other chain
has exactly one consumer: M03+M04 in one rollup, houses (M06-M11) in one
pass, meters and services (M12-M19) in one pass pre-aggregated per service
key before the fan-out joins.

The closed period is one uncorrelated scalar subquery (a struct), evaluated
once.  Dimensions are joined without hints: AQE turns a join into a
broadcast only when the runtime size of that side is under the threshold
and keeps the shuffle join otherwise, so no side is broadcast on faith.
"""

from __future__ import annotations

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.functions.predicates import flag_is, in_list, like_any, not_like, valid_at
from meterbill.functions.rules import REPORT_LABELS, SECTION_SEQS, Rules
from meterbill.operators.bitmaps import member_bitmaps
from meterbill.operators.periods import CLOSED, current_period
from meterbill.operators.readings import latest_max_reading
from meterbill.plans.tables import BillingTables
from meterbill.sources.materialize import Materializer, lazy

LABEL = dict(REPORT_LABELS)
METRIC_SEQ = {
    "M01": 3, "M02": 4, "M03": 6, "M05": 8, "M06": 10, "M07": 11, "M08": 12, "M09": 13,
    "M10": 14, "M11": 15, "M12": 18, "M13": 19, "M14": 20, "M15": 21, "M16": 23,
    "M17": 24, "M18": 25, "M19": 26,
}
CHANNEL_SEQ = 7


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _count_if(cond: Column, name: str) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False))).alias(name)


def _sum_if(cond: Column, value: Column, name: str) -> Column:
    """A count of join rows expressed as a sum; 0 (not NULL) over no rows."""
    total = F.sum(F.when(cond, value).otherwise(F.lit(0)))
    return F.coalesce(total, F.lit(0)).cast("bigint").alias(name)


def _distinct_count_if(cond: Column, key: Column, name: str) -> Column:
    """``count(*)`` over ``select distinct key where cond``: a NULL key counts
    once (``count(DISTINCT)`` alone would skip it)."""
    nulls = F.max(F.when(cond & key.isNull(), F.lit(1)).otherwise(F.lit(0)))
    return (F.count_distinct(F.when(cond, key)) + F.coalesce(nulls, F.lit(0))).cast("bigint").alias(name)


class MonthlyStats:
    """The metrics of the closed billing period over one set of billing tables.

    ``materialize`` decides how shared base frames are kept: ``lazy`` (part of
    every consumer's plan - right for a single metric) or
    ``sources.materialize.to_shared_parquet`` (written once to the shared
    folder - right for ``report``, whose branches share them).
    """

    def __init__(self, tables: BillingTables, rules: Rules, materialize: Materializer = lazy):
        self.t = tables
        self.rules = rules
        self._materialize = materialize
        self._shared: dict[str, DataFrame] = {}
        period = current_period(tables["bl_bill_periods"], CLOSED)
        closed = period.select(F.struct("bl_bill_id", "bill_date").alias("p")).scalar()
        self.bill_id = closed["bl_bill_id"]
        self.bill_date = closed["bill_date"]

    def _once(self, name: str, build) -> DataFrame:
        if name not in self._shared:
            self._shared[name] = self._materialize(build(), name)
        return self._shared[name]

    # ----------------------------------------------------------------- bases
    def open_accounts(self) -> DataFrame:
        """Account versions active, not closed, valid at the period date."""
        def build():
            fa = self.t["us_flat_account_ver"]
            return (fa.filter(flag_is("is_active") & F.col("us_baseclose_doc_id").isNull()
                              & valid_at(self.bill_date))
                    .select("us_flat_account_kid", "num_account", "tu_rlty_kid"))
        return self._once("open_accounts", build)

    def valid_bindings(self) -> DataFrame:
        """(cntr_service_key_id, cd_cntr_kid) of active bindings valid at the date."""
        def build():
            b = self.t["cd_const_service_bunch"]
            return (b.filter(flag_is("is_active") & valid_at(self.bill_date))
                    .select(F.col("us_cntr_svc_id").alias("cntr_service_key_id"), "cd_cntr_kid"))
        return self._once("valid_bindings", build)

    def service_keys(self) -> DataFrame:
        """(service, contract, realty, service reference) of every contract service."""
        def build():
            return self.t["cn_service_key"].select("cntr_service_key_id", "cntr_contract_key_id", "tu_rlty_kid", "ns_svc_id")
        return self._once("service_keys", build)

    def account_services(self) -> DataFrame:
        """Open account version x its contracts' services, with the service name
        (NULL when the service has no catalogue entry; a LIKE on it then drops
        the row exactly as the original inner join did)."""
        def build():
            fa = self.open_accounts()
            ck = self.t["cn_contract_key"].select("cntr_contract_key_id", "us_account_id")
            sk = self.service_keys().select("cntr_service_key_id", "cntr_contract_key_id", "ns_svc_id")
            ref = self.t["ns_svc_ref"].select("ns_svc_id", "name")
            return (fa.join(ck, fa.us_flat_account_kid == ck.us_account_id)
                    .join(sk, "cntr_contract_key_id").join(ref, "ns_svc_id", "left")
                    .select("us_flat_account_kid", "num_account", "tu_rlty_kid", "cntr_contract_key_id",
                            "cntr_service_key_id", "name"))
        return self._once("account_services", build)

    def active_contracts(self) -> DataFrame:
        c = self.t["cn_contract"]
        return c.filter(flag_is("is_active") & (F.col("cntr_status_id") == 5) & valid_at(self.bill_date))

    def meter_channels(self) -> DataFrame:
        """Distinct (meter, channel) of the readings that count in the period,
        for every channel either section asks for.

        Readings are restricted to the period *before* the maxima (the period
        is part of the grouping key, so this is exact), the channel filter is
        applied *after* (the maxima are over all channels).
        """
        channels = tuple(dict.fromkeys(self.rules.reading_channels + self.rules.corporate_channels))

        def build():
            ci = self.t["cd_indication"].filter(F.col("bl_bill_id") == self.bill_id)
            latest = latest_max_reading(ci)
            src = self.t["cd_indication_source"].filter(in_list("name", channels))
            return (latest.select("cd_cntr_kid", "cd_indic_src_id").distinct().join(src, "cd_indic_src_id")
                    .select("cd_cntr_kid", F.col("name").alias("channel"))
                    .distinct())
        return self._once("meter_channels", build)

    def reading_accounts(self, distinct: bool = True) -> DataFrame:
        """(channel, num_account) with a counting reading (M03/M04), each pair once if ``distinct``."""
        def build():
            meters = self.meter_channels().filter(in_list("channel", self.rules.reading_channels))
            svc = self.valid_bindings().join(meters, "cd_cntr_kid").select("cntr_service_key_id", "channel")
            acc = self.account_services().select("cntr_service_key_id", "num_account")
            pairs = acc.join(svc, "cntr_service_key_id").select("channel", "num_account")
            return pairs.distinct() if distinct else pairs
        return build()

    def reading_bitmaps(self) -> DataFrame:
        """M03 and M04 as exact bitmaps of accounts per period and channel; ``bitmaps.rolled_up`` counts
        them by channel, by period or in all, of one period's rows or of many periods' rows put together."""
        pairs = self.reading_accounts(distinct=False).withColumn("bl_bill_id", self.bill_id)
        return member_bitmaps(pairs, ("bl_bill_id", "channel"), "num_account")

    def reading_contracts(self) -> DataFrame:
        """Distinct corporate contract numbers with a counting reading."""
        meters = (self.meter_channels().filter(in_list("channel", self.rules.corporate_channels))
                  .select("cd_cntr_kid").distinct())
        ck = self.t["cn_contract_key"].filter(F.col("us_account_id").isNull())
        c = self.active_contracts().select("cntr_contract_key_id", "contract_nmbr")
        realty = self.t["tu_realty"].filter(flag_is("is_active") & valid_at(self.bill_date))
        rk = self.t["tu_realty_key"].select("tu_rlty_kid")
        sk = self.service_keys().select("cntr_contract_key_id", "tu_rlty_kid", "cntr_service_key_id")
        return (ck.select("cntr_contract_key_id").join(c, "cntr_contract_key_id")
                .join(self.t["cn_realty_bunch_key"], "cntr_contract_key_id")
                .join(rk, "tu_rlty_kid")
                .join(realty.select("tu_rlty_kid"), "tu_rlty_kid")
                .join(sk, ["cntr_contract_key_id", "tu_rlty_kid"])
                .join(self.valid_bindings(), "cntr_service_key_id")
                .join(meters, "cd_cntr_kid")
                .select("contract_nmbr").distinct())

    def realty_species(self) -> DataFrame:
        """(tu_rlty_kid, ns_adr_id, species name) of every realty key."""
        rk = self.t["tu_realty_key"]
        ref = self.t["tu_realty_species_ref"].select("tu_rlty_spcs_id", F.col("name").alias("species"))
        return rk.join(ref, "tu_rlty_spcs_id").select("tu_rlty_kid", "ns_adr_id", "species")

    def account_species(self) -> DataFrame:
        """(tu_rlty_kid, ns_hos_id, species name): realty key with its house."""
        na = self.t["ns_address"].select("ns_adr_id", "ns_hos_id")
        return self.realty_species().join(na, "ns_adr_id").select("tu_rlty_kid", "ns_hos_id", "species")

    def house_flags(self) -> DataFrame:
        """(species group, house) with has_cold / has_hot - NULL house kept as one house."""
        r = self.rules
        group = (F.when(in_list("species", r.multi_flat_species), F.lit("multi"))
                 .when(in_list("species", r.private_species), F.lit("private")))
        fa = self.open_accounts().select("us_flat_account_kid", "tu_rlty_kid")
        houses = (fa.join(self.account_species(), "tu_rlty_kid")
                  .withColumn("grp", group).filter(F.col("grp").isNotNull()))
        bound = self.valid_bindings().select("cntr_service_key_id")
        flags = (self.account_services().join(bound, "cntr_service_key_id", "left_semi")
                 .groupBy("us_flat_account_kid")
                 .agg(F.max(like_any("name", r.cold_service)).alias("has_cold"),
                      F.max(like_any("name", r.hot_service_house)).alias("has_hot")))
        joined = houses.join(flags, "us_flat_account_kid", "left")
        return joined.groupBy("grp", "ns_hos_id").agg(
            F.max(F.coalesce("has_cold", F.lit(False))).alias("has_cold"),
            F.max(F.coalesce("has_hot", F.lit(False))).alias("has_hot"))

    def service_rows(self) -> DataFrame:
        """Open account x contract service with a valid service version and a
        non-zero tariff (one row per join row), cold / hot by the meter rules.
        Services that are neither are dropped first: no metric reads them."""
        r = self.rules
        s = (self.t["cn_service"].filter(flag_is("is_active") & valid_at(self.bill_date))
             .select("cntr_contract_key_id", "cntr_service_key_id", "ns_tariff_plan_id"))
        tp = (self.t["ns_tariff_plan"].filter(not_like("name", r.zero_tariff))
              .select("ns_tariff_plan_id"))
        cold, hot = like_any("name", r.cold_service), like_any("name", r.hot_service_meter)
        svc = (self.account_services().filter(cold | hot)
               .select("num_account", "tu_rlty_kid", "cntr_contract_key_id", "cntr_service_key_id", "name",
                       cold.alias("cold"), hot.alias("hot")))
        return (svc.join(s, ["cntr_contract_key_id", "cntr_service_key_id"])
                .join(tp, "ns_tariff_plan_id").drop("ns_tariff_plan_id"))

    def meter_service_counts(self) -> DataFrame:
        """M12-M19 in one pass.

        Per service key the number of (binding, active meter) join rows, and
        per realty key the number of multi-flat species rows, are aggregated
        *before* they meet the service rows, so the original fan-out (a meter
        bound to two services counts twice) is reproduced by multiplying
        counts instead of materialising the cross product.
        """
        pairs = self._meter_pairs()
        cold, hot = F.col("cold"), F.col("hot")
        has_meter = F.col("n_meter") > 0
        acc = F.col("num_account")
        return pairs.agg(
            _sum_if(cold, F.col("n_meter"), "M12"), _sum_if(cold, F.col("n_meter_multi"), "M13"),
            _count_if(cold & has_meter, "M14"), _distinct_count_if(cold, acc, "M15"),
            _sum_if(hot, F.col("n_meter"), "M16"), _sum_if(hot, F.col("n_meter_multi"), "M17"),
            _count_if(hot & has_meter, "M18"), _distinct_count_if(hot, acc, "M19"))

    def _meter_rows(self) -> DataFrame:
        """Service rows with their (binding, active meter) join-row count and
        that count times the account's multi-flat species rows."""
        r = self.rules
        cc = self.t["cd_counter"].filter(flag_is("is_active")).select("cd_cntr_kid")
        meters = (self.valid_bindings().join(cc, "cd_cntr_kid")
                  .groupBy("cntr_service_key_id").agg(F.count(F.lit(1)).alias("n_meter")))
        multi = (self.realty_species().filter(in_list("species", r.multi_flat_species))
                 .groupBy("tu_rlty_kid").agg(F.count(F.lit(1)).alias("n_multi")))
        n_meter = F.coalesce("n_meter", F.lit(0))
        return (self.service_rows().join(meters, "cntr_service_key_id", "left")
                .join(multi, "tu_rlty_kid", "left")
                .select("num_account", "name", "cold", "hot", n_meter.alias("n_meter"),
                        (n_meter * F.coalesce("n_multi", F.lit(0))).alias("n_meter_multi")))

    def _meter_pairs(self) -> DataFrame:
        """``_meter_rows`` per distinct (account, service name)."""
        return self._meter_rows().groupBy("num_account", "name").agg(
            F.sum("n_meter").alias("n_meter"), F.sum("n_meter_multi").alias("n_meter_multi"),
            F.max("cold").alias("cold"), F.max("hot").alias("hot"))

    # --------------------------------------------------------------- metrics
    def m01(self) -> DataFrame:
        return self.open_accounts().agg(_count("M01"))

    def m02(self) -> DataFrame:
        ck = self.t["cn_contract_key"].select("cntr_contract_key_id", "us_counteragent_id")
        q = self.t["us_counteragent"].select("us_counteragent_id", "ns_user_typ_id")
        ut = (self.t["ns_user_type"].filter(F.col("name") != F.lit(self.rules.individual_user_type))
              .select("ns_user_typ_id"))
        # parties and their types meet first: the contracts are never shuffled by the few type ids
        return (ck.join(self.active_contracts().select("cntr_contract_key_id"), "cntr_contract_key_id")
                .join(q.join(ut, "ns_user_typ_id"), "us_counteragent_id")
                .agg(_count("M02")))

    def reading_counts(self) -> DataFrame:
        """M03 and M04 from one aggregate: ``rollup(channel)`` gives one row per
        channel (``gid`` 0, M04) and the all-channel row (``gid`` 1, M03); on
        distinct (channel, account) pairs a per-channel distinct count is the
        plain count of the original, the total is its distinct-account count.
        """
        return (self.reading_accounts().rollup("channel")
                .agg(F.count_distinct("num_account").alias("accounts"), F.grouping_id().alias("gid")))

    # M03 and M04 alone; the report takes both from ``reading_counts``.
    def m03(self) -> DataFrame:
        return self.reading_accounts().agg(F.count_distinct("num_account").alias("M03"))

    def m04(self) -> DataFrame:
        """One row per channel: (channel, accounts)."""
        return self.reading_accounts().groupBy("channel").agg(F.count("num_account").alias("accounts"))

    def m05(self) -> DataFrame:
        return self.reading_contracts().agg(F.count("contract_nmbr").alias("M05"))

    def houses(self) -> DataFrame:
        h = self.house_flags()
        multi, private = F.col("grp") == "multi", F.col("grp") == "private"
        return h.agg(_count_if(multi, "M06"), _count_if(multi & F.col("has_cold"), "M07"),
                     _count_if(multi & F.col("has_hot"), "M08"), _count_if(private, "M09"),
                     _count_if(private & F.col("has_cold"), "M10"),
                     _count_if(private & F.col("has_hot"), "M11"))

    # The three metric families alone (single-metric queries); the report
    # takes all eight from ``meter_service_counts`` in one pass.
    def meters(self) -> DataFrame:
        """Counts of join rows, straight from the row counts."""
        m = self._meter_rows()
        cold, hot = F.col("cold"), F.col("hot")
        return m.agg(_sum_if(cold, F.col("n_meter"), "M12"), _sum_if(cold, F.col("n_meter_multi"), "M13"),
                     _sum_if(hot, F.col("n_meter"), "M16"), _sum_if(hot, F.col("n_meter_multi"), "M17"))

    def meter_accounts(self) -> DataFrame:
        """Distinct (account, service name) pairs with a meter."""
        p = self._meter_pairs()
        has_meter = F.col("n_meter") > 0
        return p.agg(_count_if(F.col("cold") & has_meter, "M14"), _count_if(F.col("hot") & has_meter, "M18"))

    def service_accounts(self) -> DataFrame:
        """Distinct accounts with the service (no meter needed)."""
        acc = (self.service_rows().groupBy("num_account")
               .agg(F.max("cold").alias("cold"), F.max("hot").alias("hot")))
        return acc.agg(_count_if(F.col("cold"), "M15"), _count_if(F.col("hot"), "M19"))

    # ---------------------------------------------------------------- report
    def prepare(self) -> None:
        """Build the shared base frames.  With a writing materializer these are
        three independent jobs; they are submitted together so they share the
        cluster instead of running one after the other."""
        failed: list[BaseException] = []

        def build(frame) -> None:
            try:
                frame()
            except BaseException as e:  # noqa: BLE001 - raised again below
                failed.append(e)
        spark = self.t["bl_bill_periods"].sparkSession
        # the threads keep the caller's job group and pool
        threads = [InheritableThread(target=build, args=(f,), session=spark) for f in (self.meter_channels, self.account_services, self.valid_bindings)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        if failed:
            raise failed[0]

    def report(self) -> DataFrame:
        """(seq, parameter, value) in report order; value is text, NULL on
        section rows (the original's empty string is NULL in its database)."""
        self.prepare()
        spark = self.t["bl_bill_periods"].sparkSession
        schema = T.StructType([T.StructField("seq", T.IntegerType(), False),
                               T.StructField("parameter", T.StringType(), False),
                               T.StructField("value", T.StringType(), True)])
        sections = spark.createDataFrame([(s, LABEL[s], None) for s in sorted(SECTION_SEQS)], schema)
        title = (current_period(self.t["bl_bill_periods"], CLOSED)
                 .select(F.lit(1).alias("seq"), F.lit(LABEL[1]).alias("parameter"),
                         F.col("bill_name").alias("value")))
        parts = [sections, title, self._reading_rows()]
        for frame in (self.m01(), self.m02(), self.m05(), self.houses(),
                      self.meter_service_counts()):
            parts.append(unpivot_metrics(frame))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.orderBy("seq", "parameter")

    def _reading_rows(self) -> DataFrame:
        """Report rows of M03 (seq 6) and M04 (seq 7), one consumer of the
        rollup.  A literal 0 for M03 keeps its row when no reading counts."""
        spark = self.t["bl_bill_periods"].sparkSession
        counts = self.reading_counts()
        rows = counts.select(
            F.when(F.col("gid") == 1, F.lit(METRIC_SEQ["M03"])).otherwise(F.lit(CHANNEL_SEQ)).alias("seq"),
            F.when(F.col("gid") == 1, F.lit(LABEL[METRIC_SEQ["M03"]]))
             .otherwise(F.concat(F.lit(LABEL[CHANNEL_SEQ]), F.col("channel"))).alias("parameter"),
            F.col("accounts").cast("bigint").alias("accounts"))
        zero = spark.createDataFrame([(METRIC_SEQ["M03"], LABEL[METRIC_SEQ["M03"]], 0)],
                                     "seq int, parameter string, accounts bigint")
        return (rows.unionByName(zero).groupBy("seq", "parameter")
                .agg(F.max("accounts").cast("string").alias("value")))


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def unpivot_metrics(frame: DataFrame) -> DataFrame:
    """One-row frame of metric columns -> (seq, parameter, value) rows."""
    cols = frame.columns
    stack = ", ".join(f"{METRIC_SEQ[c]}, {_sql_text(LABEL[METRIC_SEQ[c]])}, cast(`{c}` AS string)"
                      for c in cols)
    return frame.selectExpr(f"stack({len(cols)}, {stack}) AS (seq, parameter, value)")


def metric_rows(frame: DataFrame) -> DataFrame:
    """One-row frame of metric columns -> (metric, value) rows."""
    cols = frame.columns
    stack = ", ".join(f"'{c}', cast(`{c}` AS bigint)" for c in cols)
    return frame.selectExpr(f"stack({len(cols)}, {stack}) AS (metric, value)")
