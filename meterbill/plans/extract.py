"""Meter extract: corporate-contract meters with address, attributes, volume
and last reading, one row per contract service (and meter)."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.functions.predicates import AsOf, as_of_value, flag_is, valid_at
from meterbill.functions.rules import EXTRACT_COLUMNS, Rules
from meterbill.functions.text import OracleAddressLabels, address_null_as_empty
from meterbill.operators.attributes import (attribute_as_of, attributes_as_of, characteristic_id,
                                            to_number)
from meterbill.operators.membership import key_filter
from meterbill.operators.periods import OPEN, current_period
from meterbill.operators.readings import READING_ORDER, meter_summary
from meterbill.plans.tables import BillingTables
from meterbill.sources.materialize import Materializer, lazy

Whitelist = Sequence[tuple[str, Iterable[int]]]


def whitelist_frame(spark, pairs: Whitelist) -> DataFrame:
    """(contract number, house) pairs of a literal whitelist; duplicates removed,
    so a semi-join against it never multiplies rows."""
    rows = whitelist_key(pairs)
    schema = T.StructType([T.StructField("contract_nmbr", T.StringType(), False),
                           T.StructField("wl_hos_id", T.LongType(), False)])
    return spark.createDataFrame(rows, schema)


def rendered_addresses(t: BillingTables, labels: OracleAddressLabels) -> DataFrame:
    """(ns_adr_id, house id or NULL, address) - the snowflake chain address ->
    house -> street (+ street type) -> town (+ town type), with the town taken
    via the street, else via the house (two roles of one dimension; name and
    type are coalesced independently), Oracle NULL rules.  All joins are left
    joins to small dimensions."""
    na = t["ns_address"].select("ns_adr_id", F.col("ns_hos_id").alias("adr_hos_id"), "flat")
    h = t["ns_house"].select(F.col("ns_hos_id").alias("h_hos_id"), "house", "corpus", "building",
                             F.col("ns_strt_id").alias("h_strt_id"), F.col("ns_twn_id").alias("h_twn_id"))
    st = t["ns_street_type"].select("ns_strttyp_id", F.col("short_name").alias("street_type"))
    s = (t["ns_street"].join(st, "ns_strttyp_id", "left")
         .select(F.col("ns_strt_id").alias("s_strt_id"), F.col("name").alias("street"), "street_type",
                 F.col("ns_twn_id").alias("s_twn_id")))
    tt = t["ns_town_type"].select("ns_twntyp_id", "short_name")
    town = t["ns_town"].join(tt, "ns_twntyp_id", "left")
    t_street = town.select(F.col("ns_twn_id").alias("ts_id"), F.col("name").alias("ts_name"),
                           F.col("short_name").alias("ts_type"))
    t_house = town.select(F.col("ns_twn_id").alias("th_id"), F.col("name").alias("th_name"),
                          F.col("short_name").alias("th_type"))
    j = (na.join(h, na.adr_hos_id == h.h_hos_id, "left")
         .join(s, F.col("h_strt_id") == F.col("s_strt_id"), "left")
         .join(t_street, F.col("s_twn_id") == F.col("ts_id"), "left")
         .join(t_house, F.col("h_twn_id") == F.col("th_id"), "left"))
    addr = address_null_as_empty(
        F.coalesce("ts_name", "th_name"), F.coalesce("ts_type", "th_type"), F.col("street"),
        F.col("street_type"), F.col("house"), F.col("corpus"), F.col("building"), F.col("flat"),
        labels)
    return j.select("ns_adr_id", "h_hos_id", addr.alias("address"),
                    F.coalesce("ts_name", "th_name").alias("town_name"),
                    F.coalesce("ts_type", "th_type").alias("town_type"))


def left_join_spread(rows: DataFrame, facts: DataFrame, key: str, spread: str) -> DataFrame:
    """``rows.join(facts, key, "left")`` where many rows have no key: those, which match nothing, are dealt over all partitions by
    ``spread`` instead of meeting in the one of NULL."""
    dealt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread), F.lit(1 << 20))).otherwise(0)
    there = facts.withColumnRenamed(key, "_key").withColumn("_at", F.when(F.col("_key").isNotNull(), F.lit(0).cast("long")))
    return rows.withColumn("_dealt", dealt).join(there, (F.col(key) == F.col("_key")) & (F.col("_dealt") == F.col("_at")), "left") \
        .drop("_key", "_dealt", "_at")


def whitelist_key(pairs: Whitelist) -> list[tuple[str, int]]:
    return sorted({(str(c), int(h)) for c, houses in pairs for h in houses})


class MeterExtract:
    """The meter extract over one set of billing tables.

    ``as_of`` is the extract's "now" (by default the time of construction);
    ``reading_order`` names the columns that say which reading is the last;
    ``materialize`` keeps the rows of a whitelisted extract, which are read twice.
    """

    def __init__(self, tables: BillingTables, rules: Rules, labels: OracleAddressLabels,
                 as_of: AsOf = None, reading_order: Sequence[str] = READING_ORDER,
                 materialize: Materializer = lazy):
        self.t = tables
        self.rules = rules
        self.labels = labels
        if as_of is None:      # read once, so that all parts of a report mean the same "now"
            spark = tables["bl_bill_periods"].sparkSession
            as_of = spark.sql("select cast(current_timestamp() as string)").first()[0]
        self.as_of = as_of_value(as_of)
        self.reading_order = reading_order
        self.materialize = materialize

    def attribute(self, code: str, out: str) -> DataFrame:
        ch = characteristic_id(self.t, self.rules.attribute_type, code)
        return attribute_as_of(self.t["attributes"], ch, self.as_of, out=out).withColumnRenamed(
            "object_id", "tu_rlty_kid")

    def service_meters(self) -> DataFrame:
        """Contract service x (optional) valid binding x (optional) active meter,
        with the service name: the outer-join tail of the extract."""
        sk = self.t["cn_service_key"].select("cntr_service_key_id", "cntr_contract_key_id",
                                              "tu_rlty_kid", "ns_svc_id")
        r = self.t["ns_svc_ref"].select("ns_svc_id", F.col("name").alias("service"))
        b = (self.t["cd_const_service_bunch"].filter(flag_is("is_active") & valid_at(self.as_of))
             .select(F.col("us_cntr_svc_id").alias("cntr_service_key_id"), "cd_cntr_kid"))
        cc1 = (self.t["cd_counter"].filter(flag_is("is_active"))
               .select(F.col("cd_cntr_kid").alias("meter_id"), "ser_number", "cntr_number"))
        bound = sk.join(r, "ns_svc_id", "left").join(b, "cntr_service_key_id", "left")
        meters = cc1.withColumn("cd_cntr_kid", F.col("meter_id"))
        return left_join_spread(bound, meters, "cd_cntr_kid", "cntr_service_key_id").drop("cd_cntr_kid")

    def realty_attributes(self) -> DataFrame:
        """(tu_rlty_kid, inspector, storm_attr): both characteristics of a realty
        object as of ``as_of``, in one pass over the attribute table."""
        typ = self.rules.attribute_type
        attrs = attributes_as_of(
            self.t["attributes"],
            {"inspector": characteristic_id(self.t, typ, self.rules.inspector_code, self.rules.inspector_name),
             "storm_attr": characteristic_id(self.t, typ, self.rules.stormwater_code)},
            self.as_of)
        return attrs.withColumnRenamed("object_id", "tu_rlty_kid")

    def keep_row(self) -> Column:
        """A meter is present, or the stormwater service has its attribute (the
        OR over the outer-joined side)."""
        return (F.col("ser_number").isNotNull()
                | ((F.col("service") == F.lit(self.rules.stormwater_service))
                   & F.col("storm_attr").isNotNull()))

    def candidate_rows(self) -> DataFrame:
        """Services that have a meter or, for the stormwater service, a
        stormwater attribute."""
        storm = self.attribute(self.rules.stormwater_code, "storm_attr")
        rows = self.service_meters().join(storm, "tu_rlty_kid", "left")
        return rows.filter(self.keep_row())

    def volumes(self, period_id) -> DataFrame:
        summary = meter_summary(self.t["cd_indication"], period_id, order=self.reading_order)
        return summary.select(F.col("cd_cntr_kid").alias("meter_id"), F.col("volume").alias("meter_volume"))

    def meter_facts(self, period_id, wanted: DataFrame | None = None) -> DataFrame:
        """Per meter: volume of the period and last reading with its source
        name - one aggregate over the readings (see ``meter_summary``).

        With ``wanted`` meters (one column), readings of others are left out where they are
        scanned, by a filter that may let some of them through; the caller's join on the meter is exact."""
        readings = self.t["cd_indication"]
        if wanted is not None:
            readings = readings.filter(key_filter(wanted)("cd_cntr_kid"))
        src = self.t["cd_indication_source"].select("cd_indic_src_id", F.col("name").alias("src_name"))
        summary = meter_summary(readings, period_id, order=self.reading_order)
        return (summary.join(src, "cd_indic_src_id", "left")
                .select(F.col("cd_cntr_kid").alias("meter_id"), F.col("volume").alias("meter_volume"),
                        F.col("value").alias("last_value"), F.col("date_ind_take").alias("last_date"),
                        "src_name"))

    def corporate_contracts(self, whitelist: Whitelist | None = None) -> DataFrame:
        """Active corporate contracts (no account) valid at ``as_of``; with a
        whitelist, only its contract numbers (the house part applies later)."""
        t = self.t
        ck = (t["cn_contract_key"].filter(F.col("us_account_id").isNull())
              .select("cntr_contract_key_id", "us_counteragent_id"))
        # An account anti-join on ck.us_account_id is a no-op here: that key is
        # NULL on every kept row, so no account version can match it.
        c = (t["cn_contract"].filter(flag_is("is_active") & (F.col("cntr_status_id") == 5)
                                     & valid_at(self.as_of))
             .select("cntr_contract_key_id", "contract_nmbr"))
        if whitelist is not None:
            numbers = whitelist_frame(t["bl_bill_periods"].sparkSession, whitelist).select(
                "contract_nmbr").distinct()
            c = c.join(numbers, "contract_nmbr", "left_semi")
        return ck.join(c, "cntr_contract_key_id")

    def extract_services(self, whitelist: Whitelist | None = None) -> DataFrame:
        """Services of the candidate contracts with optional meter and the two
        realty attributes, kept when a meter is present or the stormwater
        attribute applies."""
        contracts = self.corporate_contracts(whitelist).select("cntr_contract_key_id")
        return (self.service_meters().join(contracts, "cntr_contract_key_id", "left_semi")
                .join(self.realty_attributes(), "tu_rlty_kid", "left").filter(self.keep_row()))

    def base_rows(self, whitelist: Whitelist | None = None) -> DataFrame:
        """The extract's rows without what the readings say about their meters."""
        t = self.t
        cc = t["cn_realty_bunch_key"].select("cntr_contract_key_id", "tu_rlty_kid")
        rk_ref = t["tu_realty_species_ref"].select("tu_rlty_spcs_id", F.col("name").alias("object_type"))
        rk = t["tu_realty_key"].select("tu_rlty_kid", "ns_adr_id", "tu_rlty_spcs_id").join(rk_ref, "tu_rlty_spcs_id")
        corp = t["us_corp_card"].select("us_corp_id", F.col("name").alias("party"))
        ut = t["ns_user_type"].select("ns_user_typ_id", F.col("name").alias("user_type"))
        # small dimensions meet each other first, so the contract rows are joined on the party id once
        q = (t["us_counteragent"].select("us_counteragent_id", "us_corp_id", "ns_user_typ_id")
             .join(corp, "us_corp_id").join(ut, "ns_user_typ_id"))
        addr = rendered_addresses(t, self.labels).select("ns_adr_id", "h_hos_id", "address")
        # The original comma-joins the one open period; as a scalar it is a
        # column, and no open period means no rows, as with the join.
        open_id = current_period(t["bl_bill_periods"], OPEN).select("bl_bill_id").scalar()
        head = (self.corporate_contracts(whitelist).join(cc, "cntr_contract_key_id")
                .join(rk, "tu_rlty_kid").join(addr, "ns_adr_id"))
        if whitelist is not None:
            wl = whitelist_frame(t["bl_bill_periods"].sparkSession, whitelist)
            head = head.join(wl, (head.contract_nmbr == wl.contract_nmbr) & (head.h_hos_id == wl.wl_hos_id), "left_semi")
        return (head.join(self.extract_services(whitelist), ["cntr_contract_key_id", "tu_rlty_kid"])
                .join(q, "us_counteragent_id")
                .withColumn("bl_bill_id", open_id).filter(F.col("bl_bill_id").isNotNull()))

    def rows(self, whitelist: Whitelist | None = None) -> DataFrame:
        body, wanted = self.base_rows(whitelist), None
        if whitelist is not None:
            body = self.materialize(body, "extract-rows")
            wanted = body.select("meter_id")
        # the readings arrive as one row per meter
        open_id = current_period(self.t["bl_bill_periods"], OPEN).select("bl_bill_id").scalar()
        body = left_join_spread(body, self.meter_facts(open_id, wanted), "meter_id", "cntr_service_key_id")
        volume = F.when(F.col("service") == F.lit(self.rules.stormwater_service),
                        to_number("storm_attr")).otherwise(F.col("meter_volume"))
        return body.select(
            "contract_nmbr", "cntr_contract_key_id", "party", "object_type", "address", "user_type",
            "inspector", "ser_number", "cntr_number", "service", volume.alias("volume"),
            "last_value", "last_date", "src_name", "h_hos_id")

    def report(self, whitelist: Whitelist | None = None) -> DataFrame:
        """The 13 output columns under their original names, in report order (NULLs last)."""
        out = self.rows(whitelist).orderBy(*[F.col(c).asc_nulls_last() for c in
                                             ("contract_nmbr", "cntr_contract_key_id", "address")])
        src = ("contract_nmbr", "party", "object_type", "address", "user_type", "inspector",
               "ser_number", "cntr_number", "service", "volume", "last_value", "last_date", "src_name")
        return out.select(*[F.col(a).alias(b) for a, b in zip(src, EXTRACT_COLUMNS)])
