"""The monthly metrics of every closed period at once.

``monthly.MonthlyStats`` filters every table to the date of one period.  Here no table is filtered by a date: rows that
count together are joined on their keys, and the interval in which all of them are in force is the intersection of theirs.  A
metric that counts rows is then a sum over the intervals that hold a period's date; one that counts accounts or houses
first unites the intervals of each, so that each counts once.  Both are begins and ends added up per date, summed along
the dates by one running sum for all metrics, and read at the periods' dates.  The work does not grow with the number of periods.

Services meet their versions and meters before they meet the versions of their accounts, and what only counts accounts is united
per account before, so no join's rows are shuffled with every version of an account beside every service.

Readings belong to a period by themselves (M03-M05).  A set of periods is a bit mask (``Calendar``): a meter's periods with a reading
that counts, the periods in which an interval is in force.  They meet as masks, one row per binding whatever the number of
periods, are combined per account or contract, and become rows only where these are counted.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterbill.functions.predicates import flag_is, in_list, like_any, not_like
from meterbill.functions.rules import Rules
from meterbill.operators.intervals import running_sum
from meterbill.operators.periods import CLOSED
from meterbill.operators.readings import latest_max_reading
from meterbill.plans.tables import BillingTables
from meterbill.sources.materialize import Materializer, to_shared_parquet

ROWS = ("M01", "M02", "M12", "M13", "M16", "M17")
ENTITIES = ("M06", "M07", "M08", "M09", "M10", "M11", "M14", "M15", "M18", "M19")


def intersected(a: DataFrame, b: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Pairs of rows with equal ``on`` whose intervals (begin, end) meet, with the interval both are in force."""
    other = b.withColumnsRenamed({"begin": "_begin", "end": "_end"})
    pairs = a.join(other, on).withColumns({"begin": F.greatest("begin", "_begin"), "end": F.least("end", "_end")})
    return pairs.drop("_begin", "_end").filter(F.col("begin") <= F.col("end"))


def united(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by ..., begin, end): the intervals of every key without overlaps.

    Intervals that begin on one date are one before any window sees them, so a key's window holds at
    most one row per date of the calendar, whatever its number of rows."""
    first = rows.groupBy(*by, "begin").agg(F.max("end").alias("end"))
    order = Window.partitionBy(*by).orderBy("begin")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = first.withColumn("_new", F.when(reached.isNull() | (F.col("begin") > reached), 1).otherwise(0))
    runs = cut.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy(*by, "_run").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).drop("_run")


def sums_at(weighted: DataFrame, points: DataFrame, point: str, metrics: Sequence[str], materialize: Materializer) -> DataFrame:
    """(points' columns, metric, value): for every point and metric the weight of the intervals that hold the point.

    ``weighted``: (metric, begin, end, weight).  Every begin has its end, so a metric's running sum is back at 0 where the next begins."""
    begins = weighted.groupBy("metric", F.col("begin").alias("_d")).agg(F.sum("weight").alias("_n")).withColumn("_step", F.lit(0))
    ends = weighted.groupBy("metric", F.col("end").alias("_d")).agg((-F.sum("weight")).alias("_n")).withColumn("_step", F.lit(2))
    reads = points.select(F.col(point).alias("_d")).filter("_d is not null").distinct() \
        .select(F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric"), "_d", F.lit(0).cast("long").alias("_n"), F.lit(1).alias("_step"))
    steps = begins.unionByName(reads).unionByName(ends)
    at = running_sum(steps, ("metric", "_d", "_step"), "_n", out="value", materialize=materialize).filter("_step = 1")
    return points.join(at, F.col(point) == F.col("_d")).select(*points.columns, "metric", F.col("value").cast("long").alias("value"))


class Calendar:
    """Sets of periods as bit masks: the periods (bl_bill_id, bill_date) by date, ``BITS`` of them to a column ``m0``, ``m1``, ...

    The periods in an interval follow each other, so two lookups in an array with an entry per day give its mask.  Bill
    dates are days; a time of day in one fails the query."""

    BITS = 62

    def __init__(self, periods: DataFrame, materialize: Materializer):
        day = F.col("bill_date").cast("date")
        timed = F.raise_error(F.concat(F.lit("a bill date with a time of day: "), F.col("bill_date").cast("string"))).cast("date")
        known = periods.filter("bl_bill_id is not null and bill_date is not null") \
            .select("bl_bill_id", F.when(F.col("bill_date") == day, day).otherwise(timed).alias("bill_date")).distinct()
        at = F.row_number().over(Window.orderBy("bill_date", "bl_bill_id")) - 1     # one row per period
        numbered = materialize(known.withColumn("_at", at), "history-calendar")
        self.n, ids = numbered.agg(F.count("*"), F.count_distinct("bl_bill_id")).first()
        self.repeated = ids < self.n            # an id with several dates
        self.masks = [f"m{w}" for w in range(max(1, -(-self.n // self.BITS)))]
        self.days = numbered.select("bl_bill_id", *[
            F.when(F.floor(F.col("_at") / self.BITS) == w, _shifted(F.col("_at") % self.BITS)).otherwise(F.lit(0).cast("long")).alias(m)
            for w, m in enumerate(self.masks)])
        sorted_ = F.array_sort(F.collect_list(F.struct("_at", "bl_bill_id", "bill_date")))
        found = numbered.agg(F.min("bill_date").alias("first"), F.max("bill_date").alias("last"), sorted_.alias("all"))
        before = F.transform(F.sequence(F.lit(0), F.date_diff("last", "first") + 1),
                             lambda k: F.size(F.filter("all", lambda p: F.date_diff(p["bill_date"], F.col("first")) < k)))
        self._of = found.select(F.struct("first", before.alias("before"), F.col("all.bl_bill_id").alias("ids")).alias("c")).scalar()

    def in_force(self, begin: str = "begin", end: str = "end") -> list[Column]:
        """The periods whose dates an interval holds."""
        b, e = F.col(begin).cast("date"), F.col(end).cast("date")
        before = self._of["before"]
        count = lambda days: F.get(before, F.least(F.greatest(days, F.lit(0)), F.size(before) - 1))
        low = count(F.date_diff(b, self._of["first"]) + F.when(F.col(begin) > b, 1).otherwise(0))
        high = count(F.date_diff(e, self._of["first"]) + 1)
        first = lambda n, w: _shifted(F.least(F.greatest(n - w * self.BITS, F.lit(0)), F.lit(self.BITS))) - 1
        return [F.when(F.col(begin) <= F.col(end), first(high, w).bitwiseAND(F.bitwise_not(first(low, w)))) for w in range(len(self.masks))]

    def both(self, a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
        return [x.bitwiseAND(y).alias(m) for x, y, m in zip(a, b, self.masks)]

    def some(self) -> Column:
        return reduce(Column.__or__, [F.col(m) != 0 for m in self.masks])

    def combined(self, rows: DataFrame, *by: str) -> DataFrame:
        """Per key the periods of any of its rows."""
        return rows.groupBy(*by).agg(*[F.bit_or(m).alias(m) for m in self.masks])

    def exploded(self, rows: DataFrame) -> DataFrame:
        """One row per period (bl_bill_id) of every row; a period of several dates comes once."""
        def set_of(mask: str, start: int) -> Column:
            every = F.sequence(F.lit(start), F.lit(min(self.n, start + self.BITS) - 1))
            return F.filter(every, lambda at: F.col(mask).bitwiseAND(_shifted(at - start)) != 0)

        set_ = [set_of(m, w * self.BITS) for w, m in enumerate(self.masks)]
        each = rows.withColumn("_at", F.explode(F.concat(*set_) if self.n else F.array().cast("array<int>"))).withColumn("bl_bill_id", F.get(self._of["ids"], F.col("_at"))).drop("_at", *self.masks)
        return each.distinct() if self.repeated else each


def _shifted(by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), by.cast("int"))


class MonthlyHistory:
    """M01-M19 of every closed period over one set of billing tables."""

    def __init__(self, tables: BillingTables, rules: Rules, materialize: Materializer = to_shared_parquet):
        self.t, self.rules, self.materialize = tables, rules, materialize
        self.periods = tables["bl_bill_periods"].filter(F.col("period_status") == F.lit(CLOSED)).select("bl_bill_id", "bill_date")
        self._shared: dict[str, DataFrame] = {}

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What several metrics read, written once."""
        if name not in self._shared:
            self._shared[name] = self.materialize(build(), f"history-{name}")
        return self._shared[name]

    def _versions(self, name: str, *columns: Column | str, where: Column | None = None) -> DataFrame:
        """Active versions of a table with the interval in which they are in force."""
        rows = self.t[name].filter(flag_is("is_active") & (F.col("date_begin") <= F.col("date_end")))
        return (rows if where is None else rows.filter(where)).select(*columns, F.col("date_begin").alias("begin"), F.col("date_end").alias("end"))

    def open_accounts(self) -> DataFrame:
        return self._once("accounts", lambda: self._versions(
            "us_flat_account_ver", F.col("us_flat_account_kid").alias("account"), "num_account", "tu_rlty_kid",
            where=F.col("us_baseclose_doc_id").isNull()))

    def bindings(self) -> DataFrame:
        return self._versions("cd_const_service_bunch", F.col("us_cntr_svc_id").alias("cntr_service_key_id"), "cd_cntr_kid")

    def contracts(self) -> DataFrame:
        return self._versions("cn_contract", "cntr_contract_key_id", "contract_nmbr", where=F.col("cntr_status_id") == 5)

    def contract_services(self) -> DataFrame:
        """(account, contract, realty, service, name, meter, begin, end): every contract service of an account or, if that is NULL, a firm
        x its bindings (interval NULL without one), whenever; name, contract and realty where a metric reads them, else NULL."""
        def build():
            r = self.rules
            keys = self.t["cn_contract_key"].select("cntr_contract_key_id", F.col("us_account_id").alias("account"))
            services = self.t["cn_service_key"].select("cntr_service_key_id", "cntr_contract_key_id", "tu_rlty_kid", "ns_svc_id")
            names = self.t["ns_svc_ref"].filter(like_any("name", r.cold_service + r.hot_service_meter + r.hot_service_house)).select("ns_svc_id", "name")
            firm, named = F.col("account").isNull(), F.col("name").isNotNull()
            owned = keys.join(services, "cntr_contract_key_id").join(names, "ns_svc_id", "left").select(
                "account", "cntr_service_key_id", "name", F.when(firm | named, F.col("cntr_contract_key_id")).alias("cntr_contract_key_id"),
                F.when(firm, F.col("tu_rlty_kid")).alias("tu_rlty_kid"))
            return owned.join(self.bindings(), "cntr_service_key_id", "left")
        return self._once("services", build)

    def charged(self) -> DataFrame:
        """Cold or hot service of an account, with its bindings (``bound_begin``, ``bound_end``) x service version with a tariff that is not zero."""
        r = self.rules
        cold, hot = like_any("name", r.cold_service), like_any("name", r.hot_service_meter)
        services = self.contract_services().filter(F.col("account").isNotNull() & (cold | hot)).drop("tu_rlty_kid") \
            .withColumnsRenamed({"begin": "bound_begin", "end": "bound_end"}).withColumns({"cold": cold, "hot": hot})
        tariffs = self.t["ns_tariff_plan"].filter(not_like("name", r.zero_tariff)).select("ns_tariff_plan_id")
        versions = self._versions("cn_service", "cntr_contract_key_id", "cntr_service_key_id", "ns_tariff_plan_id")
        return services.join(versions, ["cntr_contract_key_id", "cntr_service_key_id"]).join(tariffs, "ns_tariff_plan_id").drop("ns_tariff_plan_id")

    def species(self) -> DataFrame:
        names = self.t["tu_realty_species_ref"].select("tu_rlty_spcs_id", F.col("name").alias("species"))
        return self.t["tu_realty_key"].join(names, "tu_rlty_spcs_id").select("tu_rlty_kid", "ns_adr_id", "species")

    def metered(self, charged: DataFrame) -> DataFrame:
        """Charged services x their active meters, while both are in force."""
        active = self.t["cd_counter"].filter(flag_is("is_active")).select("cd_cntr_kid")
        both = charged.filter(F.col("bound_begin").isNotNull()).withColumns(
            {"begin": F.greatest("begin", "bound_begin"), "end": F.least("end", "bound_end")}).filter(F.col("begin") <= F.col("end"))
        return both.join(active, "cd_cntr_kid")

    def multi_flat(self) -> DataFrame:
        """Open accounts with the number of their realty's multi-flat rows."""
        multi = self.species().filter(in_list("species", self.rules.multi_flat_species)).groupBy("tu_rlty_kid").agg(F.count("*").alias("multi"))
        return self.open_accounts().join(multi, "tu_rlty_kid", "left").select("account", F.coalesce("multi", F.lit(0)).alias("multi"), "begin", "end")

    def houses(self) -> DataFrame:
        """(metric, house, begin, end) of M06-M11: houses of open accounts, in all and with a bound cold or hot service."""
        r = self.rules
        group = F.when(in_list("species", r.multi_flat_species), 0).when(in_list("species", r.private_species), 3)
        places = self.species().join(self.t["ns_address"].select("ns_adr_id", "ns_hos_id"), "ns_adr_id")
        housed = self.open_accounts().join(places, "tu_rlty_kid").withColumn("group", group).filter(F.col("group").isNotNull()) \
            .select("account", "group", "ns_hos_id", "begin", "end")
        kinds = F.array_compact(F.array(F.when(like_any("name", r.cold_service), 1), F.when(like_any("name", r.hot_service_house), 2)))
        bound = self.contract_services().filter("account is not null and begin is not null").withColumn("kind", F.explode(kinds)) \
            .select("account", "kind", "begin", "end")
        served = intersected(housed, united(bound, ("account", "kind")), "account")
        rows = housed.withColumn("kind", F.lit(0)).select("group", "kind", "ns_hos_id", "begin", "end") \
            .union(served.select("group", "kind", "ns_hos_id", "begin", "end"))
        metric = F.format_string("M%02d", F.col("group") + F.col("kind") + 6)
        return rows.select(metric.alias("metric"), "ns_hos_id", "begin", "end")

    def readings(self, calendar: Calendar) -> DataFrame:
        """(meter, channel, periods): the closed periods in which a reading of the channel counts."""
        channels = tuple(dict.fromkeys(self.rules.reading_channels + self.rules.corporate_channels))
        names = self.t["cd_indication_source"].filter(in_list("name", channels)).select("cd_indic_src_id", F.col("name").alias("channel"))
        counting = latest_max_reading(self.t["cd_indication"].join(self.periods.select("bl_bill_id"), "bl_bill_id", "left_semi"))
        days = calendar.combined(calendar.days, "bl_bill_id")
        sources = calendar.combined(counting.select("bl_bill_id", "cd_cntr_kid", "cd_indic_src_id").join(days, "bl_bill_id"), "cd_cntr_kid", "cd_indic_src_id")
        return calendar.combined(sources.join(names, "cd_indic_src_id"), "cd_cntr_kid", "channel")

    def reading_metrics(self) -> DataFrame:
        """(bl_bill_id, metric, channel, value) of M03-M05."""
        calendar = Calendar(self.periods, self.materialize)
        masks = calendar.masks
        meters = self._once("readings", lambda: self.readings(calendar)).withColumnsRenamed({m: f"read_{m}" for m in masks})

        def read(bound: DataFrame, channels: Sequence[str], *columns: str) -> DataFrame:
            """Rows with a meter and an interval x the channels of the meter's readings, with the periods of both."""
            held = bound.select(*columns, "cd_cntr_kid", *[c.alias(m) for c, m in zip(calendar.in_force(), masks)]).filter(calendar.some())
            rows = held.join(meters.filter(in_list("channel", channels)), "cd_cntr_kid")
            return rows.select(*columns, "channel", *calendar.both([F.col(m) for m in masks], [F.col(f"read_{m}") for m in masks])).filter(calendar.some())

        bound = self.contract_services().filter("begin is not null")
        seen = calendar.combined(read(bound.filter("account is not null"), self.rules.reading_channels, "account"), "account", "channel")
        versions = self.open_accounts().select("account", "num_account", *[c.alias(f"open_{m}") for c, m in zip(calendar.in_force(), masks)])
        open_then = seen.join(versions, "account").select(
            "num_account", "channel", *calendar.both([F.col(m) for m in masks], [F.col(f"open_{m}") for m in masks])).filter(calendar.some())
        told = self.materialize(calendar.combined(open_then, "num_account", "channel"), "history-told")
        by_channel = calendar.exploded(told).groupBy("bl_bill_id", "channel").agg(F.count("num_account").alias("value"))
        in_all = calendar.exploded(calendar.combined(told, "num_account")).groupBy("bl_bill_id").agg(F.count("num_account").alias("value"))
        contracts = (self.contracts().join(self.t["cn_realty_bunch_key"].select("cntr_contract_key_id", "tu_rlty_kid"), "cntr_contract_key_id")
                     .join(self.t["tu_realty_key"].select("tu_rlty_kid"), "tu_rlty_kid"))
        held = intersected(contracts, self._versions("tu_realty", "tu_rlty_kid"), "tu_rlty_kid")
        corporate = bound.filter("account is null").select("cntr_contract_key_id", "tu_rlty_kid", "cd_cntr_kid", "begin", "end")
        firm = intersected(held, corporate, ["cntr_contract_key_id", "tu_rlty_kid"])
        firms = calendar.exploded(calendar.combined(read(firm, self.rules.corporate_channels, "contract_nmbr"), "contract_nmbr")) \
            .groupBy("bl_bill_id").agg(F.count("contract_nmbr").alias("value"))
        total = lambda df, m: self.periods.select("bl_bill_id").join(df, "bl_bill_id", "left").select(
            "bl_bill_id", F.lit(m).alias("metric"), F.lit(None).cast("string").alias("channel"), F.coalesce("value", F.lit(0)).alias("value"))
        return total(in_all, "M03").union(by_channel.select("bl_bill_id", F.lit("M04"), "channel", "value")).union(total(firms, "M05"))

    def metrics(self) -> DataFrame:
        """(bl_bill_id, metric, channel, value): M01-M19 of every closed period, 0 included; channel is NULL but for M04."""
        charged = self.materialize(self.charged().select(
            "account", "name", "cold", "hot", "cd_cntr_kid", "bound_begin", "bound_end", "begin", "end"), "history-charged")
        metered = self.materialize(self.metered(charged).select("account", "name", "cold", "hot", "begin", "end"), "history-metered")
        accounts = self.open_accounts().select("account", "num_account", "begin", "end")
        parties = self.t["us_counteragent"].select("us_counteragent_id", "ns_user_typ_id").join(
            self.t["ns_user_type"].filter(F.col("name") != F.lit(self.rules.individual_user_type)).select("ns_user_typ_id"), "ns_user_typ_id")
        served = self.t["cn_contract_key"].select("cntr_contract_key_id", "us_counteragent_id").join(parties, "us_counteragent_id")
        one = F.lit(1).cast("long").alias("weight")
        span = ("begin", "end")
        rows = [self.open_accounts().select(F.lit("M01").alias("metric"), *span, one),
                self.contracts().join(served, "cntr_contract_key_id").select(F.lit("M02").alias("metric"), *span, one)]
        for kind, (all_of, multi, _, _) in _KINDS.items():
            counted = F.explode(F.array(F.struct(F.lit(all_of).alias("metric"), one),
                                        F.struct(F.lit(multi).alias("metric"), F.col("multi").alias("weight"))))
            rows.append(intersected(metered.filter(kind).select("account", *span), self.multi_flat(), "account")
                        .withColumn("_counted", counted).select("_counted.metric", *span, "_counted.weight"))
        entities = [self.houses()]
        for kind, (_, _, with_meter, with_service) in _KINDS.items():
            entities += [intersected(united(metered.filter(kind), ("account", "name")), accounts, "account")
                         .select(F.lit(with_meter).alias("metric"), "num_account", "name", *span),
                         intersected(united(charged.filter(kind), ("account",)), accounts, "account")
                         .select(F.lit(with_service).alias("metric"), "num_account", *span)]
        # what is counted once: a house, an account or an account's service name; a NULL is a value of its own
        counted_once = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), entities)
        once = united(counted_once, ("metric", "ns_hos_id", "num_account", "name")).select("metric", *span, one)
        weighted = reduce(DataFrame.unionByName, rows).unionByName(once)
        counted = sums_at(weighted, self.periods, "bill_date", ROWS + ENTITIES, self.materialize)
        return counted.select("bl_bill_id", "metric", F.lit(None).cast("string").alias("channel"), "value").unionByName(self.reading_metrics())


# By kind of service: metered rows, those of multi-flat houses, accounts with a meter, accounts with the service.
_KINDS = {"cold": ("M12", "M13", "M14", "M15"), "hot": ("M16", "M17", "M18", "M19")}
