"""Billing-shaped tables derived from the generic test tables.

The billing reports read about thirty relational tables (periods, account
versions, contracts, services, meter bindings, readings, addresses, shard
snapshots).  The test data is a TPC-H-like star schema, so each billing table
is a *stand-in view* over it.  Every view is written once, as SQL text in the
dialect that Spark SQL and DuckDB share, so that:

* the Spark side builds each stand-in with ``spark.sql(text, **frames)`` where
  the ``{name}`` placeholders are bound to DataFrames (no global temp views,
  so several scale factors can live in one session), and
* the DuckDB oracle inlines the same text as CTEs (``oracle_with``).

Nothing here is collected; every view is a lazy plan over the Parquet scan,
so Catalyst prunes columns and pushes filters into the scan per query.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# name -> SQL text.  ``{x}`` names a base table or an earlier stand-in.
# Order matters: a view may only use views defined above it.
VIEWS: dict[str, str] = {}

VIEWS["bl_bill_periods"] = """
SELECT m.bl_bill_id,
       m.bill_date,
       'P' || cast(m.bl_bill_id AS string) AS bill_name,
       CASE WHEN m.bl_bill_id = (SELECT cast(max(year(o_orderdate) * 100 + month(o_orderdate)) AS bigint)
                                 FROM {orders})
            THEN 'O' ELSE 'C' END AS period_status
FROM (SELECT DISTINCT
             cast(year(o_orderdate) * 100 + month(o_orderdate) AS bigint) AS bl_bill_id,
             cast(date_trunc('month', o_orderdate) AS date) AS bill_date
      FROM {orders}) m
"""

VIEWS["us_flat_account_ver"] = """
SELECT o_custkey AS us_flat_account_kid,
       o_custkey AS num_account,
       o_custkey AS tu_rlty_kid,
       CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS is_active,
       CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey END AS us_baseclose_doc_id,
       cast(o_orderdate AS date) AS date_begin,
       coalesce(cast(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
                     - INTERVAL 1 DAY AS date),
                DATE '9999-12-31') AS date_end
FROM {orders}
"""

VIEWS["cn_contract_key"] = """
SELECT o_orderkey AS cntr_contract_key_id,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS us_account_id,
       o_custkey AS us_counteragent_id
FROM {orders}
"""

VIEWS["cn_contract"] = """
SELECT o_orderkey AS cntr_contract_key_id,
       '42-' || cast(o_orderkey AS string) AS contract_nmbr,
       CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS is_active,
       CASE WHEN o_orderpriority = '5-LOW' THEN 4 ELSE 5 END AS cntr_status_id,
       cast(o_orderdate AS date) AS date_begin,
       DATE '9999-12-31' AS date_end
FROM {orders}
"""

VIEWS["us_counteragent"] = """
SELECT c_custkey AS us_counteragent_id,
       c_mktsegment AS ns_user_typ_id,
       c_custkey AS us_corp_id
FROM {customer}
"""

VIEWS["ns_user_type"] = """
SELECT DISTINCT c_mktsegment AS ns_user_typ_id, c_mktsegment AS name FROM {customer}
"""

VIEWS["us_corp_card"] = """
SELECT c_custkey AS us_corp_id, c_name AS name FROM {customer}
"""

VIEWS["cn_service_key"] = """
SELECT g.l_orderkey * 10 + g.l_linenumber AS cntr_service_key_id,
       g.l_orderkey AS cntr_contract_key_id,
       g.ns_svc_id,
       o.o_custkey AS tu_rlty_kid
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS ns_svc_id
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber) g
JOIN {orders} o ON o.o_orderkey = g.l_orderkey
"""

VIEWS["cd_const_service_bunch"] = """
SELECT l_orderkey * 10 + l_linenumber AS us_cntr_svc_id,
       min(l_suppkey) AS cd_cntr_kid,
       CASE WHEN min(l_returnflag) = 'R' THEN 0 ELSE 1 END AS is_active,
       cast(min(l_shipdate) AS date) AS date_begin,
       DATE '9999-12-31' AS date_end
FROM {lineitem}
GROUP BY l_orderkey, l_linenumber
"""

VIEWS["cn_service"] = """
SELECT l_orderkey AS cntr_contract_key_id,
       l_orderkey * 10 + l_linenumber AS cntr_service_key_id,
       min(l_partkey) AS ns_tariff_plan_id,
       CASE WHEN min(l_quantity) > 45 THEN 0 ELSE 1 END AS is_active,
       cast(min(l_shipdate) AS date) AS date_begin,
       DATE '9999-12-31' AS date_end
FROM {lineitem}
GROUP BY l_orderkey, l_linenumber
"""

VIEWS["ns_svc_ref"] = """
SELECT p_partkey AS ns_svc_id, p_name AS name FROM {part}
"""

VIEWS["ns_tariff_plan"] = """
SELECT p_partkey AS ns_tariff_plan_id, p_type AS name FROM {part}
"""

VIEWS["cd_counter"] = """
SELECT s_suppkey AS cd_cntr_kid,
       CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS is_active,
       s_name AS ser_number,
       'SN-' || cast(s_suppkey AS string) AS cntr_number
FROM {supplier}
"""

VIEWS["cd_indication"] = """
SELECT l_suppkey AS cd_cntr_kid,
       cast(year(l_shipdate) * 100 + month(l_shipdate) AS bigint) AS bl_bill_id,
       cast(l_shipdate AS date) AS date_ind_take,
       l_quantity AS value,
       l_returnflag || l_linestatus AS cd_indic_src_id
FROM {lineitem}
"""

VIEWS["cd_indication_source"] = """
SELECT DISTINCT l_returnflag || l_linestatus AS cd_indic_src_id,
                l_returnflag || l_linestatus AS name
FROM {lineitem}
"""

VIEWS["cn_realty_bunch_key"] = """
SELECT o_orderkey AS cntr_contract_key_id, o_custkey AS tu_rlty_kid FROM {orders}
"""

VIEWS["tu_realty_key"] = """
SELECT c_custkey AS tu_rlty_kid, c_custkey AS ns_adr_id, c_mktsegment AS tu_rlty_spcs_id
FROM {customer}
"""

VIEWS["tu_realty_species_ref"] = """
SELECT DISTINCT c_mktsegment AS tu_rlty_spcs_id, c_mktsegment AS name FROM {customer}
"""

VIEWS["tu_realty"] = """
SELECT c_custkey AS tu_rlty_kid,
       CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS is_active,
       DATE '1995-01-01' AS date_begin,
       DATE '9999-12-31' AS date_end
FROM {customer}
"""

VIEWS["ns_address"] = """
SELECT c_custkey AS ns_adr_id,
       c_custkey % 300 AS ns_hos_id,
       nullif(c_custkey % 7, 0) AS flat
FROM {customer}
"""

VIEWS["ns_house"] = """
SELECT h AS ns_hos_id,
       h AS house,
       nullif(h % 4, 0) AS corpus,
       nullif(h % 5, 0) AS building,
       CASE WHEN h % 10 = 0 THEN NULL ELSE h % 25 END AS ns_strt_id,
       CASE WHEN h % 20 = 0 THEN NULL ELSE h % 5 END AS ns_twn_id
FROM (SELECT DISTINCT c_custkey % 300 AS h FROM {customer}) hs
"""

# One street type and one town type; the type ids are computed from a column
# (not a literal) so the joins stay equi-joins, as on real id columns.
VIEWS["ns_street"] = """
SELECT cast(n_nationkey AS bigint) AS ns_strt_id,
       n_name AS name,
       cast(n_nationkey % 1 + 1 AS int) AS ns_strttyp_id,
       CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE cast(n_regionkey AS bigint) END AS ns_twn_id
FROM {nation}
"""

VIEWS["ns_street_type"] = """
SELECT DISTINCT cast(n_nationkey % 1 + 1 AS int) AS ns_strttyp_id, 'st.' AS short_name FROM {nation}
"""

VIEWS["ns_town"] = """
SELECT cast(r_regionkey AS bigint) AS ns_twn_id, r_name AS name, cast(r_regionkey % 1 + 1 AS int) AS ns_twntyp_id
FROM {region}
"""

VIEWS["ns_town_type"] = """
SELECT DISTINCT cast(r_regionkey % 1 + 1 AS int) AS ns_twntyp_id, 't.' AS short_name FROM {region}
"""

VIEWS["cn_char_type"] = """
SELECT DISTINCT cast(length(event_type) * 0 + 1 AS int) AS char_type_id, 'object' AS name FROM {events}
"""

VIEWS["cn_chrctrstc_group"] = """
SELECT DISTINCT cast(length(event_type) * 0 + 10 AS int) AS cn_chrctrstc_group_id,
       cast(length(event_type) * 0 + 1 AS int) AS char_type_id
FROM {events}
"""

VIEWS["cn_characteristic_ref"] = """
SELECT DISTINCT event_type AS cn_chrct_id,
                upper(event_type) AS code,
                event_type AS name,
                cast(length(event_type) * 0 + 10 AS int) AS cn_chrctrstc_group_id
FROM {events}
"""

VIEWS["attributes"] = """
SELECT user_id AS object_id,
       event_type AS cn_chrct_id,
       cast(value AS string) AS value,
       ts AS date_begin,
       coalesce(lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id),
                TIMESTAMP '9999-12-31 00:00:00') AS date_end
FROM {events}
"""

# Shard side (the consolidation job): nine identically shaped databases.
VIEWS["nanim"] = """
SELECT cast(o_custkey % 9 AS int) AS shard_idx,
       o_custkey AS lic,
       o_orderpriority AS fio,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS close_ls,
       o_custkey % 300 AS adres_id,
       cast(o_custkey % 7 AS int) AS kv,
       CASE WHEN o_custkey % 11 = 0 THEN 'a' END AS kv2,
       cast(date_trunc('month', o_orderdate) AS date) AS data_my
FROM {orders}
"""

VIEWS["dom"] = """
SELECT h AS id,
       CASE WHEN h % 10 = 0 THEN NULL ELSE h % 25 END AS ul_id,
       CASE WHEN h % 13 = 0 THEN NULL ELSE cast(h AS string) END AS dom,
       CASE WHEN h % 6 = 0 THEN '/' || cast(h % 4 AS string) WHEN h % 6 = 1 THEN '' END AS dom2,
       CASE WHEN h % 8 = 0 THEN cast(h % 3 + 1 AS string) WHEN h % 8 = 1 THEN '' END AS korp
FROM (SELECT DISTINCT o_custkey % 300 AS h FROM {orders}) hs
"""

VIEWS["ulicy"] = """
SELECT cast(n_nationkey AS bigint) AS id,
       n_name AS name,
       CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_regionkey END AS city_id
FROM {nation}
"""

VIEWS["city"] = """
SELECT r_regionkey AS id,
       CASE WHEN r_regionkey = 0 THEN '' ELSE r_name END AS name
FROM {region}
"""

_REF = re.compile(r"\{(\w+)\}")


def dependencies(name: str) -> list[str]:
    """Stand-ins (transitively) used by ``name``, in definition order, itself last."""
    seen: list[str] = []

    def visit(n: str) -> None:
        for dep in _REF.findall(VIEWS[n]):
            if dep in VIEWS and dep not in seen:
                visit(dep)
        if n not in seen:
            seen.append(n)

    visit(name)
    return seen


def oracle_with(*names: str) -> str:
    """A ``WITH`` clause defining the given stand-ins (and what they use) for DuckDB.

    The base tables are pre-registered views in the oracle, so ``{orders}``
    simply becomes ``orders``.
    """
    order: list[str] = []
    for n in names:
        for d in dependencies(n):
            if d not in order:
                order.append(d)
    order.sort(key=list(VIEWS).index)
    parts = [f"{n} AS ({_REF.sub(lambda m: m.group(1), VIEWS[n]).strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n"


class Standins:
    """Lazy DataFrames of the billing tables over one scale-factor directory.

    ``Standins.of(spark, sf_dir)`` returns one shared set per session and
    directory: the frames are immutable plans (no data is cached), so defining
    them once saves re-analysing ~30 views for every query.
    """

    _shared: dict[tuple[SparkSession, str], "Standins"] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Standins":
        key = (spark, str(sf_dir).rstrip("/"))
        if key not in cls._shared:
            cls._shared[key] = cls(spark, sf_dir)
        return cls._shared[key]

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEWS and name not in BASE_TABLES:
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        if name not in self._frames:
            text = VIEWS[name]
            refs = {r: self[r] for r in set(_REF.findall(text))}
            self._frames[name] = self.spark.sql(text, **refs)
        return self._frames[name]

    @cached_property
    def names(self) -> tuple[str, ...]:
        return tuple(VIEWS)
