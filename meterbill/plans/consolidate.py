"""Shard consolidation: newest snapshot of every shard, address rendered,
tagged with the shard id, published as one full refresh.

Plan: every shard's newest snapshot (filtered where it is read) and address dimensions are read once, under the
connection cap, into the shared folder; the snapshot rows are joined with their own shard's dimensions on (base, id).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbill.functions.text import FirebirdAddressLabels, address_null_propagating
from meterbill.operators.snapshots import assert_complete
from meterbill.sources.shards import MAX_PARALLEL_READS, TARGET_COLUMNS, stage_shards
from meterbill.sources.sinks import full_refresh

ShardTables = Callable[[int], dict[str, DataFrame]]
# What the target needs of each shard table.
COLUMNS = {
    "nanim": ("lic", "fio", "close_ls", "adres_id", "kv", "kv2", "data_my"),
    "dom": ("id", "ul_id", "dom", "dom2", "korp"),
    "ulicy": ("id", "name", "city_id"),
    "city": ("id", "name"),
}


def render_accounts(a: DataFrame, dom: DataFrame, ulicy: DataFrame, city: DataFrame,
                    labels: FirebirdAddressLabels, keys: Sequence[str] = (),
                    carry: Sequence[str] = ()) -> DataFrame:
    """Account rows with the Firebird-rule address.  ``keys`` (e.g. ``base``)
    are extra equality keys of every dimension join; ``carry`` are further
    columns of ``a`` kept in the output."""
    k = list(keys)
    dom = dom.select(*k, F.col("id").alias("adres_id"), F.col("ul_id").alias("ul_key"),
                     "dom", "dom2", "korp")
    ul = ulicy.select(*k, F.col("id").alias("ul_key"), F.col("name").alias("street"),
                      F.col("city_id").alias("city_key"))
    ct = city.select(*k, F.col("id").alias("city_key"), F.col("name").alias("city"))
    j = (a.join(dom, [*k, "adres_id"], "left")
         .join(ul, [*k, "ul_key"], "left")
         .join(ct, [*k, "city_key"], "left"))
    addr = address_null_propagating(F.col("city"), F.col("street"), F.col("dom"), F.col("dom2"),
                                    F.col("korp"), F.col("kv"), F.col("kv2"), labels)
    extra = list(dict.fromkeys([*k, *carry]))
    return j.select(*extra, F.col("lic").alias("ls"), "fio", "close_ls", addr.alias("address"), "data_my")


def shard_accounts(tables: dict[str, DataFrame], labels: FirebirdAddressLabels) -> DataFrame:
    """One shard's account rows with the Firebird-rule address."""
    return render_accounts(tables["nanim"], tables["dom"], tables["ulicy"], tables["city"], labels)


def consolidated_accounts(read_shard: ShardTables, bases: Sequence[int], labels: FirebirdAddressLabels, *,
                          max_parallel: int = MAX_PARALLEL_READS) -> DataFrame:
    """All shards' newest snapshots in the target column order.

    Newest snapshot and dimensions of every shard are staged once under the read
    cap, so no older snapshot is written; completeness is checked on what was read; the joins on
    (base, id) and the rendering then run on the staged tables at full
    parallelism.  Shard readers over databases answer with their newest
    snapshot only (``newest_snapshot_sql``); the filter here keeps that result.
    """
    staged, read = stage_shards(read_shard, bases, tuple(COLUMNS), max_parallel=max_parallel, newest={"nanim": "data_my"}, columns=COLUMNS)
    assert_complete(read, bases)
    rendered = render_accounts(staged["nanim"], staged["dom"], staged["ulicy"], staged["city"], labels, keys=("base",))
    return rendered.select(*TARGET_COLUMNS)


def refresh_target(read_shard: ShardTables, bases: Sequence[int], labels: FirebirdAddressLabels, path: str, *,
                   max_parallel: int = MAX_PARALLEL_READS) -> None:
    """Publish the consolidated table; if a shard is not read, the old target stays."""
    full_refresh(consolidated_accounts(read_shard, bases, labels, max_parallel=max_parallel), path)
