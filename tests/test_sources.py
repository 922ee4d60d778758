"""Sources and sinks: SQL-file source, shard union, full refresh, report file,
legacy charset, shared-folder placement."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from meterbill.session import scratch_path, shared_dir
from meterbill.sources import charset, sinks
from meterbill.sources.jdbc import read_sql_file
from meterbill.sources.materialize import to_shared_parquet
from meterbill.sources.shards import read_shards
from tests.conftest import SF_SMALL


def test_shared_dir_comes_from_session_conf(spark):
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = shared_dir(spark)
    if conf:
        assert root == conf.rstrip("/")
    else:
        assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    p = scratch_path(spark, "x")
    assert p.startswith(root) and p != scratch_path(spark, "x")


def test_materialized_frame_lives_in_shared_folder(spark):
    df = spark.range(10).withColumn("y", F.col("id") * 2)
    out = to_shared_parquet(df, "probe")
    assert sorted(r.y for r in out.collect()) == [2 * i for i in range(10)]
    root = shared_dir(spark).lstrip("/")
    assert out.inputFiles() and all(root in f for f in out.inputFiles())


def test_sql_file_source(spark, tmp_path):
    from meterbill.sources.standins import Standins
    t = Standins(spark, SF_SMALL)
    path = tmp_path / "q.sql"
    path.write_text("-- open accounts of one status\n"
                    "select count(*) as n from {fa} where is_active = 1;\n", encoding="utf-8")
    got = read_sql_file(spark, str(path), fa=t.us_flat_account_ver).first().n
    assert got == t.us_flat_account_ver.filter("is_active = 1").count()


def test_shard_union_renames_and_tags(spark):
    def read_one(b):
        return spark.createDataFrame([(b * 10, "x"), (b * 10 + 1, "y")], "a long, b string")
    out = read_shards(read_one, [1, 2, 3, 4, 5], names=("ls", "fio"))
    assert out.columns == ["ls", "fio", "base"]
    assert sorted((r.base, r.ls) for r in out.collect())[:2] == [(1, 10), (1, 11)]
    assert dict(out.dtypes)["base"] == "int"


def test_full_refresh_replaces(spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.full_refresh(spark.range(5), target)
    assert sinks.read_target(spark, target).count() == 5
    sinks.full_refresh(spark.range(3), target)
    assert sinks.read_target(spark, target).count() == 3


def test_failed_refresh_leaves_the_old_target(spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.full_refresh(spark.range(5), target)
    bad = spark.range(3).withColumn("x", F.raise_error(F.lit("source failed")).cast("int"))
    with pytest.raises(Exception, match="source failed"):
        sinks.full_refresh(bad, target)
    assert sinks.read_target(spark, target).count() == 5


def test_newest_snapshot_query_names_the_newest_stamp():
    from meterbill.sources.shards import newest_snapshot_sql
    assert newest_snapshot_sql("nanim") == "select * from nanim where data_my = (select max(data_my) from nanim)"


def test_shared_dir_needs_a_shared_folder_on_a_cluster():
    """Without spark.checkpoint.dir a cluster has no folder all executors share."""
    from types import SimpleNamespace
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                         getConf=lambda: SimpleNamespace(get=lambda k, d: d))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(SimpleNamespace(sparkContext=sc))


def test_report_sink_single_file_with_header(spark, tmp_path):
    df = spark.createDataFrame([(1, "a, b", None), (2, "'x", "5")], "seq int, parameter string, value string")
    path = str(tmp_path / "r")
    sinks.report_sink(df, path)
    files = glob.glob(os.path.join(path, "*.csv"))
    assert len(files) == 1
    head = open(files[0], encoding="utf-8").readline().strip()
    assert head == "seq,parameter,value"
    back = spark.read.option("header", True).schema(df.schema).csv(path)
    assert sorted(map(tuple, back.collect())) == [(1, "a, b", None), (2, "'x", "5")]


def test_legacy_charset_round_trip_restores_flag(spark, tmp_path):
    before = spark.conf.get(charset.LEGACY_CHARSETS_FLAG, None)
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(1, "Киров г")], "id int, name string")
    with charset.legacy_charsets(spark):
        charset.write_csv(df, path)
        raw = spark.read.text(path).filter(~F.col("value").startswith("id")).first()[0]
        back = charset.read_csv(spark, path, df.schema).first()
    enc = df.select(charset.encode_text("name").alias("b")).first().b
    assert enc == "Киров г".encode("windows-1251")
    every = bytes(b for b in range(256) if b != 0x98)       # the one place without a character
    both = spark.createDataFrame([(every,)], "b binary").select(charset.decode_text("b").alias("t"), charset.encode_text(charset.decode_text("b")).alias("b")).first()
    assert both.t == every.decode("windows-1251") and bytes(both.b) == every
    assert back.name == "Киров г"
    assert raw != "1,Киров г"           # the file is not UTF-8
    assert len(enc) == len("Киров г")   # one byte per letter
    assert spark.conf.get(charset.LEGACY_CHARSETS_FLAG, None) == before


def test_standins_shared_per_session_and_directory(spark):
    from meterbill.sources.standins import Standins
    from tests.conftest import SF_MID
    a, b = Standins.of(spark, SF_SMALL), Standins.of(spark, SF_SMALL + "/")
    c = Standins.of(spark, SF_MID)
    assert a is b and a is not c
    assert a.orders.count() != c.orders.count()


def test_jdbc_readers_reach_the_jdbc_source(spark):
    """No database may be started here, so the JDBC helpers are exercised up
    to Spark's JDBC source with a URL that no driver accepts: the options are
    well formed and the failure is the driver lookup, nothing in our code."""
    import pytest
    from meterbill.sources.jdbc import read_query, read_table
    url = "jdbc:nodriver:billing"
    calls = [
        lambda: read_query(spark, url, "select 1 from dual"),
        lambda: read_table(spark, url, "cd_indication", partition_column="bl_bill_id",
                           lower_bound=202301, upper_bound=202412, num_partitions=24),
        lambda: read_table(spark, url, "cd_indication",
                           predicates=["bl_bill_id = 202401", "bl_bill_id = 202402"]),
    ]
    for call in calls:
        with pytest.raises(Exception, match="(?i)suitable driver"):
            call().schema


def test_shared_parquet_release_empties_folders(spark):
    from meterbill.sources.materialize import SharedParquet
    mat = SharedParquet()
    out = mat(spark.range(100).withColumn("y", F.col("id") * 2), "probe")
    assert out.agg(F.sum("y")).first()[0] == 9900
    paths = [p for p, _ in mat.written]
    mat.release(spark)
    assert mat.written == []
    assert all(spark.read.parquet(p).count() == 0 for p in paths)
