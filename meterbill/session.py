"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a billing job wants on any cluster: AQE re-plans joins from runtime
# sizes (a shuffle stage under the broadcast threshold becomes a broadcast hash
# join, a skewed partition is split), coalesces small shuffle partitions, and
# the session time zone is pinned so DATE/TIMESTAMP literals mean the same on
# every executor.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Additional settings for a large cluster (order of 1000 executors, ~100 TB of
# billing tables).  Shuffles start with many partitions and AQE coalesces them
# to ~256 MB each, so the same job fits one period or a year of readings; a
# partition over 1 GB and 5x the median is split by the skew-join rule; the
# static broadcast threshold stays small (a broadcast is copied to every
# executor) while AQE may still broadcast a side whose *measured* size is
# small after a shuffle.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "meterbill",
                shuffle_partitions: int | None = None, extra: dict | None = None,
                profile: str = "local") -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a
    cluster they come from the submit configuration, and ``profile="cluster"``
    adds ``CLUSTER_CONF``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables and lineage cuts.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  Only where it is
    unset and the master is local, as in tests, a fresh folder is created and
    registered as the checkpoint directory of this session; on a cluster that
    folder would be another disk on every machine, so there it is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not (sc.master or "").startswith("local") or (sc.master or "").startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="meterbill-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused between runs)."""
    return os.path.join(shared_dir(spark), "meterbill", f"{name}-{uuid.uuid4().hex}")
