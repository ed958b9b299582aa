"""Spark session settings and the shared work folder.

Everything the library writes for itself (fixture lakes, round trips,
lineage cuts) goes under the folder named by ``spark.checkpoint.dir``; a
local fallback is only created when the session does not name one (tests).
"""
from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library expects; AQE re-plans joins and coalesces
# shuffle partitions at runtime, skew join splits a hot key's partition.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # checkpointed small aggregates are removed once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app_name: str = "ridelake",
              shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. A local one is created only when the
    session names none and runs in local mode (tests); a cluster session without
    ``spark.checkpoint.dir`` is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            # a folder on the driver's disk is not visible to executors
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(work tables and lineage cuts are written there)")
        named = tempfile.mkdtemp(prefix="ridelake-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for one written table."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/ridelake/{name}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed now. Spark removes them when the driver's garbage collector finds
    that nothing refers to them any more; a driver that has little to do collects seldom, and the
    files of a long load's steps would stay side by side."""
    gc.collect()       # Python's handles on plans first
    for _ in range(2):      # listeners may still hold the last plan the first time
        spark._jvm.System.gc()
        time.sleep(0.3)


def apply_session_conf(spark: SparkSession) -> None:
    """What a query needs from a session it did not create: a checkpoint folder
    (small multi-use aggregates are checkpointed). Other settings of the
    caller's session are left alone; the library is time-zone independent
    (naive timestamps throughout) and passes write modes per write."""
    ensure_checkpoint_dir(spark)
