"""Session defaults and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    # window arithmetic is in epoch milliseconds; UTC keeps the timestamp_ntz columns in line
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join side is broadcast only while its measured size stays below this
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # state lives on disk, within a memory limit per executor, and is uploaded as deltas
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # sessions of one task are merged before the shuffle, so a busy user costs a row per task
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def get_session(app_name: str = "wakeline", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the defaults above; ``conf`` entries (dots as ``__``) win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of ``spark.checkpoint.dir``.

    On a cluster that setting names storage every executor can reach.  A machine-local
    temporary folder is used only where it is unset (tests, local mode).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="wakeline-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
