"""Session construction and the shared checkpoint folder.

On a cluster the session is built by the launcher and already names
``spark.checkpoint.dir`` (a shared, fault-tolerant folder). We only fill in
our own values where a setting is unset, which is the case in local tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings we want on every session: key -> (our value, Spark's stock default).
# Applied only where the launcher left the setting unset, i.e. it still holds
# Spark's stock default (a runtime conf read always returns a value).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": ("true", "true"),
    "spark.sql.adaptive.coalescePartitions.enabled": ("true", "true"),
    "spark.sql.adaptive.skewJoin.enabled": ("true", "true"),
    "spark.sql.adaptive.localShuffleReader.enabled": ("true", "true"),
    # Streaming state that may grow with the key space lives in RocksDB, not the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": ("true", "false"),
    # One memory budget for all RocksDB instances of an executor (many state partitions each).
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": ("true", "false"),
}
ROCKSDB = DEFAULT_CONF["spark.sql.streaming.stateStore.providerClass"][0]
# Only where state lives in RocksDB: a join partition keeps its four tables in one store, as column families, not in four
# stores that are each loaded, synced and committed in every batch. A started query keeps the format of its checkpoint.
ROCKSDB_CONF = {"spark.sql.streaming.join.stateFormatVersion": ("3", "2")}
LOCAL_CONF = {"spark.sql.session.timeZone": "UTC"}  # local sessions only (tests, bench)


def get_session(master: str | None = None, app: str = "tributary",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a local one for tests and benches."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULT_CONF (and ROCKSDB_CONF) where unset and make sure a checkpoint folder exists."""
    for k, (ours, stock) in [*DEFAULT_CONF.items(), *ROCKSDB_CONF.items()]:
        if k in ROCKSDB_CONF and spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
            continue
        if spark.conf.get(k, None) in (None, "", stock) and not spark.sparkContext.getConf().contains(k):
            try:
                spark.conf.set(k, ours)
            except Exception:  # static conf on an already-running session
                pass
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``. Only on a local master (tests, benches),
    when it is unset, do we pick a folder of our own and record it in the session
    conf; on a cluster a machine-local folder would be lost, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="tributary-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
