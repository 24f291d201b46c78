"""Session helpers.

Cluster jobs get their settings from the cluster; the helpers here only fill
in what is unset, so local runs and tests behave like a small cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI mode stays on (Spark's default); amounts
# are parsed with try_cast so a 78-digit string never throws.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition sizing: AQE coalesces shuffle output towards 128 MB per task
    # and splits skewed partitions; file splits stay at 256 MB.  A cluster's
    # own settings win (these only apply to a session built here).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # Broadcast only what is size-checked: the planner's own threshold is the
    # guard for the small dimension tables (chains, subscriptions, topic map).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Stateful Python operators talk to the JVM over a unix socket, no port.
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "chainflow") -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CHAINFLOW_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there).  Only when it is unset in a local session (tests) a fresh scratch
    folder is created and registered; off-local that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="chainflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
