"""Session construction and shared-storage helpers.

Everything that touches configuration lives here so that library code never
hard-codes a machine-local path: scratch tables and lineage cuts go below the
directory the cluster names in ``spark.checkpoint.dir``; only when that setting
is absent (tests, laptops) do we fall back to a caller-supplied folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library relies on.  UTC pins the meaning of
# timestamp_ntz <-> date conversions; AQE coalesces shuffle partitions, splits
# skewed sort-merge-join partitions and turns joins into broadcast joins only
# after it has *measured* the small side.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # stream state on disk, its checkpoints holding each batch's changes only
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "evhist", extra: dict | None = None) -> SparkSession:
    """A session with ``BASE_CONF``; the number of shuffle partitions stays the
    cluster's own setting unless one is given (tests, laptops)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_session_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of ``BASE_CONF`` to an existing session."""
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k):  # static settings of a foreign session stay
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Directory on shared storage for tables and lineage cuts.

    Reads ``spark.checkpoint.dir`` from the session; sets it from ``fallback``
    only when it is unset and the session is a local one (tests).  Never
    invents a node-local temp folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if fallback is None or not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir must name a folder that all executors share")
        os.makedirs(fallback, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", fallback)
        spark.sparkContext.setCheckpointDir(fallback)
        current = fallback
    else:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """A fresh, unique sub-folder of the shared directory."""
    return f"{shared_dir(spark, fallback)}/{name}-{uuid.uuid4().hex[:12]}"


def query_scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder for a query that works on stored tables.  A local session
    without the setting gets a temp folder; a cluster without it is an error."""
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    local = spark.sparkContext.master.startswith("local[")
    return scratch_path(spark, name, tempfile.mkdtemp(prefix="evhist-") if unset and local else None)
