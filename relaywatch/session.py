"""Session construction and the shared work folder.

On a cluster the work folder is whatever ``spark.checkpoint.dir`` names (a
shared file system). Only when it is unset and Spark runs in local mode do we
create a scratch folder of our own, as tests and benchmarks do.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Batch defaults. Streaming state uses RocksDB so exact-count state can grow
# beyond executor heap.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


# Profile for a large cluster (for example 1000 executors reading ~100 TB).
# AQE starts from a high partition count and coalesces to ~256 MB partitions
# at runtime; skewed join partitions (a hot or null order id, a common token)
# are split; broadcasts stay small. Executors may be lost at any time: shuffle
# files are served by the external shuffle service and migrated on
# decommission, and failed tasks are retried, so no stage depends on one
# executor. Static settings must be given before the SparkContext starts.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def get_session(master: str | None = None, app: str = "relaywatch",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None,
                cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    pass ``cluster=True`` (``CLUSTER_CONF``) or size the same settings in the
    job configuration.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (``spark.checkpoint.dir``); in local
    mode only, a temp folder is created when none is set."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover - conf not visible
            base = None
        if not base:
            if not _is_local(spark):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            base = tempfile.mkdtemp(prefix="relaywatch-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir()
    return base


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """Return a fresh sub-folder of the shared checkpoint folder.

    Reads the session's checkpoint folder (``spark.checkpoint.dir``). If it
    is unset we create one only in local mode (a temp folder); on a cluster
    that is an error, since a machine-local folder would not survive the loss
    of an executor.
    """
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = base.rstrip("/") + f"/{name or 'work'}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
