"""Session set-up shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution carries the skew handling of plain equi joins, so it is always on.
# The 64 MB skew threshold is what a third of all rows exceeds long before it hurts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # The Python state server of transformWithState then uses a socket file, not a port.
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(app: str = "tradewake", master: str | None = None, **extra: str) -> SparkSession:
    """Create or get a session. ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sizing(shuffle_bytes: int, cores: int, most: int | None = None) -> dict[str, str]:
    """Settings for a batch job that shuffles about ``shuffle_bytes`` on ``cores``.

    Starts with a partition per 256 MB, at least two per core, and at most ``most`` if given;
    adaptive execution merges the small ones. Streams fix their number with the first checkpoint, so
    set ``spark.sql.shuffle.partitions`` for the load to come.
    """
    parts = max(2 * cores, -(-shuffle_bytes // (256 << 20)))
    parts = min(parts, most) if most else parts
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": "256MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    }


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    A session that names none uses a folder of this machine if it runs on this machine alone; on a
    cluster, whose executors don't see that, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tradewake-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
