"""Session settings, layer names and the shared scratch area."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

LAYERS = ("landing", "bronze", "silver", "gold")

# Dates are cut from timestamps in the session time zone, so it is pinned.
# AQE picks partition counts, splits skewed joins and rebalances writes.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Splits are cut by file size, but most bytes of a review are its text,
    # which only the bronze load reads: larger splits, fewer map tasks.
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.compression.codec": "zstd",
}

_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024
# Spark 4.1 and later. Otherwise shuffle files stay until the driver collects its garbage, which an idle one rarely does.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def with_session_conf(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply :data:`SESSION_CONF` to a session builder."""
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return builder


def shuffle_partitions_for(input_bytes: int) -> int:
    """Shuffle width that keeps one partition within executor memory.

    AQE merges partitions that turn out small but cannot add any, so the
    starting width has to follow the input size.
    """
    return max(1, math.ceil(input_bytes / _BYTES_PER_SHUFFLE_PARTITION))


def shuffle_width(spark: SparkSession) -> int:
    """Partitions a shuffle of the session starts from, as AQE picks them."""
    return int(spark.conf.get(_INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def session_sized_for(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session with the settings of ``spark`` whose shuffles start wide
    enough for ``input_bytes``.

    Each write gets one of its own: writes that run at the same time do not
    share a width, and the caller's session is left as it is. The session's
    own setting is a floor.

    An execution's shuffle files go when it ends, so writes that follow each
    other need the disk of the largest, not of all. A frame of the session
    that is run again shuffles again.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(_INITIAL_PARTITIONS, str(max(shuffle_width(spark), shuffle_partitions_for(input_bytes))))
    own.conf.set(_DROP_SHUFFLES, "true")
    return own


def database_name(prefix: str, layer: str) -> str:
    """Database of a layer; with an empty prefix just the layer's name."""
    return f"{prefix}_{layer}" if prefix else layer


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in the driver's own process."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name that every executor can reach.

    It lies under ``spark.checkpoint.dir``. A local session may name none: it
    uses the warehouse then. On a cluster that is an error, because the default
    warehouse is a folder of the driver's machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/townsquare/{label}-{uuid.uuid4().hex}"
