"""Session settings the engine relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings (safe to set on a live session).
RUNTIME_CONF = {
    # fecha_sk is the UTC calendar day, so every date function must run in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when that costs the next aggregate a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle files go with the query that wrote them, not with the driver's next collection of
    # its garbage: a load of many queries would else hold the files of all of them.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Start values for a large cluster; pass to cluster_conf() and adjust.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # A high start count that AQE coalesces down to the advisory size.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def cluster_conf(builder: SparkSession.Builder, **overrides: str) -> SparkSession.Builder:
    """Add the engine's cluster settings to a session builder."""
    for key, value in {**RUNTIME_CONF, **CLUSTER_CONF, **overrides}.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    path = tempfile.mkdtemp(prefix="mercantil-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path
