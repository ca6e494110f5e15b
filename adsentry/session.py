"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Hours are taken in the session time zone, so
# it is pinned; ANSI mode stays on (overflow and bad casts fail loudly).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "adsentry",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the base settings applied.

    On a cluster ``master`` is left to spark-submit and ``shuffle_partitions``
    should be sized so one shuffle partition stays near 128-256 MB; AQE then
    coalesces small partitions and splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate() may return an existing session: re-apply SQL settings.
    for key, value in conf.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(
    input_bytes: float,
    executors: int,
    cores_per_executor: int,
    shuffle_fraction: float = 0.1,
    target_partition_bytes: int = 256 << 20,
) -> dict[str, str]:
    """Settings sized for a cluster run (pass as ``build_session(extra=...)``).

    Every aggregation here combines map-side, so a shuffle carries a fraction
    of the input (``shuffle_fraction``). The initial shuffle partition count
    puts about ``target_partition_bytes`` in each partition (at least two
    waves of the cluster's cores); AQE then coalesces small partitions toward
    the same advisory size and splits skewed ones. Scan splits use the same
    size so a task's input fits comfortably in executor memory. For 100 TB
    on 1000 executors x 8 cores this gives ~40k shuffle partitions.
    """
    cores = max(1, executors * cores_per_executor)
    wanted = int(input_bytes * shuffle_fraction / target_partition_bytes)
    partitions = max(2 * cores, wanted)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.default.parallelism": str(2 * cores),
    }


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; a folder is set only
    when none is configured (local runs and tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder: intermediate tables must survive lost executors"
            )
        # Local runs and tests only: one machine, so a local folder is shared.
        configured = fallback or os.path.join("/tmp", "adsentry-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
