"""Session helpers: a local session for tests/bench and a shared work folder.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it. A folder of our own is set only when that setting is
absent (tests, local bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clickflow") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UTC, no UI)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CLICKFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Uses the folder already set on the SparkContext, else ``spark.checkpoint.dir`` from
    the configuration. Only when both are unset (local tests) a folder of our own is
    created and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a shared folder "
                               "(e.g. on HDFS or an object store) for checkpoints and written tables")
        configured = tempfile.mkdtemp(prefix="clickflow-ckpt-")   # local mode only (tests)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written tables."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
               broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Settings sized for an input of ``input_bytes`` on a cluster.

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` per task (the
    shuffle count is an upper bound: AQE coalesces small ones and splits skewed ones).
    Broadcasts stay behind Spark's size estimate with a fixed cap; nothing is broadcast
    by size-unknown force."""
    shuffle = max(200, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
