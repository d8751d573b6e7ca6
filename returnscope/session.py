"""Spark session settings the library relies on.

On a cluster the session is created by the platform; ``configure`` only sets
what the operators need for correct and scalable plans and leaves everything
the cluster already set (notably ``spark.checkpoint.dir``) alone.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the operators need: UTC wall clock for timestamp_ntz <-> date
# arithmetic, ANSI arithmetic (errors instead of silent overflow), and AQE for
# runtime join selection, skew splitting and partition coalescing.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for ``input_bytes`` of parquet input.

    Shuffle partitions start at input / ``partition_bytes`` (AQE coalesces the
    small ones and splits skewed ones at run time), so a reduce task handles
    about one scan split and fits executor memory; joins broadcast only sides
    that AQE measured below 64 MB.
    """
    n = max(8, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def configure_for_scale(spark: SparkSession, input_bytes: int) -> SparkSession:
    """``configure`` plus ``scale_conf`` (all runtime-settable SQL settings)."""
    configure(spark)
    for key, value in scale_conf(input_bytes).items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "returnscope", driver_memory: str = "8g"
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session without it gets a
    fresh scratch folder; on any other master a folder of the driver's machine
    would lose the executors' files, so the missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:  # setting it again would nest a new folder inside it at every call
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir() or named
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="returnscope-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
