"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings: results (time zone, ANSI errors), skew handling (AQE), and few
# files open at once, so that a task that writes few partitions need not sort its rows.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

MIB = 1024**2
SHUFFLE_PARTITION_BYTES = 192 * MIB
MAX_SHUFFLE_PARTITIONS = 50_000
MIN_SPLIT_BYTES, MAX_SPLIT_BYTES, MAX_SPLITS = 128 * MIB, 1024 * MIB, 100_000


def configure(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to the caller's session, where they stay: the frames returned are evaluated later."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Split and shuffle settings for a job that reads and shuffles about `input_bytes`.

    AQE merges small partitions after the fact but cannot make more of them, so
    the initial number follows the data. Both sides of a shuffle are bounded, as it
    holds one block for each pair of tasks; beyond that tasks grow and spill.
    """
    split = min(max(input_bytes // MAX_SPLITS, MIN_SPLIT_BYTES), MAX_SPLIT_BYTES)
    wanted = min(max(cores, math.ceil(input_bytes / SHUFFLE_PARTITION_BYTES)), MAX_SHUFFLE_PARTITIONS)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(wanted),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(wanted),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
    }


@contextmanager
def sized(spark: SparkSession, input_bytes: int):
    """`sizing` for the jobs run inside, then the caller's settings again."""
    settings = sizing(input_bytes, spark.sparkContext.defaultParallelism)
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield settings
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's shared checkpoint folder.

    A machine-local folder is used in local mode only; executors on other
    machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tripmart-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
