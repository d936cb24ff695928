"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this package wants. They are runtime SQL settings, so they can also be
# applied to a session somebody else started.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    # Hot join keys are split at run time from the real shuffle sizes, also where the split
    # costs one more shuffle further up.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.statistics.fallBackToHdfs": "true",
}


def configure(spark: SparkSession, overrides: dict | None = None) -> SparkSession:
    """Apply RECOMMENDED to a running session, leaving alone what the cluster already set."""
    for key, value in RECOMMENDED.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    for key, value in (overrides or {}).items():
        spark.conf.set(key, value)
    return spark


#: Bytes of stored input per shuffle partition, before adaptive execution merges small ones, and what it merges them to.
INPUT_PER_PARTITION = 2 << 20
#: What one task reads of files, and of a shuffle. Compressed: the rows of a task take about twenty times as much memory.
TASK_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_tasks(spark: SparkSession, path: str) -> SparkSession:
    """Let the number of shuffle partitions follow the size of what is stored at ``path``, so that a task's share
    does not grow with the input; a session keeps the largest number it was given. What the cluster set stays."""
    for key, value in TASK_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    wanted, given = -(-stored // INPUT_PER_PARTITION), spark.conf.get(_INITIAL, None)
    ours = getattr(spark, "_leadvault_partitions", None)
    if (given is None or given == ours) and wanted > int(given or spark.conf.get("spark.sql.shuffle.partitions")):
        spark._leadvault_partitions = str(wanted)
        spark.conf.set(_INITIAL, str(wanted))
    return spark


_GIVE_BACK = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_given_back(spark: SparkSession):
    """Inside, the shuffle files of a query go when it ends. Else they stay until the driver happens to collect its garbage,
    and a job of many queries keeps those of all on disk."""
    before = spark.conf.get(_GIVE_BACK, "false")
    spark.conf.set(_GIVE_BACK, "true")
    try:
        yield
    finally:
        spark.conf.set(_GIVE_BACK, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("leadvault")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local-mode session,
    where driver and executors are one process, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # The setting is fixed once a session runs, so the folder is remembered with the application.
        shared = getattr(spark.sparkContext, "_leadvault_scratch", None) or tempfile.mkdtemp(prefix="leadvault-")
        spark.sparkContext._leadvault_scratch = shared
    return os.path.join(shared, f"{label}-{uuid.uuid4().hex[:12]}")
