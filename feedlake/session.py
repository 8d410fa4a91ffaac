"""Session construction and the shared checkpoint folder.

On a cluster the operator sets ``spark.checkpoint.dir`` to a shared folder; we only read it.
A private folder is created only when the session has none (local runs and tests).
"""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

# Session defaults. AQE coalesces small shuffles and splits skewed join partitions at run time;
# ANSI stays on, so every fallible cast below is a try_* form.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "feedlake", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (spark.checkpoint.dir). On a cluster it must be
    named: executors and the driver share no local folder. Only a local[*] session gets a private one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="feedlake-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never a machine-local temp dir)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: what follows runs on the stored rows, whatever becomes of the
    executors that made them."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores, where they lie in fewer files than there are cores (a file may be one row group,
    that is one task). With more files the rows stay where they are: nothing large is shuffled. A micro-batch names no
    files, its partitions are counted."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if (len(df.inputFiles()) or df.rdd.getNumPartitions()) < cores else df


#: Most rows of an Arrow batch: rows hold whole texts.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """Lower the session's Arrow batches to BATCH_ROWS rows, where they are larger, so that a worker holds a
    few MB of texts at once. It changes no result."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def _give_back() -> None:
    """Give the system what this process has freed: glibc and Arrow keep some 100 MB of it otherwise."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of batches that leaves its worker small: workers stay for stages to come, beside those that these start."""

    def tidied(batches):
        _give_back()
        yield from run(batches)
        _give_back()

    return tidied


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster file system (works for file:, hdfs:, s3a: ...)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether the path is a folder, through the cluster file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory())


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for clusters where it is not installed there."""
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "feedlake"), "zip", root, "feedlake"))
