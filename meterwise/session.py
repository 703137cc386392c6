"""Session settings and fault-tolerant lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "meterwise", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC with adaptive execution; a local master only when none is set."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master or "MASTER" not in os.environ:
        builder = builder.master(master or "local[*]")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="meterwise-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """New folder in the shared checkpoint location; it is deleted when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint, so lost executors do not lose the data."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def run_jobs(spark: SparkSession, tasks: Sequence[Callable[[], object]], at_once: int = 4) -> list:
    """Run independent Spark jobs from a few driver threads; results in task order."""
    if not tasks:
        return []
    with ThreadPool(min(at_once, len(tasks))) as pool:
        return pool.map(lambda task: task(), list(map(inheritable_thread_target(spark), tasks)))


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
