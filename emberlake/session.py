"""Session factory and shared-storage lookup."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app_name: str = "emberlake", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session. The master and sizing come from the submit command unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Observation times are UTC, so date parsing must not depend on the host zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), f"emberlake-{context.applicationId}")


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under :func:`shared_dir`."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[list[str]]:
    """Folders that :func:`store_once` writes in the block are deleted at its end, but for those taken off the list.

    Nothing that is read after the block may need them.
    """
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield paths
    finally:
        _written.reset(token)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def store_once(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result that several jobs read, and hand back the stored copy.

    Unlike a cache it outlives lost executors, and later jobs read only the columns they need. Shuffle files of the job
    that writes it go when it ends: nothing reads them again, and they would stay until the driver's heap is collected.
    """
    spark = df.sparkSession
    path, before = new_work_dir(spark, label), spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
        if (written := _written.get()) is not None:
            written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative learners cut lineage in shared storage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
