"""Appends that a replayed micro-batch cannot repeat.

A folder table keeps each batch in a folder named after it. Rows are staged under a hidden name and appear by one rename,
so the folder's name is the ledger: a batch that is there has been committed whole, one that isn't left nothing visible.
The rename is atomic on HDFS and local disks; an object store needs a file system layer that makes it so.

A relational table has no such switch. There the key decides: rows whose key the table holds are left out, so a batch
that failed midway adds only what is missing, and a ledger table spares whole batches the comparison.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators.dedup import keep_one
from emberlake.sinks.jdbc import Store, read_table, write_table

log = logging.getLogger(__name__)

BATCH = "batch_id"
LEDGER_TABLE = "stream_batches"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target, jvm.org.apache.hadoop.fs.Path


def batch_folder(base: str, batch_id: int) -> str:
    return f"{base}/{BATCH}={batch_id}"


def is_committed(spark: SparkSession, base: str, batch_id: int) -> bool:
    system, folder, _ = _file_system(spark, batch_folder(base, batch_id))
    return system.exists(folder)


def read_committed(spark: SparkSession, base: str, schema) -> DataFrame:
    """All committed rows; staged ones are hidden from readers."""
    system, folder, _ = _file_system(spark, base)
    if not system.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(base).select(*schema.names)


def new_rows(rows: DataFrame, held: DataFrame, keys: list[str], time: str) -> DataFrame:
    """One row a key, of the keys that ``held`` lacks. Only the span of time of ``rows`` is looked up in ``held``."""
    single = keep_one(rows, keys)
    span = rows.agg(F.min(time).alias("low"), F.max(time).alias("high")).first()
    if span.low is None:
        return single.dropna(subset=keys)
    there = held.where(F.col(time).between(span.low, span.high)).select(*keys)
    return single.dropna(subset=keys).join(there, keys, "left_anti").select(*rows.columns)


def stage(rows: DataFrame, base: str, batch_id: int) -> str:
    path = f"{base}/_staged-{batch_id}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return path


def commit_folder(spark: SparkSession, staged: str, folder: str) -> bool:
    """Makes a staged folder visible under its name; False if another attempt was faster, whose rows stay."""
    system, target, path = _file_system(spark, folder)
    if system.exists(target) or not system.rename(path(staged), target):
        system.delete(path(staged), True)
        return False
    return True


def commit(spark: SparkSession, staged: str, base: str, batch_id: int) -> bool:
    return commit_folder(spark, staged, batch_folder(base, batch_id))


def committed_folders(spark: SparkSession, base: str) -> list[str]:
    """Names of the folders in ``base`` that readers see."""
    system, folder, _ = _file_system(spark, base)
    if not system.exists(folder):
        return []
    return [f.getPath().getName() for f in system.listStatus(folder) if f.isDirectory() and f.getPath().getName()[0] not in "_."]


def remove_folder(spark: SparkSession, path: str) -> None:
    system, folder, _ = _file_system(spark, path)
    system.delete(folder, True)


def append_once(base: str, keys: list[str], shape: Callable[[DataFrame], DataFrame] = lambda df: df,
                time: str = "event_timestamp") -> Callable[[DataFrame, int], None]:
    """A batch writer for a folder table: one row a key over all batches, whatever is replayed and wherever it failed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, base, batch_id):
            log.info("batch %s is committed already", batch_id)
            return
        shaped = shape(batch)
        commit(spark, stage(new_rows(shaped, read_committed(spark, base, shaped.schema), keys, time), base, batch_id), base, batch_id)

    return write


def append_once_to_table(store: Store, table: str, keys: list[str], shape: Callable[[DataFrame], DataFrame] = lambda df: df,
                         time: str = "event_timestamp", load=read_table, save=write_table) -> Callable[[DataFrame, int], None]:
    """The same for a table over JDBC, with the batches done in ``LEDGER_TABLE`` (table_name, batch_id)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = load(spark, store, LEDGER_TABLE).where((F.col("table_name") == table) & (F.col(BATCH) == batch_id))
        if not done.isEmpty():
            log.info("batch %s is in %s already", batch_id, table)
            return
        save(new_rows(shape(batch), load(spark, store, table), keys, time), store, table, "append")
        save(spark.createDataFrame([(table, batch_id)], f"table_name string, {BATCH} long"), store, LEDGER_TABLE, "append")

    return write
