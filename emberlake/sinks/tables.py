"""Parquet, CSV and text outputs."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_SAMPLE_ROWS = 1000


@contextmanager
def open_writers(spark: SparkSession, folders: int) -> Iterator[None]:
    """A task of a partitioned write keeps so many folders' files open at a time, instead of sorting its rows by folder
    first; for text files, whose writers hold next to nothing. A task with more folders sorts the rest."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(folders))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staging_folder(base: str, run: str) -> str:
    """Beside the years of a table, under a name that readers of the table skip."""
    return f"{base}/_run-{run}"


def switch_years(spark: SparkSession, staged: str, base: str, years: list[int]) -> None:
    """Puts the staged folders of these years in place of the table's; a year that came out empty goes.

    Renames only: what was there moves aside first and back again if its successor can't be moved, so every year is
    whole at any time but between two renames. What moved aside is removed at the end, with the staging folder.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    system = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = f"{staged}-replaced"
    system.mkdirs(path(aside))
    for year in years:
        old, new, kept = (path(f"{folder}/year={int(year)}") for folder in (base, staged, aside))
        had, has = system.exists(old), system.exists(new)
        if had and not system.rename(old, kept):
            raise OSError(f"can't move {old} aside")
        if has and not system.rename(new, old):
            if had:
                system.rename(kept, old)
            raise OSError(f"can't move {new} to {old}")
    system.delete(path(aside), True)
    system.delete(path(staged), True)


def write_years(df: DataFrame, base: str) -> None:
    """Replace the years present in ``df`` and leave all others as they are.

    Rows are regrouped by year with the rebalance hint: adaptive execution then
    merges small years into one file and splits a large year over many tasks,
    which a fixed file count could not do. Files are in time order, so that
    readers can skip pages by date.
    """
    arranged = df.hint("rebalance", "year")
    in_order = ["year", *[c for c in ("event_timestamp",) if c in df.columns]]
    write_years_as_is(arranged.sortWithinPartitions(*in_order), base)


def write_years_as_is(df: DataFrame, base: str) -> None:
    """For input whose tasks already hold one year each, such as a scan of a yearly table."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "snappy").partitionBy("year").parquet(base))


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def write_months(events: DataFrame, base: str) -> None:
    """Events by month, in time order within a file: a question about days opens its months and skips the rest of their
    files by time. A folder a day would be thousands of small ones over the years."""
    dated = events.withColumn("event_month", month_of(F.to_date("event_timestamp")))
    arranged = dated.hint("rebalance", "event_month").sortWithinPartitions("event_month", "event_timestamp")
    arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_month").parquet(base)


def write_raw_sample(raw: DataFrame, path: str, rows: int = RAW_SAMPLE_ROWS) -> None:
    """A demonstration extract, one headered CSV."""
    raw.limit(rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_result_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A headered CSV result in ordered parts, or in one file if the caller knows that it is small enough."""
    arranged = df.coalesce(1) if single_file else df
    arranged.write.mode("overwrite").option("header", True).csv(path)


def write_text(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """Report documents: a row per report, nested columns kept, NULL fields written."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_document(spark: SparkSession, document: dict, path: str) -> None:
    """A report already reduced to a few numbers, as one JSON line."""
    line = spark.createDataFrame([(json.dumps(document),)], "value STRING")
    line.coalesce(1).write.mode("overwrite").text(path)
