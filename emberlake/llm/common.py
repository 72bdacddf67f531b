"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.session import store_once

__all__ = ["rows_per_partition", "same", "store_once", "table", "text_key"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """Names a text, so that rows with one doc_id but other texts stay apart. Null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Null-safe equality on columns of the same names."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def rows_per_partition(rows: int, each: int) -> int:
    """As many partitions as hold ``each`` rows apiece, at least one."""
    return max(1, -(-rows // each))
