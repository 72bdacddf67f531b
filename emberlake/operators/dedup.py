"""Duplicate removal with a survivor that does not depend on task timing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlake.schemas import NATURAL_KEY, SERVING_KEY


def keep_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, keep the row that sorts first on all other columns (NULLs first).

    The ``= 1`` filter lets Spark cut every map task down to one row per key
    before the exchange, so a key holding a third of the input still sends at
    most one row per task.
    """
    order = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def drop_duplicate_detections(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return keep_one(df, keys or NATURAL_KEY)


def drop_duplicate_events(df: DataFrame) -> DataFrame:
    """The serving store's unique key."""
    return keep_one(df, SERVING_KEY)
