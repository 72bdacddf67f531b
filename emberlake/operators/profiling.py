"""Profile of raw detections: nulls, ranges, dates, categories, duplicates.

Everything except the distinct-key count and the category lists comes from one
map-side-combined aggregate, so profiling a year costs three narrow scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.functions.geo import in_bounds
from emberlake.functions.report import bounds, reported_average, size_mb
from emberlake.functions.temporal import parses_as_date
from emberlake.schemas import NATURAL_KEY, RAW_ARCHIVE

CATEGORIES = ["satellite", "instrument", "confidence", "daynight", "type", "version"]
LISTED_VALUES = 20


def null_counts(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """Long form: one row per group and column."""
    columns = columns or [c for c in RAW_ARCHIVE.names if c in df.columns]
    wide = df.groupBy(*by).agg(*[F.count_if(F.isnull(c)).alias(c) for c in columns])
    return wide.unpivot(by, columns, "column_name", "null_count")


def _range_metrics() -> list[Column]:
    return [
        F.count_if(~in_bounds(F.col("latitude"), F.lit(0.0))).alias("invalid_latitude_count"),
        F.count_if(~in_bounds(F.lit(0.0), F.col("longitude"))).alias("invalid_longitude_count"),
        F.count_if(F.col("frp") < 0).alias("negative_frp_count"),
        *bounds("latitude", "longitude", "brightness", "bright_t31", "frp", "scan", "track"),
        reported_average(F.col("brightness")).alias("avg_brightness"),
        reported_average(F.col("frp")).alias("avg_frp"),
    ]


def _date_metrics() -> list[Column]:
    return [
        *bounds("acq_date"),
        F.count_if(~parses_as_date(F.col("acq_date"))).alias("invalid_date_count"),
    ]


def range_profile(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*_range_metrics())


def date_profile(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*_date_metrics())


def category_counts(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """All values per group and column with their rows, in long form, so that their number has no bound."""
    columns = columns or CATEGORIES
    long = df.select(*by, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        by, columns, "column_name", "value"
    )
    return long.where(F.col("value").isNotNull()).groupBy(*by, "column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def distinct_values(df: DataFrame, by: list[str], columns: list[str] | None = None, most: int = LISTED_VALUES) -> DataFrame:
    """The first ``most`` values per group and column, in value order, for a report; :func:`category_counts` has all.

    Distinct values are formed first and ranked after, so both steps combine
    map-side and no task ever sees more than its share of the distinct values.
    """
    distinct = category_counts(df, by, columns).drop("row_count")
    rank = F.row_number().over(Window.partitionBy(*by, "column_name").orderBy("value"))
    listed = distinct.withColumn("_rank", rank).where(F.col("_rank") <= most)
    return listed.groupBy(*by, "column_name").agg(F.sort_array(F.collect_list("value")).alias("values"))


def duplicate_profile(df: DataFrame, by: list[str], keys: list[str] | None = None) -> DataFrame:
    """Rows beyond the first per natural key. Only the key columns are read and shuffled."""
    keys = keys or NATURAL_KEY
    per_key = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.groupBy(*by).agg(
        F.sum("n").alias("total_rows"),
        F.greatest(F.lit(0), F.sum(F.col("n") - 1)).alias("duplicate_rows"),
    )
    return counted.withColumn("valid_rows_estimate", F.col("total_rows") - F.col("duplicate_rows"))


def file_totals(files: DataFrame, by: list[str]) -> DataFrame:
    """Number of files and their size, from file metadata rows."""
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.round(F.sum(size_mb(F.col("file_size"))), 2).alias("total_size_mb"),
    )


def profile(df: DataFrame, by: list[str]) -> DataFrame:
    """One row per group holding every figure of the profile report."""
    columns = [c for c in RAW_ARCHIVE.names if c in df.columns]
    base = df.groupBy(*by).agg(
        F.struct(*[F.count_if(F.isnull(c)).alias(c) for c in columns]).alias("null_counts"),
        *_range_metrics(),
        *_date_metrics(),
    )
    categories = distinct_values(df, by).groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "values"))).alias("distinct_values")
    )
    # One row per group on every side, so these joins stay tiny whatever the input size.
    return duplicate_profile(df, by).join(base, by).join(categories, by, "left")


def summary_table(profiled: DataFrame, by: list[str]) -> DataFrame:
    """The printable per-year line of a profile."""
    def listed(column: str) -> Column:
        return F.coalesce(F.array_join(F.col("distinct_values")[column], ", "), F.lit(""))

    carried = [c for c in ("total_files", "total_size_mb") if c in profiled.columns]
    return profiled.select(
        *by, *carried, "total_rows", "duplicate_rows",
        F.concat_ws(" to ", "min_acq_date", "max_acq_date").alias("date_range"),
        listed("satellite").alias("satellites"), listed("instrument").alias("instruments"),
    )


def grand_totals(profiled: DataFrame) -> DataFrame:
    """Totals over all profiled years; file figures where they were joined in."""
    figures = [c for c in ("total_rows", "duplicate_rows", "total_files", "total_size_mb") if c in profiled.columns]
    return profiled.agg(F.count(F.lit(1)).alias("years"), *[F.sum(c).alias(f"grand_{c}") for c in figures])
