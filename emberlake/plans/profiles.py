"""Profile run over raw year folders."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators import profiling
from emberlake.schemas import RAW_ARCHIVE
from emberlake.session import store_once
from emberlake.sinks.tables import write_json
from emberlake.sources.files import YEAR_FOLDER, file_metadata, read_years


RANGES = {"brightness": ("min", "max", "avg"), "bright_t31": ("min", "max"), "frp": ("min", "max", "avg"),
          "scan": ("min", "max"), "track": ("min", "max")}
# Report names of the category lists.
LISTS = {"satellite": "satellites", "instrument": "instruments", "confidence": "confidences", "daynight": "daynight",
         "type": "fire_types", "version": "versions"}


def documents(profiled: DataFrame, seconds: float) -> DataFrame:
    """The nested per-year report."""
    def listed(column: str):
        return F.coalesce(F.col("distinct_values")[column], F.array().cast("array<string>"))

    return profiled.select(
        "year", F.lit(round(seconds, 2)).alias("profiling_duration_sec"), "file_metadata", "total_files",
        "total_size_mb", "total_rows", "duplicate_rows", "valid_rows_estimate",
        F.array(*[F.lit(c) for c in RAW_ARCHIVE.names]).alias("columns"), "null_counts",
        F.struct("invalid_latitude_count", "invalid_longitude_count", "invalid_date_count",
                 "negative_frp_count").alias("validation"),
        F.struct("min_latitude", "max_latitude", "min_longitude", "max_longitude").alias("spatial_bounds"),
        F.struct("min_acq_date", "max_acq_date").alias("temporal_bounds"),
        F.struct(*[
            F.struct(*[F.col(f"{figure}_{c}").alias(figure) for figure in figures]).alias(c)
            for c, figures in RANGES.items()
        ]).alias("numeric_statistics"),
        F.struct(*[
            (listed(c).cast("array<int>") if c == "type" else listed(c)).alias(name) for c, name in LISTS.items()
        ]).alias("distinct_values"),
    )


def summary(stored: DataFrame) -> DataFrame:
    """The printable line per year."""
    return stored.select(
        "year", "total_files", "total_size_mb", "total_rows", "duplicate_rows",
        F.concat_ws(" to ", "temporal_bounds.min_acq_date", "temporal_bounds.max_acq_date").alias("date_range"),
        F.array_join("distinct_values.satellites", ", ").alias("satellites"),
        F.array_join("distinct_values.instruments", ", ").alias("instruments"),
    ).orderBy("year")


def overall(stored: DataFrame, sample_limit: int | None) -> DataFrame:
    return stored.agg(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("generated_at"),
        F.sort_array(F.collect_set("year")).alias("years_covered"),
        F.lit(sample_limit).cast("int").alias("sample_limit"),
        *[F.sum(c).alias(f"grand_{c}") for c in ("total_rows", "total_size_mb", "total_files")],
        F.map_from_entries(F.collect_list(F.struct("year", F.struct(*stored.columns)))).alias("yearly_summaries"),
    )


def run(spark: SparkSession, data_dir: str, years: list[int], reports: str,
        sample_limit: int | None = None, folder: str = YEAR_FOLDER) -> DataFrame:
    """Write the yearly profile, its totals and the printable summary; return the summary."""
    started = time.monotonic()
    raw = read_years(spark, data_dir, sorted(years), sample_limit, folder).withColumnRenamed("source_year", "year")
    files = file_metadata(spark, data_dir, years, folder)
    listed = files.groupBy("year").agg(
        F.sort_array(F.collect_list(F.struct("file_name", F.col("path").alias("file_path"),
                                             F.col("file_size").alias("file_size_bytes"),
                                             F.col("size_mb").alias("file_size_mb")))).alias("file_metadata")
    )
    profiled = (
        profiling.profile(raw, ["year"])
        .join(profiling.file_totals(files, ["year"]), "year")
        .join(listed, "year")
    )
    profiled = store_once(profiled, "profile")  # the clock stops behind the last aggregate
    reports_of = documents(profiled, time.monotonic() - started)
    write_json(reports_of.coalesce(1), f"{reports}/yearly")
    stored = spark.read.schema(reports_of.schema).json(f"{reports}/yearly")
    write_json(overall(stored, sample_limit), f"{reports}/overall")
    lines = summary(stored)
    write_json(lines.coalesce(1), f"{reports}/summary")
    return lines
