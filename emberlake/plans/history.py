"""Historical batch: yearly raw files to curated and feature tables with a quality report.

    raw CSV --(one parse)--> checked table --(dedup exchange)--> curated --(no exchange)--> features

Each arrow ends in a stored table. Counts come from those tables rather than
from task accumulators, so a lost executor or a re-run stage cannot inflate
them, and no step repeats the CSV parse or the dedup.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberlake.operators import quality
from emberlake.operators.cleaning import clean, is_near_real_time
from emberlake.operators.dedup import keep_one
from emberlake.operators.features import batch_features
from emberlake.operators.validation import is_valid
from emberlake.schemas import CANONICAL_COLUMNS, NATURAL_KEY
from emberlake.session import store_once
from emberlake.sinks.tables import RAW_SAMPLE_ROWS, staging_folder, switch_years, write_json, write_raw_sample, write_years, write_years_as_is
from emberlake.sources.files import YEAR_FOLDER, file_metadata, read_year, read_years


@dataclass(frozen=True)
class Layout:
    """Output folders. Yearly tables have a base folder each, with nothing else beside them."""

    checked: str
    curated: str
    features: str
    reports: str
    raw_sample: str | None = None

    @classmethod
    def under(cls, base: str, raw_sample: bool = False) -> Layout:
        base = base.rstrip("/")
        return cls(f"{base}/checked", f"{base}/curated", f"{base}/features", f"{base}/reports",
                   f"{base}/raw_sample" if raw_sample else None)


def write_checked(raw: DataFrame, path: str, nrt=None) -> StructType:
    """Cleaned rows of every year with their validity flag, in the order they were read; returns the table's schema."""
    cleaned = clean(raw, is_near_real_time() if nrt is None else nrt, keep=("source_year",))
    flagged = cleaned.withColumn("is_valid", is_valid()).withColumnRenamed("source_year", "year")
    write_years_as_is(flagged, path)
    return flagged.schema


def curate(checked: DataFrame) -> DataFrame:
    """One row per detection and year, from the valid part of the checked table.

    The year comes last: a task holds few years, so a sort that began with it would compare whole rows.
    """
    return keep_one(checked.where("is_valid").drop("is_valid"), [*NATURAL_KEY, "year"])


def quarantine(checked: DataFrame) -> DataFrame:
    return checked.where("NOT is_valid").drop("is_valid")


def report(checked: DataFrame, curated: DataFrame) -> DataFrame:
    """Per-year quality figures from what was stored."""
    stages = checked.groupBy("year").agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if("is_valid").alias("valid_rows"),
        F.count_if(~F.col("is_valid")).alias("invalid_rows"),
    )
    return quality.combine(stages, quality.output_metrics(curated, ["year"]), ["year"])


def report_documents(figures: DataFrame, files: DataFrame, layout: Layout, seconds: float) -> DataFrame:
    """The nested per-year report: input files, counts, bounds, statistics, verdict."""
    inputs = files.groupBy("year").agg(
        F.sort_array(F.collect_list(F.struct("file_name", "size_mb"))).alias("input_files")
    )

    def group(**members: str):
        return F.struct(*[F.col(source).alias(name) for name, source in members.items()])

    def path(base: str):
        return F.concat(F.lit(f"{base}/year="), F.col("year").cast("string"))

    return figures.join(inputs, "year", "left").select(
        "year",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("processing_timestamp"),
        F.lit(round(seconds, 2)).alias("duration_seconds"),
        "input_files", "input_rows", "invalid_rows", "duplicate_rows",
        F.col("output_rows").alias("output_curated_rows"),
        F.col("output_rows").alias("output_features_rows"),
        path(layout.curated).alias("curated_path"),
        path(layout.features).alias("features_path"),
        group(min_latitude="min_latitude", max_latitude="max_latitude",
              min_longitude="min_longitude", max_longitude="max_longitude").alias("spatial_bounds"),
        group(min_acq_date="min_acq_date", max_acq_date="max_acq_date").alias("temporal_bounds"),
        group(brightness_min="min_brightness", brightness_max="max_brightness", brightness_avg="avg_brightness",
              frp_min="min_frp", frp_max="max_frp", frp_avg="avg_frp").alias("value_statistics"),
        "quality_status",
    )


def overall_document(documents: DataFrame, sample_limit: int | None) -> DataFrame:
    totals = {"input_rows": "input_rows", "invalid_rows": "invalid_rows", "duplicate_rows": "duplicate_rows",
              "output_curated_rows": "output_rows"}
    return documents.agg(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("execution_time"),
        F.sort_array(F.collect_set("year")).alias("years_processed"),
        F.lit(sample_limit).cast("int").alias("sample_limit"),
        *[F.sum(c).alias(f"total_{name}") for c, name in totals.items()],
        F.map_from_entries(F.collect_list(F.struct("year", F.struct(*documents.columns)))).alias("yearly_results"),
    )


def process(spark: SparkSession, raw: DataFrame, years: list[int], layout: Layout, nrt=None) -> DataFrame:
    """Raw rows tagged with ``source_year`` to stored tables; returns the per-year figures.

    All three tables are staged first and their years switched when the last one is written, so a run that fails leaves
    what an earlier one stored.
    """
    stamp = uuid.uuid4().hex
    bases = (layout.checked, layout.curated, layout.features)
    staged_checked, staged_curated, staged_features = staged = [staging_folder(base, stamp) for base in bases]
    schema = write_checked(raw.where(F.col("source_year").isin(years)), staged_checked, nrt)
    checked = spark.read.schema(schema).parquet(staged_checked)
    cured = curate(checked).select(*CANONICAL_COLUMNS, "year")
    write_years(cured, staged_curated)
    curated = spark.read.schema(cured.schema).parquet(staged_curated)
    # The folder year stays the partition even where a stray row's own date says otherwise.
    features = batch_features(curated.withColumnRenamed("year", "folder_year"))
    write_years_as_is(features.withColumn("year", F.col("folder_year")).drop("folder_year"), staged_features)
    for folder, base in zip(staged, bases):
        switch_years(spark, folder, base, years)
    stored = [spark.read.schema(df.schema).parquet(base).where(F.col("year").isin(years)) for df, base in ((checked, layout.checked), (cured, layout.curated))]
    return report(*stored)


def run(spark: SparkSession, data_dir: str, years: list[int], layout: Layout,
        sample_limit: int | None = None, nrt=None, folder: str = YEAR_FOLDER, raw_sample_rows: int = RAW_SAMPLE_ROWS) -> DataFrame:
    """The whole history job. Returns the stored per-year report."""
    started = time.monotonic()
    years = sorted(years)
    if layout.raw_sample:
        for year in years:
            write_raw_sample(read_year(spark, data_dir, year, folder=folder), f"{layout.raw_sample}/year={year}", raw_sample_rows)
    figures = store_once(process(spark, read_years(spark, data_dir, years, sample_limit, folder), years, layout, nrt), "history-figures")
    files = file_metadata(spark, data_dir, years, folder)
    documents = report_documents(figures, files, layout, time.monotonic() - started)
    write_json(documents.coalesce(1), f"{layout.reports}/yearly")
    stored = spark.read.schema(documents.schema).json(f"{layout.reports}/yearly")
    write_json(overall_document(stored, sample_limit), f"{layout.reports}/overall")
    return stored
