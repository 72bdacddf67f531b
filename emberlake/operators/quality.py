"""Stage counts and value statistics of a cleaned batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.functions.report import bounds, quality_status, reported
from emberlake.operators.dedup import keep_one
from emberlake.operators.validation import is_valid, valid_rows
from emberlake.schemas import NATURAL_KEY

# What reports show of kept rows.
BOUNDED = ["latitude", "longitude", "acq_date", "brightness", "frp"]
MEASURED = [c for c in BOUNDED if c != "acq_date"]
AVERAGED = ["brightness", "frp"]


def output_metrics(curated: DataFrame, by: list[str]) -> DataFrame:
    """Rows, bounds and averages per group, taken per day first: a day is text, and Spark sorts all rows by group to find
    the least and the greatest text of each. Days are few, so only their figures are sorted."""
    parts = (("sum", F.sum), ("count", F.count))
    days = curated.groupBy(*by, "acq_date").agg(
        F.count(F.lit(1)).alias("output_rows"), *bounds(*MEASURED),
        *[f(c).alias(f"{part}_{c}") for c in AVERAGED for part, f in parts])
    ends = {name: f(name) for c in MEASURED for name, f in ((f"min_{c}", F.min), (f"max_{c}", F.max))}
    ends |= {"min_acq_date": F.min("acq_date"), "max_acq_date": F.max("acq_date")}
    return days.groupBy(*by).agg(
        F.sum("output_rows").alias("output_rows"), *[ends[f"{end}_{c}"].alias(f"{end}_{c}") for c in BOUNDED for end in ("min", "max")],
        *[reported(F.try_divide(F.sum(f"sum_{c}"), F.sum(f"count_{c}"))).alias(f"avg_{c}") for c in AVERAGED])


def combine(stages: DataFrame, outputs: DataFrame, by: list[str]) -> DataFrame:
    """Join per-group input counts with what was kept; both sides hold one row per group."""
    joined = stages.join(outputs, by, "left").fillna(0, subset=["output_rows"])
    return joined.withColumns({
        "duplicate_rows": F.col("valid_rows") - F.col("output_rows"),
        "quality_status": quality_status(F.col("invalid_rows")),
    }).drop("valid_rows")


def stage_counts(cleaned: DataFrame, by: list[str]) -> DataFrame:
    return cleaned.groupBy(*by).agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(is_valid()).alias("valid_rows"),
        F.count_if(~is_valid()).alias("invalid_rows"),
    )


def quality_report(cleaned: DataFrame, by: list[str]) -> DataFrame:
    """Input, invalid, duplicate and kept rows with bounds and averages, per group."""
    kept = keep_one(valid_rows(cleaned), [*NATURAL_KEY, *by])
    return combine(stage_counts(cleaned, by), output_metrics(kept, by), by)


def overall_quality(report: DataFrame) -> DataFrame:
    """The per-group report rolled up to one row."""
    totals = [F.sum(c).alias(f"total_{c}") for c in ("input_rows", "invalid_rows", "duplicate_rows", "output_rows")]
    return report.agg(F.count(F.lit(1)).alias("years_processed"), *totals)
