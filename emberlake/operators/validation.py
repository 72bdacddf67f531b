"""Row validity, the valid/quarantine split and the field contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.functions.geo import in_bounds
from emberlake.functions.temporal import parses_as_date

# Allowed categories of the field contract.
CONFIDENCE_VALUES = ["l", "n", "h"]
DAYNIGHT_VALUES = ["D", "N"]
TYPE_VALUES = [0, 1, 2, 3]
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"

POSITIVE = ["brightness", "bright_t31"]
NON_NEGATIVE = ["frp", "scan", "track"]


def coordinates_ok() -> Column:
    return F.coalesce(in_bounds(F.col("latitude"), F.col("longitude")), F.lit(False))


def time_ok() -> Column:
    return F.col("event_timestamp").isNotNull() & parses_as_date(F.col("acq_date"))


def measurements_ok() -> Column:
    """Absent measurements pass; NaN compares as large and passes too."""
    terms = [F.col(c) > 0 for c in POSITIVE] + [F.col(c) >= 0 for c in NON_NEGATIVE]
    return reduce(Column.__and__, [F.coalesce(t, F.lit(True)) for t in terms])


def is_valid() -> Column:
    return coordinates_ok() & time_ok() & measurements_ok()


def valid_rows(df: DataFrame) -> DataFrame:
    return df.where(is_valid())


def quarantined_rows(df: DataFrame) -> DataFrame:
    return df.where(~is_valid())


def validity_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows failing each group of checks, per ``by`` group."""
    checks = {"bad_coordinates": coordinates_ok(), "bad_time": time_ok(), "bad_measurements": measurements_ok()}
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("input_rows"),
        *[F.count_if(~ok).alias(name) for name, ok in checks.items()],
        F.count_if(is_valid()).alias("valid_rows"),
        F.count_if(~is_valid()).alias("invalid_rows"),
    )


def contract_rules() -> dict[str, Column]:
    """Contract constraints by name. NULL is allowed except where the field is required."""
    def optional(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(True))

    def required(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return {
        "latitude": required(F.col("latitude").between(-90.0, 90.0)),
        "longitude": required(F.col("longitude").between(-180.0, 180.0)),
        "acq_date": required(F.col("acq_date").rlike(ISO_DATE)),
        "event_timestamp": F.col("event_timestamp").isNotNull(),
        **{c: optional(F.col(c) > 0) for c in POSITIVE},
        **{c: optional(F.col(c) >= 0) for c in NON_NEGATIVE},
        "confidence": optional(F.col("confidence").isin(CONFIDENCE_VALUES)),
        "daynight": optional(F.col("daynight").isin(DAYNIGHT_VALUES)),
        "type": optional(F.col("type").isin(TYPE_VALUES)),
    }


def contract_report(df: DataFrame) -> DataFrame:
    """One row per contract rule with its violation count, from a single aggregate."""
    rules = contract_rules()
    counted = df.agg(
        F.count(F.lit(1)).alias("checked_rows"), *[F.count_if(~ok).alias(n) for n, ok in rules.items()]
    )
    return counted.unpivot(["checked_rows"], list(rules), "rule", "violations")


def in_stream_bounds(df: DataFrame) -> DataFrame:
    """The only check made at stream ingest."""
    return df.where(in_bounds(F.col("latitude"), F.col("longitude")))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail early on an empty input instead of loading or training on nothing."""
    if df.isEmpty():
        raise ValueError(f"{what} holds no rows")
    return df


def load_gate(df: DataFrame) -> DataFrame:
    """Row count after a load, with the verdict that decides whether the load stands."""
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("passed", F.col("row_count") > 0)
