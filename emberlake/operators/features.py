"""Time and grid features, in the batch, inference and ingest forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.functions.geo import floored_cell, rounded_cell
from emberlake.functions.temporal import event_time, season, stream_season, telemetry_time

_PARTS = {
    "year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour,
    "day_of_week": F.dayofweek, "day_of_year": F.dayofyear,
}


def _parts(*names: str) -> dict[str, Column]:
    return {n: _PARTS[n]("event_timestamp") for n in names}


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _cells(cell) -> dict[str, Column]:
    return {f"{c}_bucket": cell(F.col(c)) for c in ("latitude", "longitude")}


def _weekend() -> Column:
    return _flag(F.dayofweek("event_timestamp").isin(1, 7))


def batch_features(df: DataFrame) -> DataFrame:
    """The form models are trained on."""
    return df.withColumns({
        **_parts(*_PARTS),
        "is_weekend": _weekend(),
        "season": season(F.month("event_timestamp")),
        "is_night": _flag(F.col("daynight") == "N"),
        **_cells(rounded_cell),
    })


def inference_features(df: DataFrame) -> DataFrame:
    """The live-scoring form: other season names, floored grid, either case of ``N``."""
    return df.withColumns({
        **_parts(*_PARTS),
        "is_weekend": _weekend(),
        "season": stream_season(F.month("event_timestamp")),
        "is_night": _flag(F.col("daynight").isin("N", "n")),
        **_cells(floored_cell),
    })


def ingest_features(df: DataFrame) -> DataFrame:
    """Stream ingest: what the year/month layout and the night filter need."""
    return df.withColumns({
        **_parts("year", "month", "day", "hour"),
        "is_night": _flag(F.col("daynight") == "N"),
        **_cells(rounded_cell),
    })


def environment_features(df: DataFrame) -> DataFrame:
    stamped = df.withColumn("event_timestamp", telemetry_time(F.col("timestamp")))
    return stamped.withColumns(_parts("year", "month", "day"))


def stamp_event(df: DataFrame) -> DataFrame:
    """For messages whose ``acq_time`` already reads ``HH:MM``."""
    return df.withColumn("event_timestamp", event_time(F.col("acq_date"), F.col("acq_time")))
