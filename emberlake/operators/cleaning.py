"""Raw detections to canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.functions.temporal import event_time
from emberlake.functions.text import blank_to_null, clock_time, clock_time_or_midnight, strip_all
from emberlake.schemas import CANONICAL_COLUMNS, FIRE_EVENT, LABELS, MEASUREMENTS


def is_near_real_time() -> Column:
    """Per-row product flag, for scans that mix archive and near-real-time files."""
    return F.coalesce(F.upper("version").contains("NRT"), F.lit(False))


def clean(df: DataFrame, nrt: bool | Column = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trim, cast and timestamp raw rows into the canonical columns.

    ``nrt`` may be a flag for the whole frame or a per-row condition; where it
    holds, ``type`` is NULL. ``keep`` carries extra columns through unchanged.
    """
    nrt = F.lit(nrt) if isinstance(nrt, bool) else nrt
    kind = F.col("type").try_cast("int") if "type" in df.columns else F.lit(None).cast("int")
    tidy = df.withColumns({
        **{c: F.col(c).try_cast("double") for c in MEASUREMENTS},
        **{c: blank_to_null(F.col(c)) for c in LABELS},
        "acq_time": clock_time(F.col("acq_time")),
        "type": F.when(~nrt, kind),
    })
    stamped = tidy.withColumn("event_timestamp", event_time(F.col("acq_date"), F.col("acq_time")))
    return stamped.select(*keep, *CANONICAL_COLUMNS)


def parse_events(df: DataFrame, nrt: bool | Column = False) -> DataFrame:
    """String-typed records to event rows; rows without usable coordinates are left out."""
    nrt = F.lit(nrt) if isinstance(nrt, bool) else nrt
    parsed = {c: F.col(c).try_cast("double") for c in MEASUREMENTS}
    parsed |= {c: F.nullif(strip_all(F.col(c)), F.lit("")) for c in LABELS if c != "acq_date"}
    parsed["acq_date"] = F.coalesce(strip_all(F.col("acq_date")), F.lit(""))
    parsed["acq_time"] = clock_time_or_midnight(F.col("acq_time"))
    kind = F.col("type").try_cast("double").try_cast("int") if "type" in df.columns else F.lit(None).cast("int")
    parsed["type"] = F.when(~nrt, kind)
    return (
        df.withColumns(parsed)
        .where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select(*FIRE_EVENT.names)
    )


def fill_for_learning(df: DataFrame) -> DataFrame:
    """Give every model input a value: ``unknown`` categories, zero measurements."""
    unknown = {
        c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
        for c in ("type", "confidence", "daynight", "season") if c in df.columns
    }
    zero = [c for c in ("brightness", "bright_t31", "scan", "track") if c in df.columns]
    return df.withColumns(unknown).fillna(0.0, subset=zero)
