"""Date and time expressions. All assume a UTC session zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_PATTERN = "yyyy-MM-dd HH:mm"
DATE_PATTERN = "yyyy-MM-dd"
TELEMETRY_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Season names from December on.
SEASONS = ["Winter", "Spring", "Summer", "Fall"]
STREAM_SEASONS = ["winter", "spring", "summer", "autumn"]


def event_time(acq_date: Column, clock: Column) -> Column:
    return F.try_to_timestamp(F.concat(acq_date, F.lit(" "), clock), F.lit(EVENT_PATTERN))


def telemetry_time(column: Column) -> Column:
    return F.try_to_timestamp(column, F.lit(TELEMETRY_PATTERN))


def parses_as_date(column: Column) -> Column:
    return F.try_to_date(column, DATE_PATTERN).isNotNull()


def _by_quarter(month: Column, names: list[str]) -> Column:
    """December opens the first quarter, so ``month % 12`` counts from winter."""
    return F.get(F.array(*[F.lit(n) for n in names]), (month % 12 / 3).cast("int"))


def season(month: Column) -> Column:
    """Batch naming. An unknown month falls through to the last season."""
    return F.coalesce(_by_quarter(month, SEASONS), F.lit(SEASONS[-1]))


def stream_season(month: Column) -> Column:
    """Inference naming, with an explicit value for an unknown month."""
    return F.coalesce(_by_quarter(month, STREAM_SEASONS), F.lit("unknown"))
