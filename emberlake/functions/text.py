"""String expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters str.strip() removes from ASCII text.
WHITESPACE = " \t\n\r\x0b\x0c"


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def strip_all(column: Column) -> Column:
    return F.trim(column, F.lit(WHITESPACE))


def clock_time(column: Column) -> Column:
    """``HMM``-style acquisition time to ``HH:MM``.

    ``lpad`` also cuts input longer than four characters, so this must be
    applied once, to raw values only: ``12:35`` becomes ``12::3``.
    """
    digits = F.lpad(F.trim(column), 4, "0")
    return F.concat(F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2))


def clock_time_or_midnight(column: Column) -> Column:
    """Variant for event records: missing is midnight, long input is kept whole."""
    value = strip_all(column)
    padded = F.when(F.length(value) < 4, F.lpad(value, 4, "0")).otherwise(value)
    clock = F.concat(F.substring(padded, 1, 2), F.lit(":"), F.substr(padded, F.lit(3)))
    return F.when(column.isNull() | (column == ""), F.lit("00:00")).otherwise(clock)


def words(column: Column) -> Column:
    """One row per whitespace-separated token, empty edge tokens included."""
    return F.explode(F.split(column, r"\s+"))
