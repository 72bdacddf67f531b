"""Expressions shared by the quality and profile reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def reported_average(column: Column, digits: int = 2) -> Column:
    return reported(F.avg(column), digits)


def reported(average: Column, digits: int = 2) -> Column:
    """Reports print an average of exactly zero as missing."""
    return F.when(average != 0, F.round(average, digits))


def size_mb(num_bytes: Column) -> Column:
    return F.round(num_bytes / (1024 * 1024), 2)


def quality_status(invalid_rows: Column) -> Column:
    return F.when(invalid_rows == 0, "PASSED").otherwise("PASSED_WITH_WARNINGS")


def bounds(*names: str) -> list[Column]:
    """``min_x``, ``max_x`` for each name."""
    return [f(n).alias(f"{p}_{n}") for n in names for p, f in (("min", F.min), ("max", F.max))]
