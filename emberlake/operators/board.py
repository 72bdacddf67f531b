"""The board's questions on a store of events by month (``sinks.tables.write_months``): few months are opened.

Rows per month come from a count that reads no column. What it returns is as long as the store has months, so it goes to
the driver and comes back as literals on the partition column, which prune at planning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.operators import serving

MONTH = "event_month"


def rows_by_month(store: DataFrame) -> list[tuple[str | None, int]]:
    """Newest month first; rows without time come last."""
    counted = [(r[0], r[1]) for r in store.groupBy(MONTH).agg(F.count(F.lit(1))).collect()]
    return sorted(counted, key=lambda m: (m[0] is not None, m[0] or ""), reverse=True)


def in_months(store: DataFrame, months: list[str | None]) -> DataFrame:
    named = [m for m in months if m is not None]
    terms: list[Column] = [F.col(MONTH).isin(named)] * bool(named) + [F.col(MONTH).isNull()] * (len(named) < len(months))
    return store.where(reduce(Column.__or__, terms, F.lit(False)))


def recent_events(store: DataFrame, limit: int = serving.RECENT_EVENTS) -> DataFrame:
    """The newest months that hold ``limit`` rows together hold the newest ``limit`` rows, ties included."""
    months, rows = [], 0
    for month, n in rows_by_month(store):
        if rows >= limit:
            break
        months, rows = [*months, month], rows + n
    return serving.recent_events(in_months(store, months), limit)


def event_date_bounds(store: DataFrame) -> DataFrame:
    """First and last day, from the first and the last month."""
    months = [m for m, _ in rows_by_month(store) if m is not None]
    return serving.event_date_bounds(in_months(store, sorted({*months[:1], *months[-1:]})))


def on_date(store: DataFrame, date=None) -> DataFrame:
    """Events of one day, the newest if none is named; within its month, time bounds let readers skip row groups."""
    if date is None:
        date = event_date_bounds(store).first().max_date
    day = F.lit(date).cast("date")
    within = (F.col("event_timestamp") >= day.cast("timestamp")) & (F.col("event_timestamp") < F.date_add(day, 1).cast("timestamp"))
    return store.where((F.col(MONTH) == F.date_format(day, "yyyy-MM")) & within)
