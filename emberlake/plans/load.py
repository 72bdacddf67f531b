"""Load curated detections into the serving store."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emberlake.operators import serving
from emberlake.operators.validation import require_rows
from emberlake.session import store_once
from emberlake.sinks.jdbc import Store, write_table
from emberlake.sources.files import missing_years, read_partitioned

log = logging.getLogger(__name__)


def load_events(spark: SparkSession, curated: str, years: list[int], store: Store, mode: str = "overwrite",
                save: Callable[[DataFrame, Store, str, str], None] = write_table, rejected: str | None = None) -> DataFrame:
    """Read the wanted years once, keep one row per time and place, and write them.

    Years without data are named in the log and skipped; no data at all is an
    error. Ids and load times are left to the store's own defaults. Rows that the
    table's rules refuse go to the folder ``rejected``, if one is named; both
    counts are logged.
    """
    rows = require_rows(read_partitioned(spark, curated, years), f"{curated} for {years}")
    for year in missing_years(rows, years):
        log.warning("no rows for %s in %s", year, curated)
    events = store_once(serving.event_rows(rows), "load-events")  # written, refused and counted from one evaluation
    accepted, refused = serving.store_rows(events, "fire_events"), serving.rejected_rows(events, "fire_events")
    save(accepted, store, "fire_events", mode)
    if rejected:
        refused.write.mode("overwrite").parquet(rejected)
    log.info("%d rows accepted, %d refused", accepted.count(), refused.count())
    return accepted
