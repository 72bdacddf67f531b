"""Headline queries at one scale; prints one JSON line.

Every query is built and run to the end with the no-op sink. ``history`` is the
whole batch path (parse, validate, deduplicate, write curated and feature
tables, report); its rows per second compare with the published yearly run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from emberlake.plans import history
from emberlake.plans.registry import CSV_FOLDER, FIXTURE_YEARS, QUERIES, write_year_folders
from emberlake.session import get_spark, new_work_dir
from emberlake.sources.files import read_years
from emberlake.sources.tables import table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "clean_canonical", "quarantine", "dedup_detections", "features_batch", "features_stream_variant",
    "quality_report", "profile_ranges", "profile_distinct", "profile_duplicates", "profile_summary",
    "zscore_fit", "anomaly_scored", "anomaly_alerts", "risk_thresholds", "label_distribution", "classifier_metrics",
    "regressor_metrics", "train_risk_rf", "train_risk_gbt_ovr", "train_frp_rf", "train_frp_gbt", "score_risk",
    "merged_alerts", "stream_fire_ingest", "stream_env_ingest", "stream_anomaly", "stream_risk", "stream_alerts",
    "serving_rows", "daily_fire_kpis", "fire_kpis", "anomaly_summary", "active_alerts", "recent_events", "map_points",
    "csv_year_scan", "word_count",
]


def finish(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    cpus = int(CPUS)
    spark = get_spark("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="run-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    rows = table(spark, SF_DIR, "lineitem").count()
    finish(QUERIES["clean_canonical"](spark, SF_DIR))  # class loading and JIT are not part of any query

    csv = new_work_dir(spark, "bench-csv")
    write_year_folders(spark, SF_DIR, csv)
    layout = history.Layout.under(new_work_dir(spark, "bench-history"))

    def whole_history():
        raw = read_years(spark, csv, FIXTURE_YEARS, folder=CSV_FOLDER)
        finish(history.process(spark, raw, FIXTURE_YEARS, layout))

    seconds = {}
    for name in HEADLINE:
        try:
            seconds[name] = timed(lambda: finish(QUERIES[name](spark, SF_DIR)))
        except Exception as error:  # one broken query must not hide the others
            print(f"{name}: {error}", file=sys.stderr)
    seconds["history"] = timed(whole_history)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "rows": rows,
        "history_rows_per_sec": round(rows / seconds["history"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
