import datetime

import pytest

from emberlake.operators import serving
from emberlake.plans.load import load_events
from emberlake.sinks.jdbc import Store, table_options
from emberlake.sinks.tables import write_years
from helpers import canonical_frame, raw_row

STORE = Store("jdbc:postgresql://db:5432/fires", "u", "p", "fires")
NOON = datetime.datetime(2024, 9, 22, 9, 51)


def curated(spark, *changes):
    return canonical_frame(spark, *[{**raw_row(acq_time="09:51"), "event_timestamp": NOON, **c} for c in changes])


def test_nothing_is_lost_between_conforming_and_rejected(spark):
    df = serving.event_rows(curated(
        spark, {}, {"event_timestamp": None}, {"latitude": 1.0, "daynight": "DN"},
        {"latitude": 2.0, "type": 40_000}, {"latitude": 3.0, "confidence": "x" * 11},
    ))
    kept, rejected = serving.conforming_rows(df, "fire_events"), serving.rejected_rows(df, "fire_events")
    assert (kept.count(), rejected.count()) == (1, 4)
    assert dict(kept.dtypes)["type"] == "smallint" and kept.columns[0] == "event_id"
    assert kept.first().created_at is not None


def test_alert_times_arrive_as_text(spark):
    df = spark.createDataFrame(
        [("2026-06-01T12:00:00.000Z", 1.0, 2.0, "HIGH"), ("soon", 1.0, 2.0, "HIGH")],
        "event_timestamp STRING, latitude DOUBLE, longitude DOUBLE, alert_level STRING")
    for c in set(serving.TABLES["alerts"]) - set(df.columns):
        df = df.selectExpr("*", f"CAST(NULL AS STRING) AS {c}")
    kept = serving.conforming_rows(df, "alerts")
    assert [r.event_timestamp for r in kept.collect()] == [datetime.datetime(2026, 6, 1, 12)]


def test_default_model_version(spark):
    df = spark.createDataFrame([(NOON, 1.0, 2.0, 3.0)],
                               "event_timestamp TIMESTAMP, latitude DOUBLE, longitude DOUBLE, predicted_frp DOUBLE")
    assert serving.conforming_rows(df, "fire_size_predictions").first().model_version == "fire_size_regressor_v1"


def test_ids_are_stable(spark):
    ids = [{r.event_id for r in serving.conforming_rows(serving.event_rows(
        curated(spark, {}, {"latitude": 2.0}).repartition(n)), "fire_events").collect()} for n in (1, 3)]
    assert ids[0] == ids[1] and len(ids[0]) == 2


def test_load_replaces_with_one_row_per_time_and_place(spark, tmp_path):
    base, saved = str(tmp_path / "curated"), []
    rows = curated(spark, {}, {"acq_time": "other"}, {"latitude": 2.0}).selectExpr("*", "2024 AS year")
    write_years(rows, base)
    load_events(spark, base, [2024, 2025], STORE, save=lambda df, *rest: saved.append((df.collect(), *rest)))
    (loaded, store, table, mode), = saved
    assert (len(loaded), store, table, mode) == (2, STORE, "fire_events", "overwrite")
    assert list(loaded[0].asDict()) == serving.SERVING_EVENT_COLUMNS
    with pytest.raises(ValueError, match="no rows"):
        load_events(spark, base, [1999], STORE, save=lambda *a: None)


def test_store_options():
    options = table_options(STORE, "alerts", "append")
    assert options["dbtable"] == "fires.alerts" and "truncate" not in options
    assert table_options(STORE, "alerts", "overwrite")["truncate"] == "true"
    with pytest.raises(ValueError):
        table_options(STORE, "alerts", "ignore")


def test_views(spark):
    events = serving.event_rows(curated(spark, {}, {"latitude": 2.0, "daynight": "N", "frp": None}))
    serving.register_views(spark, {"fire_events": events})
    row = spark.sql("SELECT * FROM v_daily_fire_kpis").first()
    assert (row.fire_count, row.night_fires, float(row.avg_frp)) == (2, 1, 27.5)


def test_kpis_of_nothing(spark):
    row = serving.fire_kpis(serving.event_rows(curated(spark, {}).where("false"))).first()
    assert tuple(row) == (0, 0.0, 0.0, 0)


def test_map_needs_coordinates(spark):
    assert serving.map_points(curated(spark, {}, {"latitude": None})).count() == 1


def test_day_filter(spark):
    earlier = NOON - datetime.timedelta(days=3)
    events = serving.event_rows(curated(spark, {}, {"event_timestamp": earlier}))
    assert serving.on_date(events).first().event_timestamp == NOON
    assert serving.on_date(events, earlier.date()).first().event_timestamp == earlier


def test_newest_alerts_come_first(spark):
    rows = spark.range(600).selectExpr(
        "id AS alert_id", "TIMESTAMP '2024-01-01' AS event_timestamp", "1D AS latitude", "2D AS longitude",
        "3D AS frp", "4D AS anomaly_score", "'High' AS risk_level", "'HIGH' AS alert_level", "'x' AS alert_source",
        "'r' AS alert_reason", "'m' AS alert_message", "timestamp_seconds(id) AS created_at")
    board = serving.active_alerts(rows).collect()
    assert len(board) == 500 and board[0].alert_id == 599
