import datetime

import pytest
from pyspark.sql import functions as F

from emberlake.functions.temporal import season, stream_season
from emberlake.functions.text import clock_time, clock_time_or_midnight
from emberlake.operators import cleaning, features
from helpers import ARCHIVE, NRT, canonical_frame, raw_frame, raw_row, text_frame


def apply(spark, expression, value, kind="STRING"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("given, expected", [
    ("0", "00:00"), ("30", "00:47"), ("0030", "00:30"), ("125", "01:25"), ("2359", "23:59"), (None, "00:00"),
    ("", "00:00"), (" 30 ", "00:47"), ("12:35", "12::35"),
])
def test_event_clock(spark, given, expected):
    assert apply(spark, clock_time_or_midnight, given) == expected


@pytest.mark.parametrize("given, expected", [
    ("0", "00:00"), (" 125 ", "01:25"), ("2359", "23:59"), (None, None), ("12:35", "12::3"), ("", "00:00"),
])
def test_column_clock(spark, given, expected):
    assert apply(spark, clock_time, given) == expected


def test_archive_record(spark):
    event = cleaning.parse_events(text_frame(spark, ARCHIVE)).first()
    assert (event.latitude, event.longitude, event.acq_time, event.type) == (-21.375, 47.0625, "09:51", 0)
    assert (event.version, event.confidence, event.frp) == ("2", "h", 27.5)


def test_near_real_time_record(spark):
    event = cleaning.parse_events(text_frame(spark, NRT), nrt=True).first()
    assert (event.type, event.version, event.acq_time) == (None, "2.0NRT", "00:47")


@pytest.mark.parametrize("value, expected", [("1.9", 1), ("", None), ("x", None), ("nan", None), (None, None)])
def test_record_type(spark, value, expected):
    assert cleaning.parse_events(text_frame(spark, {**ARCHIVE, "type": value})).first().type == expected


@pytest.mark.parametrize("latitude", ["invalid_lat", "", None])
def test_record_without_coordinates_is_dropped(spark, latitude):
    assert cleaning.parse_events(text_frame(spark, {**ARCHIVE, "latitude": latitude})).isEmpty()


def test_clean_handles_bad_values(spark):
    bad = {**ARCHIVE, "brightness": "hot", "confidence": "  ", "acq_time": "2460", "type": "x"}
    row = cleaning.clean(text_frame(spark, bad)).first()
    assert (row.brightness, row.confidence, row.event_timestamp, row.type) == (None, None, None, None)
    assert row.acq_time == "24:60"


def test_clean_stamps_and_orders(spark):
    df = cleaning.clean(raw_frame(spark, raw_row()))
    assert df.columns[-1] == "event_timestamp" and len(df.columns) == 16
    assert df.first().event_timestamp == datetime.datetime(2024, 9, 22, 9, 51)


def test_type_is_null_for_near_real_time_rows_or_years(spark):
    df = raw_frame(spark, raw_row(type=2), raw_row(type=2, version="2.0NRT"))
    assert [r.type for r in cleaning.clean(df, cleaning.is_near_real_time()).collect()] == [2, None]
    assert [r.type for r in cleaning.clean(df, True).collect()] == [None, None]
    assert [r.type for r in cleaning.clean(df.drop("type")).collect()] == [None, None]


def test_seasons(spark):
    months = spark.createDataFrame([(m,) for m in [None, *range(1, 13)]], "m INT")
    named = months.select(season(F.col("m")).alias("a"), stream_season(F.col("m")).alias("b")).collect()
    assert [r.a for r in named] == ["Fall"] + ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    assert [r.b for r in named][0] == "unknown" and [r.b for r in named][9] == "autumn"


def test_feature_variants_differ_where_they_should(spark):
    row = {**raw_row(latitude=34.06, daynight="n"), "event_timestamp": None}
    df = canonical_frame(spark, row)
    batch, live = features.batch_features(df).first(), features.inference_features(df).first()
    assert (batch.latitude_bucket, live.latitude_bucket) == (34.1, 34.0)
    assert (batch.is_night, live.is_night) == (0, 1)
    assert (batch.season, live.season, batch.is_weekend, live.is_weekend) == ("Fall", "unknown", 0, 0)


def test_learning_fill(spark):
    row = {**raw_row(brightness=None, confidence=None, type=None), "event_timestamp": None}
    filled = cleaning.fill_for_learning(canonical_frame(spark, row)).first()
    assert (filled.brightness, filled.confidence, filled.type) == (0.0, "unknown", "unknown")
