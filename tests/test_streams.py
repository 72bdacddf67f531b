import json

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from emberlake.operators import alerts, anomaly, features, serving
from emberlake.plans import live
from emberlake.plans.registry import fire_messages, publish, rule_risk
from emberlake.schemas import ACTION_EVENT, ENVIRONMENT, FIRE_EVENT, RISK_COLUMNS
from emberlake.sinks import streams as sinks
from emberlake.sinks.jdbc import Store
from emberlake.sources import streams as source_streams
from emberlake.sources.streams import Topic, read_messages, read_messages_once
from emberlake.sources.tables import table
from emberlake.streaming import flows, run

MODEL = anomaly.ZScoreModel({"frp": (10.0, 3.0), "brightness": (240.0, 20.0)})
FIRE = {
    "latitude": -33.3125, "longitude": 150.6875, "brightness": 352.75, "scan": 0.4, "track": 0.5,
    "acq_date": "2026-06-01", "acq_time": "12:00", "satellite": "SNPP", "instrument": "VIIRS", "confidence": "h",
    "version": "2.0NRT", "bright_t31": 297.5, "frp": 14.25, "daynight": "D", "type": None,
}
TELEMETRY = {
    "timestamp": "2026-06-01T12:00:00Z", "latitude": 38.125, "longitude": 23.5625, "temperature": 36.25,
    "humidity": 19.5, "wind_speed": 31.0, "wind_direction": 45.0, "rainfall": 0.0, "smoke": 12.75,
    "air_quality_index": 84, "source": "mast 7",
}


def folder(path, *messages):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part-0.txt").write_text("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages) + "\n")
    return Topic(str(path), format="text")


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_fire_stream_equals_batch(spark, sf_dir, tmp_path):
    messages = fire_messages(table(spark, sf_dir, "lineitem"))
    messages.repartition(4).write.text(str(tmp_path / "in"))
    topic = Topic(str(tmp_path / "in"), format="text", per_trigger=1)
    stream = read_messages(spark, topic)
    run.drain(flows.fire_ingest(stream, str(tmp_path / "out"), str(tmp_path / "c")))
    expected = flows.fire_rows(messages)
    got = spark.read.schema(expected.schema).parquet(str(tmp_path / "out"))
    assert rows(got) == rows(expected)
    assert sorted(p.name for p in (tmp_path / "out").glob("year=*"))[0].startswith("year=1995")


def test_bad_messages_do_not_reach_storage(spark, tmp_path):
    topic = folder(tmp_path / "in", FIRE, "{broken", {**FIRE, "latitude": 91.0}, {**FIRE, "acq_time": "99:99"})
    got = flows.fire_rows(read_messages_once(spark, topic)).collect()
    assert sorted((r.latitude, r.year) for r in got if r.year) == [(-33.3125, 2026)]
    assert sum(r.event_timestamp is None for r in got) == 1 and len(got) == 2
    kept = next(r for r in got if r.year)
    assert (kept.month, kept.day, kept.hour, kept.is_night, kept.latitude_bucket) == (6, 1, 12, 0, -33.3)


@pytest.mark.parametrize("value", [None, "", "{broken", "[1]"])
def test_unreadable_messages_become_empty_rows(spark, value):
    got = alerts.from_messages(spark.createDataFrame([(value,)], "value STRING"), FIRE_EVENT).collect()
    assert [set(r) for r in got] == [{None}]


def test_each_message_is_parsed_once(spark, tmp_path):
    plan = plan_of(flows.fire_rows(read_messages_once(spark, folder(tmp_path / "in", FIRE))))
    assert plan.count("from_json") == 1


def test_environment_stream(spark, tmp_path):
    topic = folder(tmp_path / "in", TELEMETRY, {**TELEMETRY, "timestamp": "yesterday"})
    run.drain(flows.environment_ingest(read_messages(spark, topic), str(tmp_path / "out"), str(tmp_path / "c")))
    got = spark.read.parquet(str(tmp_path / "out")).where("day = 1").first()
    assert (got.air_quality_index, got.year, got.month, got.source) == (84, 2026, 6, TELEMETRY["source"])
    assert set(ENVIRONMENT.names) < set(got.asDict())


def test_anomaly_and_risk_streams_feed_alerts(spark, tmp_path):
    topic = folder(tmp_path / "in", {**FIRE, "frp": 25.0}, FIRE, {**FIRE, "bright_t31": 225.0})
    topics = live.Topics(fire=topic, fire_to_score=topic, risk=Topic(str(tmp_path / "risk"), "text"),
                         anomalies=Topic(str(tmp_path / "anomalies"), "text"),
                         alerts=Topic(str(tmp_path / "alerts"), "text"))
    checkpoints = str(tmp_path / "c")
    run.drain(
        flows.anomaly_detection(read_messages(spark, topic), MODEL, topics.anomalies, f"{checkpoints}/a"),
        flows.risk_inference(read_messages(spark, topic), lambda e: rule_risk(e).select(*RISK_COLUMNS),
                             topics.risk.location, f"{checkpoints}/r"),
    )
    run.drain(live.generate_alerts(spark, topics, checkpoints))
    messages = [json.loads(r.value) for r in read_messages_once(spark, topics.alerts).collect()]
    risk = [m for m in messages if m["alert_source"] == "risk_prediction"]
    found = [m for m in messages if m["alert_source"] == "anomaly_detection"]
    assert len(risk) == 2 and all("anomaly_score" not in m and m["alert_level"] == "HIGH" for m in risk)
    assert [m["alert_level"] for m in found] == ["CRITICAL", "CRITICAL", "CRITICAL"]
    assert all(m["alert_message"] == "WILDFIRE ALERT: " + m["alert_reason"] for m in messages)
    assert all(m["event_timestamp"] == "2026-06-01T12:00:00.000Z" for m in messages)


def test_live_anomaly_job_reads_its_model(spark, tmp_path):
    from emberlake.sinks.models import write_anomaly_model

    write_anomaly_model(spark, MODEL, str(tmp_path / "model"))
    topics = live.Topics(fire=folder(tmp_path / "in", FIRE), anomalies=Topic(str(tmp_path / "out"), "text"))
    run.drain(live.detect_anomalies(spark, topics, str(tmp_path / "model"), str(tmp_path / "c")))
    assert read_messages_once(spark, topics.anomalies).count() == 1


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    write = sinks.folder_per_batch(str(tmp_path / "out"))
    batch = spark.range(5)
    write(batch, 0), write(batch, 0), write(batch, 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_table_writer_skips_empty_batches(spark):
    saved = []
    write = sinks.table_per_batch(Store("jdbc:x", "u", "p"), "alerts", save=lambda df, *a: saved.append(df.count()))
    write(spark.range(3), 0), write(spark.range(0), 1)
    assert saved == [3]


def test_rows_reach_a_serving_table_batch_by_batch(spark, tmp_path):
    topic, saved = folder(tmp_path / "in", FIRE, FIRE), []
    write = sinks.table_per_batch(Store("jdbc:x", "u", "p"), "t", save=lambda df, *a: saved.append(df.count()))
    run.drain(sinks.batch_sink(flows.fire_rows(read_messages(spark, topic)), write, str(tmp_path / "c")))
    assert saved == [2]


def test_served_events_are_shaped_for_their_table(spark, tmp_path):
    topic, saved = folder(tmp_path / "in", FIRE, FIRE, {**FIRE, "acq_time": "later"}), []
    writer = live.serve(flows.fire_rows(read_messages(spark, topic)), Store("jdbc:x", "u", "p"), "fire_events",
                        str(tmp_path / "c"), save=lambda df, *a: saved.append((df.collect(), a[1])))
    run.drain(writer)
    (rows_saved, table_name), = saved
    assert table_name == "fire_events" and len(rows_saved) == 1
    assert list(rows_saved[0].asDict()) == serving.SERVING_EVENT_COLUMNS and rows_saved[0].season == "Summer"


def test_served_alerts_have_real_times(spark, tmp_path):
    topic, saved = folder(tmp_path / "in", {**FIRE, "frp": 25.0}), []
    stream = flows.anomaly_rows(read_messages(spark, topic), MODEL)
    run.drain(live.serve(stream, Store("jdbc:x", "u", "p"), "anomalies", str(tmp_path / "c"),
                         save=lambda df, *a: saved.append(df.first())))
    assert saved[0].event_timestamp.hour == 12 and saved[0].alert_level == "CRITICAL"


def test_action_archive(spark, tmp_path):
    topic = folder(tmp_path / "in", {"user_id": 1, "action": "click", "ts": "2026-07-08T10:00:00"})
    run.drain(flows.action_archive(spark, topic, str(tmp_path / "out"), str(tmp_path / "c")))
    got = spark.read.schema(ACTION_EVENT).json(str(tmp_path / "out")).first()
    assert tuple(got) == (1, "click", "2026-07-08T10:00:00")


def test_run_stops_after_its_time(spark, tmp_path):
    topic = folder(tmp_path / "in", FIRE)
    writer = flows.fire_ingest(read_messages(spark, topic), str(tmp_path / "out"), str(tmp_path / "c"))
    run.run(spark, [writer], seconds=6, interval="1 second")
    assert not spark.streams.active
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_modes():
    writers = {"fire": 1, "environmental": 2}
    assert run.choose(writers, "both") == [1, 2] and run.choose(writers, "fire") == [1]
    with pytest.raises(KeyError):
        run.choose(writers, "rain")


def test_kafka_options():
    topic = Topic("firms_fire_events", servers="b:9092", per_trigger=5)
    assert topic.read_options() == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "firms_fire_events", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5",
    }
    assert "maxOffsetsPerTrigger" not in topic.read_options(streaming=False)
    assert topic.write_options() == {"kafka.bootstrap.servers": "b:9092", "topic": "firms_fire_events"}


def test_same_steps_on_messages_and_rows(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    direct = alerts.from_messages(fire_messages(lineitem), FIRE_EVENT)
    scored = anomaly.score(features.stamp_event(direct), MODEL)
    assert rows(flows.anomaly_rows(fire_messages(lineitem), MODEL)) == rows(anomaly.alerts(scored))
    assert scored.where(F.col("is_anomaly") == 1).count() > 0


def test_topic_folders_are_compressed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source_streams, "FILE_MESSAGES", 10)
    messages = spark.range(35).selectExpr("concat('message ', id) AS value").coalesce(1)
    published = publish(messages, str(tmp_path / "published"))
    source_streams.send(messages, published, "append")
    sinks.folder_per_batch(str(tmp_path / "batches"), format="text", **published.file_options())(messages, 0)
    for folder, copies in ((tmp_path / "published", 2), (tmp_path / "batches" / "batch_id=0", 1)):
        files = list(folder.glob("part-*"))
        assert len(files) == 4 * copies and all(f.name.endswith(".txt.gz") for f in files)
        read = source_streams.read_messages_once(spark, Topic(str(folder), format="text"))
        assert sorted(r.value for r in read.collect()) == sorted([f"message {i}" for i in range(35)] * copies)
