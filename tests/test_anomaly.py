import json
import math

import pytest

from emberlake.operators import anomaly
from emberlake.plans.training import run_anomaly
from emberlake.sinks.models import write_anomaly_model
from emberlake.sources.files import read_anomaly_model

COLUMNS = ("event_timestamp TIMESTAMP, latitude DOUBLE, longitude DOUBLE, confidence STRING, daynight STRING,"
           " year INT, frp DOUBLE, brightness DOUBLE, bright_t31 DOUBLE, scan DOUBLE, track DOUBLE")
UNIT = anomaly.ZScoreModel({c: (0.0, 1.0) for c in anomaly.FEATURES})


def frame(spark, *rows):
    return spark.createDataFrame([(None, 0.0, 0.0, "h", "D", 2020, *r) for r in rows], COLUMNS)


@pytest.mark.parametrize("frp, score, flag, level", [
    (2.999, 2.999, 0, None), (3.0, 3.0, 1, "MEDIUM"), (-3.5, 3.5, 1, "MEDIUM"), (4.0, 4.0, 1, "HIGH"),
    (5.0, 5.0, 1, "CRITICAL"),
])
def test_grades(spark, frp, score, flag, level):
    scored = anomaly.score(frame(spark, (frp, 0.0, None, 0.0, 0.0)), UNIT)
    assert (scored.first().anomaly_score, scored.first().is_anomaly) == (score, flag)
    found = anomaly.alerts(scored).first()
    assert (found and found.alert_level) == level
    if found:
        assert found.alert_reason.endswith(f"Anomaly score = {score}")


def test_missing_everywhere_is_no_anomaly(spark):
    row = anomaly.score(frame(spark, (None,) * 5), UNIT).first()
    assert (row.anomaly_score, row.is_anomaly) == (None, 0)


def test_fit_defaults(spark):
    model = anomaly.fit(frame(spark, (1.0, 5.0, None, 2.0, 0.0), (3.0, 5.0, None, None, 0.0)))
    assert model.statistics["frp"] == (2.0, pytest.approx(math.sqrt(2)))
    assert model.statistics["brightness"] == (5.0, 1.0)
    assert model.statistics["bright_t31"] == (0.0, 1.0)
    assert model.statistics["scan"] == (2.0, 1.0)


def test_fit_needs_rows(spark):
    with pytest.raises(ValueError):
        anomaly.fit(frame(spark, (1.0,) * 5).where("false"))


def test_zero_deviation_in_a_stored_model(spark):
    model = anomaly.ZScoreModel({c: (0.0, 0.0) for c in anomaly.FEATURES})
    assert anomaly.score(frame(spark, (2.0, 0.0, 0.0, 0.0, 0.0)), model).first().anomaly_score == 2.0


def test_document_round_trip(spark, tmp_path):
    path = str(tmp_path / "model")
    model = anomaly.ZScoreModel({"frp": (1.5, 0.1), "scan": (0.0, 1.0)}, 2.5, 12, (2020, 2021))
    write_anomaly_model(spark, model, path)
    assert read_anomaly_model(spark, path) == model


def test_reads_a_pretty_printed_document(spark, tmp_path):
    path = tmp_path / "model.json"
    path.write_text(json.dumps({
        "model_type": "statistical_z_score", "features": ["frp"], "threshold": 3.0,
        "statistics": {"frp": {"mean": 1.0, "std": 2.0}}, "training_years": [2020], "training_rows": 3,
    }, indent=2))
    assert read_anomaly_model(spark, str(path)).statistics == {"frp": (1.0, 2.0)}


def test_training_run(spark, tmp_path):
    df = frame(spark, *[(float(i % 3), 300.0 + i, 280.0, 0.4, 0.4) for i in range(30)], (900.0, 300.0, 280.0, 0.4, 0.4))
    counts = {r.is_anomaly: r["count"] for r in run_anomaly(spark, df, [2020], str(tmp_path / "m")).collect()}
    assert counts == {0: 30, 1: 1}
    assert read_anomaly_model(spark, str(tmp_path / "m")).training_years == (2020,)
