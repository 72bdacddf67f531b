import functools
import json
import math
import random
import threading

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from emberlake.functions.quantiles import approximate_quantiles, exact_quantiles
from emberlake.operators import labels, learning, metrics
from emberlake.plans import registry, training
from emberlake.plans.registry import FIXTURE_TEST, FIXTURE_TRAIN, FIXTURE_VALIDATION, feature_rows
from emberlake.sources.files import read_inferred_csv

QUICK_TREES = learning.TreeSettings(forest_trees=10, forest_depth=5, boost_rounds=5, boost_depth=4)


def discrete(values, p):
    return sorted(values)[max(1, math.ceil(len(values) * p)) - 1]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 99), kind=st.sampled_from(["spread", "hot_low", "hot_high", "two", "one"]))
def test_narrowing_gives_exact_quantiles(spark, seed, kind):
    rng = random.Random(seed)
    spread = [rng.gauss(0, 10) for _ in range(700)]
    values = {
        "spread": spread, "hot_low": spread + [-50.0] * 800, "hot_high": spread + [50.0] * 800,
        "two": [1.0] * 500 + [2.0] * 900 + spread[:5], "one": [3.0] * 1000,
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x DOUBLE")
    wanted = [0.0, 0.33, 0.66, 1.0]
    assert exact_quantiles(df, "x", wanted, finish_rows=3) == [discrete(values, p) for p in wanted]


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "frp DOUBLE")
    assert exact_quantiles(empty, "frp", [0.5]) is None
    assert approximate_quantiles(empty, "frp", [0.5]) is None
    with pytest.raises(ValueError):
        labels.risk_thresholds(empty)


def test_approximate_quantiles_stay_within_their_error(spark):
    n, error = 20_000, 0.001
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("frp"))
    low, high = labels.risk_thresholds(df, relative_error=error)
    assert abs(low - 0.33 * n) <= error * n + 1 and abs(high - 0.66 * n) <= error * n + 1


def test_equal_thresholds_are_pushed_apart(spark):
    low, high = labels.risk_thresholds(spark.createDataFrame([(2.0,)] * 9, "frp DOUBLE"))
    assert (low, high) == (2.0, 2.0 + 1e-6)


@pytest.mark.parametrize("frp, level", [
    (None, None), (1.0, "Low"), (2.0, "Low"), (2.1, "Medium"), (5.0, "Medium"), (5.1, "High"), (math.nan, "High"),
])
def test_risk_label(spark, frp, level):
    df = spark.createDataFrame([(frp,)], "frp DOUBLE")
    assert labels.risk_label(df, 2.0, 5.0).first().risk_level == level


@pytest.mark.parametrize("never_predicted", [False, True])
def test_metrics_agree_with_mllib(spark, never_predicted):
    rng = random.Random(1)
    guesses = [0.0, 1.0] if never_predicted else [0.0, 1.0, 2.0]
    rows = [(float(rng.choice([0, 1, 2, 2])), rng.choice(guesses), rng.random() * 9, rng.random() * 9)
            for _ in range(300)]
    df = spark.createDataFrame(rows, "label DOUBLE, prediction DOUBLE, frp DOUBLE, guess DOUBLE")
    ours = metrics.classifier_metrics(df).first()
    names = {"accuracy": "accuracy", "f1": "f1", "weightedPrecision": "weighted_precision",
             "weightedRecall": "weighted_recall"}
    for theirs, name in names.items():
        value = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert ours[name] == pytest.approx(value, abs=6e-5)
    ours = metrics.regressor_metrics(df, prediction="guess").first()
    for name in ("rmse", "mae", "r2"):
        value = RegressionEvaluator(labelCol="frp", predictionCol="guess", metricName=name).evaluate(df)
        assert ours[name] == pytest.approx(value, abs=6e-5)


def test_confusion_counts(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (0.0, 1.0)], "label DOUBLE, prediction DOUBLE")
    assert [tuple(r) for r in metrics.confusion_matrix(df).collect()] == [(0.0, 0.0, 1), (0.0, 1.0, 2)]


@pytest.fixture(scope="module")
def split(spark, sf_dir):
    return labels.time_split(feature_rows(spark, sf_dir), FIXTURE_TRAIN, FIXTURE_VALIDATION, FIXTURE_TEST)


def test_stored_models_score_like_fresh_ones(spark, split, tmp_path):
    trained, judged = training.train_risk(spark, split, QUICK_TREES)
    assert learning.best_classifier(training.on_test(judged)) in (learning.FOREST, learning.RISK_BOOSTED)
    assert all(figures["f1"] > 0.5 for found in judged.values() for figures in found.values())
    training.store(trained, training.RISK_MODELS, str(tmp_path))
    from emberlake.plans.live import load_risk_scorer

    events = split["test"].drop("season", "is_night")
    stored = load_risk_scorer(str(tmp_path))(events)
    fresh = learning.score_risk(training.fill_for_learning(split["test"]), trained)
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, fresh.collect()), key=repr)
    assert isinstance(OneVsRestModel.load(f"{tmp_path}/risk_classifier_gbt"), OneVsRestModel)
    assert learning.level_converter(trained.features).getLabels() == trained.levels


def test_full_training_run(spark, split, tmp_path):
    rows = functools.reduce(lambda a, b: a.unionByName(b), split.values())
    best = training.run(spark, rows, str(tmp_path / "models"), str(tmp_path / "reports"), QUICK_TREES,
                        FIXTURE_TRAIN, FIXTURE_VALIDATION, FIXTURE_TEST)
    assert set(best) == {"risk_classifier", "fire_size_regressor"}
    report = json.loads(spark.read.text(f"{tmp_path}/reports/risk_classifier_report").first().value)
    assert report["best_model"] == best["risk_classifier"]
    assert report["label_thresholds"]["frp_low_quantile"] < report["label_thresholds"]["frp_high_quantile"]
    assert set(report["models"]) == {"random_forest", "gbt_one_vs_rest"} and report["test_years"] == FIXTURE_TEST
    assert sorted(report["label_index_mapping"].values()) == ["High", "Low", "Medium"]
    for name in ("validation", "test"):
        matrix = report["models"]["gbt_one_vs_rest"][name]["confusion_matrix"]
        assert sum(n for row in matrix.values() for n in row.values()) == report["row_counts"][name]
        assert sum(report["class_distribution"][name].values()) == report["row_counts"][name]
    report = json.loads(spark.read.text(f"{tmp_path}/reports/fire_size_regressor_report").first().value)
    assert set(report["models"]["random_forest"]["test"]) == {"rmse", "mae", "r2"} and "label_thresholds" not in report


def test_training_needs_rows(spark, split):
    with pytest.raises(ValueError, match="training split"):
        training.train_size(spark, {**split, "train": split["train"].where("false")}, QUICK_TREES)


def test_unknown_prediction_index(spark):
    df = spark.createDataFrame([(0.0,), (3.0,)], "prediction DOUBLE")
    assert [r.risk_level for r in learning.name_level(df, ["High", "Low"]).collect()] == ["High", "Unknown"]


def test_two_feature_forest(spark):
    df = spark.createDataFrame([(0.5, 3.0, 0.0), (1.5, 2.5, 0.0), (6.0, 7.5, 1.0), (7.0, 6.5, 1.0)],
                               "feature1 DOUBLE, feature2 DOUBLE, label DOUBLE")
    prepared = VectorAssembler(inputCols=["feature1", "feature2"], outputCol="features").transform(df)
    model = learning.risk_forest(learning.TreeSettings(forest_trees=10)).fit(prepared)
    assert model.getNumTrees == 10


def test_in_memory_rows_to_one_csv(spark, tmp_path):
    from emberlake.sinks.tables import write_result_csv

    path = tmp_path / "actions"
    write_result_csv(spark.createDataFrame([("north", 4), ("south", 17), ("east", 23)], ["action", "count"]),
                     str(path), single_file=True)
    assert len(list(path.glob("*.csv"))) == 1
    assert {tuple(r) for r in read_inferred_csv(spark, str(path)).collect()} == {
        ("north", 4), ("south", 17), ("east", 23)}


@pytest.mark.parametrize("wrong", [None, "CAST('NaN' AS DOUBLE)", "predicted_frp + 1"])
def test_scoring_query_tells_wrong_predictions(spark, sf_dir, monkeypatch, wrong):
    train, score = training.train_size, learning.score_fire_size
    small = learning.TreeSettings(boost_rounds=2)
    monkeypatch.setattr(training, "train_size", lambda s, split, models: train(s, split, small, models))
    if wrong:
        monkeypatch.setattr(learning, "score_fire_size", lambda *a, **b: score(*a, **b).selectExpr(
            "* EXCEPT (predicted_frp)", f"{wrong} AS predicted_frp"))
    found = registry.score_fire_size(spark, sf_dir)
    assert found.count() > 0 and found.where("predicted").isEmpty() == bool(wrong)


def test_partitions_for_fitting_go_with_the_rows(spark, monkeypatch):
    """A learner's pass reads a whole partition in one task, so few input partitions must not stay few."""
    monkeypatch.setattr(training, "PARTITION_ROWS", 10)
    df = spark.range(200).select(F.lit(1.0).alias("frp")).coalesce(1)
    same = type("Same", (), {"transform": lambda self, rows: rows.withColumn("features", F.lit(0))})()
    held = training._assembled(same, {"train": df}, {"train": 200}, "frp")
    try:
        assert held["train"].rdd.getNumPartitions() == 20 and held["train"].count() == 200
        assert not held["train"].storageLevel.useMemory and held["train"].storageLevel.useDisk
    finally:
        training._release(held)


def test_fits_go_side_by_side_while_their_rows_are_few(spark):
    assert [training.lanes(n, 3) for n in (0, 1_000_000, 2_000_000, 30_000_000)] == [3, 3, 2, 1]
    both = threading.Barrier(2, timeout=60)
    assert training.side_by_side(spark, [lambda: (both.wait(), spark.range(3).count())[1], lambda: (both.wait(), 4)[1]], 2) == [3, 4]
    assert training.side_by_side(spark, [lambda: 1, lambda: 2], 1) == [1, 2]
