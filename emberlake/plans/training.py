"""Train, judge and store the risk and intensity models."""

from __future__ import annotations

import logging
import math
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import partial, reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators import anomaly, forest, labels, learning, metrics
from emberlake.operators.cleaning import fill_for_learning
from emberlake.operators.learning import FOREST, RISK_BOOSTED, SIZE_BOOSTED, Trained, TreeSettings
from emberlake.operators.validation import require_rows
from emberlake.session import ensure_checkpoints
from emberlake.sinks.models import save_model, write_anomaly_model
from emberlake.sinks.tables import write_document

log = logging.getLogger(__name__)

# Names models are stored under.
RISK_MODELS = {
    "features": "risk_feature_pipeline", FOREST: "risk_classifier_rf", RISK_BOOSTED: "risk_classifier_gbt",
}
SIZE_MODELS = {
    "features": "fire_size_feature_pipeline", FOREST: "fire_size_regressor_rf", SIZE_BOOSTED: "fire_size_regressor_gbt",
}

Split = dict[str, DataFrame]
Years = dict[str, list[int]]
Judgement = dict[str, dict]
JUDGED = ("validation", "test")

PARTITION_ROWS = 500_000
SHARED_ROWS = 4_000_000


def prepare(split: Split) -> Split:
    """Filled rows with a known target; an empty training part stops the run."""
    ready = {name: labels.with_target(fill_for_learning(df)) for name, df in split.items()}
    require_rows(ready["train"], "the training split")
    return ready


def _assembled(features, split: Split, rows: dict[str, int], *keep: str) -> Split:
    """Only what fitting and judging read, kept on executors' disks: memory is for what the learners keep themselves.

    Every pass of a learner reads whole partitions, so their number goes with the rows.
    """
    cores = next(iter(split.values())).sparkSession.sparkContext.defaultParallelism
    return {
        name: (features.transform(df).select("features", *keep)
               .repartition(max(cores, math.ceil(rows[name] / PARTITION_ROWS))).persist(StorageLevel.DISK_ONLY))
        for name, df in split.items()
    }


def lanes(rows: int, wanted: int) -> int:
    """How many fits go side by side: a learner keeps its rows, so together they keep at most ``SHARED_ROWS``, or one fit's."""
    return max(1, min(wanted, SHARED_ROWS // max(rows, 1)))


def side_by_side(spark: SparkSession, jobs: list[Callable[[], object]], at_once: int) -> list:
    """Results in the order of ``jobs``. A small fit is mostly many short Spark jobs, which leave cores idle by themselves."""
    if at_once == 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def fitted(learner, rows: DataFrame):
    """Forests by sums of binned rows, everything else by the learner itself."""
    return forest.fit(learner, rows) if isinstance(learner, forest.Forest) else learner.fit(rows)


def _release(split: Split) -> None:
    for df in split.values():
        df.unpersist()


def _predictions(model, assembled: Split, *keep: str) -> DataFrame:
    """Validation and test predictions together, so that one pass judges both."""
    return _stacked({s: model.transform(assembled[s]) for s in JUDGED}, "prediction", *keep)


def _stacked(split: Split, *columns: str) -> DataFrame:
    named = [df.select(F.lit(name).alias("split"), *columns) for name, df in split.items()]
    return reduce(DataFrame.unionByName, named)


def judge_classes(predictions: DataFrame) -> Judgement:
    """One pass for the confusion counts; every figure follows from that handful of rows."""
    counted = metrics.confusion_matrix(predictions, by=("split",))
    cells = counted.collect()
    small = predictions.sparkSession.createDataFrame(cells, counted.schema)
    judged = {r.split: r.asDict() for r in metrics.metrics_from_counts(small, by=("split",)).collect()}
    for name, figures in judged.items():
        del figures["split"]
        rows = [c for c in cells if c.split == name]
        figures["confusion_matrix"] = {
            str(actual): {str(c.prediction): c["count"] for c in rows if c.label == actual}
            for actual in sorted({c.label for c in rows})
        }
    return judged


def judge_values(predictions: DataFrame) -> Judgement:
    rows = metrics.regressor_metrics(predictions, by=("split",)).collect()
    return {r.split: {name: r[name] for name in ("rmse", "mae", "r2")} for r in rows}


def class_counts(labelled: Split) -> dict[str, dict[str, int]]:
    rows = labels.label_distribution(_stacked(labelled, "risk_level"), by=("split",)).collect()
    return {name: {r.risk_level: r["count"] for r in rows if r.split == name} for name in labelled}


def row_counts(split: Split) -> dict[str, int]:
    rows = _stacked(split, learning.TARGET).groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()
    return {name: sum(r.n for r in rows if r.split == name) for name in split}


def train_risk(spark: SparkSession, split: Split, settings: TreeSettings = TreeSettings(),
               models: tuple[str, ...] = (FOREST, RISK_BOOSTED), relative_error: float = 0.001,
               quantiles: tuple[float, float] = (labels.LOW_QUANTILE, labels.HIGH_QUANTILE),
               ) -> tuple[Trained, dict[str, Judgement]]:
    """Labels from training quantiles, then the chosen classifiers, judged on validation and test rows."""
    ensure_checkpoints(spark)
    ready = prepare(split)
    low, high = labels.risk_thresholds(ready["train"], *quantiles, relative_error=relative_error)
    labelled = {name: labels.risk_label(df, low, high) for name, df in ready.items()}
    features = learning.fit_risk_features(labelled["train"])
    rows = row_counts(labelled)
    assembled = _assembled(features, labelled, rows, "label", "risk_level")
    settings = replace(settings, parallel_models=lanes(rows["train"], settings.parallel_models))
    learners = {FOREST: learning.risk_forest, RISK_BOOSTED: learning.risk_boosted}
    trained, judged = Trained(features, {}, (low, high)), {}

    def fit(name: str) -> tuple:
        model = fitted(learners[name](settings), assembled["train"])
        return name, model, judge_classes(_predictions(model, assembled, "label"))

    try:
        for name, trained.models[name], judged[name] in side_by_side(spark, [partial(fit, m) for m in models], lanes(rows["train"], len(models))):
            log.info("%s is fitted", name)
        trained.classes = class_counts(assembled)
        trained.rows = {name: sum(counts.values()) for name, counts in trained.classes.items()}
    finally:
        _release(assembled)
    return trained, judged


def train_size(spark: SparkSession, split: Split, settings: TreeSettings = TreeSettings(),
               models: tuple[str, ...] = (FOREST, SIZE_BOOSTED)) -> tuple[Trained, dict[str, Judgement]]:
    ensure_checkpoints(spark)
    ready = prepare(split)
    features = learning.fit_features(ready["train"])
    rows = row_counts(ready)
    assembled = _assembled(features, ready, rows, learning.TARGET)
    learners = {FOREST: learning.intensity_forest, SIZE_BOOSTED: learning.intensity_boosted}
    trained, judged = Trained(features), {}

    def fit(name: str) -> tuple:
        model = fitted(learners[name](settings), assembled["train"])
        return name, model, judge_values(_predictions(model, assembled, learning.TARGET))

    try:
        for name, trained.models[name], judged[name] in side_by_side(spark, [partial(fit, m) for m in models], lanes(rows["train"], len(models))):
            log.info("%s is fitted", name)
        trained.rows = row_counts(assembled)
    finally:
        _release(assembled)
    return trained, judged


def metric_rows(spark: SparkSession, judged: dict[str, Judgement]) -> DataFrame:
    """Two rows per model: a handful of numbers, whatever the data size."""
    rows = [{"model": name, "split": s, **figures} for name, found in judged.items() for s, figures in found.items()]
    columns = [c for c in rows[0] if c != "confusion_matrix"]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], columns)


def on_test(judged: dict[str, Judgement]) -> dict[str, dict]:
    return {name: found["test"] for name, found in judged.items()}


def store(trained: Trained, names: dict[str, str], models_dir: str) -> None:
    save_model(trained.features, f"{models_dir}/{names['features']}")
    for name, model in trained.models.items():
        save_model(model, f"{models_dir}/{names[name]}")


def report(trained: Trained, judged: dict[str, Judgement], years: Years, best: str, seconds: float) -> dict:
    """Evaluation report: inputs, label definition where there is one, figures per model, and the winner."""
    document = {
        "generated_at": time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime()),
        "duration_seconds": round(seconds, 2),
        **{f"{name}_years": list(wanted) for name, wanted in years.items()},
        "row_counts": trained.rows,
        "models": judged,
        "best_model": best,
    }
    if trained.thresholds:
        low, high = trained.thresholds
        document |= {
            "label_thresholds": {"frp_low_quantile": low, "frp_high_quantile": high},
            "label_index_mapping": {str(i): level for i, level in enumerate(trained.levels)},
            "class_distribution": trained.classes,
        }
    return document


def run(spark: SparkSession, features: DataFrame, models_dir: str, reports_dir: str,
        settings: TreeSettings = TreeSettings(), train: list[int] | None = None,
        validation: list[int] | None = None, test: list[int] | None = None,
        quantiles: tuple[float, float] = (labels.LOW_QUANTILE, labels.HIGH_QUANTILE)) -> dict[str, str]:
    """Both trainings on a feature table; returns the best model of each kind."""
    years = {"train": train or labels.TRAIN_YEARS, "validation": validation or labels.VALIDATION_YEARS,
             "test": test or labels.TEST_YEARS}
    split = labels.time_split(features, **years)
    jobs = {
        "risk_classifier": (partial(train_risk, quantiles=quantiles), learning.best_classifier, RISK_MODELS),
        "fire_size_regressor": (train_size, learning.best_regressor, SIZE_MODELS),
    }
    best = {}
    for job, (train_models, choose, names) in jobs.items():
        started = time.monotonic()
        trained, judged = train_models(spark, split, settings)
        best[job] = choose(on_test(judged))
        store(trained, names, models_dir)
        document = report(trained, judged, years, best[job], time.monotonic() - started)
        write_document(spark, document, f"{reports_dir}/{job}_report")
    return best


def run_anomaly(spark: SparkSession, features: DataFrame, years: list[int], path: str) -> DataFrame:
    """Fit the z-score model on the given years, store its document, and return how it judges them."""
    started = time.monotonic()
    known = labels.in_years(features, years)
    model = anomaly.fit(known, years=tuple(years))
    write_anomaly_model(spark, model, path, time.monotonic() - started)
    return anomaly.distribution(anomaly.score(known, model))
