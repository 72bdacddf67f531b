"""Every operator as a query over the provided tables.

Each entry takes ``(spark, sf_dir)`` and reads its tables whole. Timestamps are
handed out zone-less and sums of doubles rounded, so that results compare
exactly with another engine.
"""

from __future__ import annotations

import functools
import json
import time
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from emberlake.functions.text import clock_time
from emberlake.operators import (
    alerts, anomaly, cleaning, dedup, features, labels, learning, metrics, profiling, quality, serving, validation,
)
from emberlake.operators.words import word_count as count_words
from emberlake.plans import history, live, profiles, training
from emberlake.schemas import (
    ACTION_EVENT, ALERT_MESSAGE, ANOMALY_COLUMNS, ANOMALY_MESSAGE, FEATURE_COLUMNS, FIRE_EVENT, RAW_NRT,
    RISK_COLUMNS, RISK_MESSAGE,
)
from emberlake.session import new_work_dir, store_once, use_utc
from emberlake.sinks.models import write_anomaly_model
from emberlake.sinks.streams import batch_sink, folder_per_batch
from emberlake.sinks.tables import open_writers, write_document, write_raw_sample, write_result_csv, write_text
from emberlake.sources import files
from emberlake.sources.streams import Topic, read_messages, read_messages_once, send
from emberlake.sources.tables import (
    FIXTURE_TEST, FIXTURE_TRAIN, FIXTURE_VALIDATION, environment_view, fire, fire_view, table,
)
from emberlake.streaming import flows
from emberlake.streaming.run import drain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIXTURE_YEARS = FIXTURE_TRAIN + FIXTURE_VALIDATION + FIXTURE_TEST
FIT_YEARS = FIXTURE_TRAIN + FIXTURE_VALIDATION
STAT_DIGITS = 9


def zoneless(df: DataFrame) -> DataFrame:
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


def query(build: Query) -> Query:
    @functools.wraps(build)
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zoneless(build(use_utc(spark), sf_dir))

    QUERIES[build.__name__] = wrapped
    return wrapped


# Stages the queries share -------------------------------------------------------------------

def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fire(spark, sf_dir, with_year=True)


def canonical(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return cleaning.clean(raw(spark, sf_dir), cleaning.is_near_real_time(), keep)


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.drop_duplicate_detections(validation.valid_rows(canonical(spark, sf_dir)))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.batch_features(curated(spark, sf_dir))


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitting and using a model both read the features, so the dedup behind them runs once."""
    return store_once(feature_rows(spark, sf_dir), "features")


def fit_anomaly(rows: DataFrame) -> anomaly.ZScoreModel:
    return anomaly.fit(labels.in_years(rows, FIT_YEARS), years=tuple(FIT_YEARS), digits=STAT_DIGITS)


def fitted(spark: SparkSession, sf_dir: str) -> anomaly.ZScoreModel:
    return fit_anomaly(feature_rows(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_features(spark, sf_dir)
    return anomaly.score(rows, fit_anomaly(rows))


def split_name() -> Column:
    year = F.col("year")
    return (F.when(year.isin(FIXTURE_TRAIN), "train").when(year.isin(FIXTURE_VALIDATION), "validation")
            .when(year.isin(FIXTURE_TEST), "test"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labels.with_target(stored_features(spark, sf_dir))
    low, high = labels.risk_thresholds(labels.in_years(rows, FIXTURE_TRAIN), relative_error=0)
    return labels.risk_label(rows, low, high).withColumn("split", split_name())


def rule_risk(df: DataFrame) -> DataFrame:
    """A fixed stand-in for a fitted classifier: cuts on the second brightness channel."""
    t31 = F.col("bright_t31")
    index = F.when(t31 > 254, 0.0).when(t31 > 237, 2.0).otherwise(1.0)
    return learning.name_level(df.withColumn("prediction", index), ["High", "Low", "Medium"])


def risk_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_risk(curated(spark, sf_dir)).select(*RISK_COLUMNS)


def all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_features(spark, sf_dir)
    found = anomaly.alerts(anomaly.score(rows, fit_anomaly(rows)))
    return alerts.merge_alerts(rule_risk(rows).select(*RISK_COLUMNS), found)


def served_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.event_rows(curated(spark, sf_dir))


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For questions that look at the serving table twice."""
    return store_once(served_events(spark, sf_dir), "events")


def stored_split(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return labels.time_split(stored_features(spark, sf_dir), FIXTURE_TRAIN, FIXTURE_VALIDATION, FIXTURE_TEST)


# Cleaning, validation, dedup ----------------------------------------------------------------

@query
def clean_canonical(spark, sf_dir):
    return canonical(spark, sf_dir)


@query
def time_normalise(spark, sf_dir):
    times = fire(spark, sf_dir).groupBy("acq_time").agg(F.count(F.lit(1)).alias("row_count"))
    return times.withColumn("clock", clock_time(F.col("acq_time")))


@query
def nrt_union(spark, sf_dir):
    rows = fire(spark, sf_dir)
    near = cleaning.is_near_real_time()
    return files.union_products(rows.where(~near), rows.where(near).select(*RAW_NRT.names))


@query
def event_parse(spark, sf_dir):
    rows = fire(spark, sf_dir)
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    return cleaning.parse_events(as_text, cleaning.is_near_real_time())


@query
def validity_counts(spark, sf_dir):
    return validation.validity_counts(canonical(spark, sf_dir, ("source_year",)), ["source_year"])


@query
def quarantine(spark, sf_dir):
    return validation.quarantined_rows(canonical(spark, sf_dir))


@query
def contract_report(spark, sf_dir):
    return validation.contract_report(canonical(spark, sf_dir))


@query
def dedup_detections(spark, sf_dir):
    return curated(spark, sf_dir)


@query
def dedup_serving(spark, sf_dir):
    return dedup.drop_duplicate_events(validation.valid_rows(canonical(spark, sf_dir)))


# Features -----------------------------------------------------------------------------------

@query
def features_batch(spark, sf_dir):
    return feature_rows(spark, sf_dir).select(*FEATURE_COLUMNS)


@query
def features_stream_variant(spark, sf_dir):
    return features.inference_features(canonical(spark, sf_dir)).select(*FEATURE_COLUMNS)


@query
def features_ingest(spark, sf_dir):
    return features.ingest_features(validation.in_stream_bounds(canonical(spark, sf_dir)))


@query
def features_environment(spark, sf_dir):
    telemetry = environment_view(table(spark, sf_dir, "events"))
    return features.environment_features(validation.in_stream_bounds(telemetry))


# Quality and profile ------------------------------------------------------------------------

@query
def quality_report(spark, sf_dir):
    return quality.quality_report(canonical(spark, sf_dir, ("source_year",)), ["source_year"])


@query
def quality_overall(spark, sf_dir):
    return quality.overall_quality(quality_report(spark, sf_dir))


@query
def profile_nulls(spark, sf_dir):
    return profiling.null_counts(raw(spark, sf_dir), ["source_year"])


@query
def profile_ranges(spark, sf_dir):
    return profiling.range_profile(raw(spark, sf_dir), ["source_year"])


@query
def profile_dates(spark, sf_dir):
    return profiling.date_profile(raw(spark, sf_dir), ["source_year"])


@query
def profile_distinct(spark, sf_dir):
    found = profiling.distinct_values(raw(spark, sf_dir), ["source_year"])
    return found.withColumn("values", F.array_join("values", ","))


@query
def profile_categories(spark, sf_dir):
    """Every value of every category, however many there are."""
    return profiling.category_counts(raw(spark, sf_dir), ["source_year"])


@query
def profile_duplicates(spark, sf_dir):
    return profiling.duplicate_profile(raw(spark, sf_dir), ["source_year"])


@query
def profile_summary(spark, sf_dir):
    return profiling.summary_table(profiling.profile(raw(spark, sf_dir), ["source_year"]), ["source_year"])


@query
def profile_totals(spark, sf_dir):
    return profiling.grand_totals(profiling.profile(raw(spark, sf_dir), ["source_year"]))


# Anomalies ----------------------------------------------------------------------------------

def model_rows(model: DataFrame) -> DataFrame:
    """One row per feature from the one-row fit result."""
    each = [F.struct(F.lit(c).alias("feature"), F.round(f"{c}.mean", STAT_DIGITS).alias("mean"),
                     F.round(f"{c}.std", STAT_DIGITS).alias("std")) for c in anomaly.FEATURES]
    return model.select("training_rows", F.inline(F.array(*each)))


@query
def zscore_fit(spark, sf_dir):
    known = labels.in_years(feature_rows(spark, sf_dir), FIT_YEARS)
    return model_rows(anomaly.fit_statistics(known))


@query
def anomaly_model_document(spark, sf_dir):
    path = new_work_dir(spark, "anomaly-model")
    started = time.monotonic()
    write_anomaly_model(spark, fitted(spark, sf_dir), path, time.monotonic() - started)
    model = files.read_anomaly_model(spark, path)
    rows = [(model.training_rows, c, mean, std) for c, (mean, std) in model.statistics.items()]
    return spark.createDataFrame(rows, "training_rows BIGINT, feature STRING, mean DOUBLE, std DOUBLE")


@query
def anomaly_scored(spark, sf_dir):
    z = [f"{c}_z" for c in anomaly.FEATURES]
    return scored(spark, sf_dir).select(
        "event_timestamp", "latitude", "longitude", *z, "anomaly_score", "is_anomaly"
    )


@query
def anomaly_distribution(spark, sf_dir):
    return anomaly.distribution(scored(spark, sf_dir))


@query
def anomaly_alerts(spark, sf_dir):
    return anomaly.alerts(scored(spark, sf_dir))


# Risk labels and metrics --------------------------------------------------------------------

@query
def risk_thresholds(spark, sf_dir):
    train = labels.in_years(stored_features(spark, sf_dir), FIXTURE_TRAIN)
    found = labels.risk_thresholds(labels.with_target(train), relative_error=0)
    return spark.createDataFrame([found], "low DOUBLE, high DOUBLE")


@query
def risk_labelled(spark, sf_dir):
    return labelled(spark, sf_dir).select("split", "event_timestamp", "latitude", "longitude", "frp", "risk_level")


@query
def label_distribution(spark, sf_dir):
    return labels.label_distribution(labelled(spark, sf_dir), by=("split",))


@query
def ml_null_fill(spark, sf_dir):
    return cleaning.fill_for_learning(feature_rows(spark, sf_dir)).select(*FEATURE_COLUMNS)


def judged_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = labelled(spark, sf_dir).withColumnRenamed("risk_level", "label")
    return rule_risk(truth).select("split", "label", F.col("risk_level").alias("prediction"))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(judged_risk(spark, sf_dir), by=("split",))


@query
def classifier_metrics(spark, sf_dir):
    return metrics.classifier_metrics(judged_risk(spark, sf_dir), by=("split",))


@query
def regressor_metrics(spark, sf_dir):
    rows = labels.with_target(feature_rows(spark, sf_dir)).withColumn("split", split_name())
    guess = (F.col("bright_t31") - 220.0) * 0.5
    return metrics.regressor_metrics(rows.withColumn("prediction", guess), by=("split",))


def learning_split(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return training.prepare(stored_split(spark, sf_dir))


@query
def split_counts(spark, sf_dir):
    rows = learning_split(spark, sf_dir)
    named = [df.select(F.lit(name).alias("split"), "season") for name, df in rows.items()]
    return functools.reduce(DataFrame.unionByName, named).groupBy("split").agg(F.count(F.lit(1)).alias("row_count"))


@query
def label_index(spark, sf_dir):
    """Label order as fitted on the training rows: most frequent first."""
    train = learning_split(spark, sf_dir)["train"]
    low, high = labels.risk_thresholds(train, relative_error=0)
    fitted_index = learning.label_indexer().fit(labels.risk_label(train, low, high))
    return spark.createDataFrame(list(enumerate(fitted_index.labels)), "index INT, risk_level STRING")


@query
def category_index(spark, sf_dir):
    """Category order of every indexed column, from the same fit."""
    stages = learning.fit_features(learning_split(spark, sf_dir)["train"]).stages
    rows = [(c, v, i) for c, values in zip(learning.CATEGORICAL, stages[0].labelsArray) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "column_name STRING, value STRING, index INT")


@query
def feature_vectors(spark, sf_dir):
    """Assembled vectors of all splits, as length and position-weighted sum."""
    rows = learning_split(spark, sf_dir)
    fitted_features = learning.fit_features(rows["train"])
    vectors = fitted_features.transform(functools.reduce(DataFrame.unionByName, rows.values()))
    values = vector_to_array("features")
    weighted = F.aggregate(F.transform(values, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    return vectors.select("event_timestamp", "latitude", "longitude", F.size(values).alias("vector_size"),
                          F.round(weighted, 6).alias("weighted_sum"))


def compared(found: DataFrame, spark: SparkSession, named: list[tuple]) -> DataFrame:
    """``found`` beside a few figures from a report, by model and split."""
    return found.join(F.broadcast(spark.createDataFrame(named, "model STRING, split STRING, reported DOUBLE, matrix_rows BIGINT")), ["model", "split"])


def risk_checks(spark: SparkSession, split: dict[str, DataFrame], trained: learning.Trained, judged: dict) -> DataFrame:
    """Judged rows, rows of the confusion matrix, and whether the reported accuracy follows from the predictions."""
    ready = training.prepare(split)
    scored = [model.transform(trained.features.transform(labels.risk_label(ready[part], *trained.thresholds)))
              .select(F.lit(name).alias("model"), F.lit(part).alias("split"), (F.col("prediction") == F.col("label")).alias("hit"))
              for name, model in trained.models.items() for part in training.JUDGED]
    found = functools.reduce(DataFrame.unionByName, scored).groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("judged_rows"), F.avg(F.col("hit").cast("double")).alias("accuracy"))
    named = [(name, part, float(figures["accuracy"]), sum(n for row in figures["confusion_matrix"].values() for n in row.values()))
             for name, parts in judged.items() for part, figures in parts.items()]
    return compared(found, spark, named).select(
        "model", "split", "judged_rows", "matrix_rows", (F.abs(F.col("accuracy") - F.col("reported")) < 1e-3).alias("figures_agree"))


def size_checks(spark: SparkSession, split: dict[str, DataFrame], trained: learning.Trained, judged: dict) -> DataFrame:
    """Judged rows, and whether the reported error follows from the predictions and the other figures fit it."""
    ready = training.prepare(split)
    scored = [model.transform(trained.features.transform(ready[part]))
              .select(F.lit(name).alias("model"), F.lit(part).alias("split"), (F.col("prediction") - F.col(learning.TARGET)).alias("miss"))
              for name, model in trained.models.items() for part in training.JUDGED]
    found = functools.reduce(DataFrame.unionByName, scored).groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("judged_rows"), F.sqrt(F.avg(F.col("miss") * F.col("miss"))).alias("rmse"))
    named = [(name, part, float(figures["rmse"]) if figures["mae"] <= figures["rmse"] and figures["r2"] <= 1 else None, None)
             for name, parts in judged.items() for part, figures in parts.items()]
    agree = F.coalesce(F.abs(F.col("rmse") - F.col("reported")) < 1e-3, F.lit(False))
    return compared(found, spark, named).select("model", "split", "judged_rows", agree.alias("figures_agree"))


@query
def train_risk_rf(spark, sf_dir):
    """The four trainings use the default model sizes."""
    split = stored_split(spark, sf_dir)
    return risk_checks(spark, split, *training.train_risk(spark, split, models=(learning.FOREST,)))


@query
def train_risk_gbt_ovr(spark, sf_dir):
    split = stored_split(spark, sf_dir)
    return risk_checks(spark, split, *training.train_risk(spark, split, models=(learning.RISK_BOOSTED,)))


@query
def train_frp_rf(spark, sf_dir):
    split = stored_split(spark, sf_dir)
    return size_checks(spark, split, *training.train_size(spark, split, models=(learning.FOREST,)))


@query
def train_frp_gbt(spark, sf_dir):
    split = stored_split(spark, sf_dir)
    return size_checks(spark, split, *training.train_size(spark, split, models=(learning.SIZE_BOOSTED,)))


@query
def select_best(spark, sf_dir):
    """Both trainings, as their stored reports tell them: rows per split, and whether the best model has the best figure."""
    split, base = stored_split(spark, sf_dir), new_work_dir(spark, "evaluation")
    years = {"train": FIXTURE_TRAIN, "validation": FIXTURE_VALIDATION, "test": FIXTURE_TEST}
    targets = (("risk", training.train_risk, learning.best_classifier, "f1", max),
               ("fire_size", training.train_size, learning.best_regressor, "rmse", min))
    jobs = [functools.partial(train, spark, split) for _, train, *_ in targets]
    fitted_models = training.side_by_side(spark, jobs, training.lanes(split["train"].count(), len(jobs)))
    rows = []
    for (target, _, choose, figure, order), (trained, judged) in zip(targets, fitted_models):
        document = training.report(trained, judged, years, choose(training.on_test(judged)), 0.0)
        write_document(spark, document, f"{base}/{target}")
        stored = json.loads(files.read_text(spark, f"{base}/{target}").first().value)
        figures = {name: parts["test"][figure] for name, parts in stored["models"].items()}
        rows.append((target, len(figures), *[stored["row_counts"][part] for part in years],
                     figures[stored["best_model"]] == order(figures.values())))
    return spark.createDataFrame(rows, "target STRING, models INT, train BIGINT, validation BIGINT, test BIGINT, best_is_best BOOLEAN")


@query
def score_risk(spark, sf_dir):
    """Checked are the stored predictions: without storing, Spark knows that there is one and leaves the model out."""
    split = stored_split(spark, sf_dir)
    trained, _ = training.train_risk(spark, split, models=(learning.RISK_BOOSTED,))
    predicted = store_once(learning.score_risk(cleaning.fill_for_learning(split["test"]), trained), "scored-risk")
    is_level = F.col("prediction").isin([float(i) for i in range(len(trained.levels))])
    return predicted.select("event_timestamp", "latitude", "longitude", "frp", F.coalesce(is_level, F.lit(False)).alias("predicted"),
                            F.col("risk_level").isin(trained.levels).alias("known_level"))


@query
def score_fire_size(spark, sf_dir):
    """Served rows, from stored predictions: whether each is a number, and all have the error reported for the model."""
    split = stored_split(spark, sf_dir)
    trained, judged = training.train_size(spark, split, models=(learning.SIZE_BOOSTED,))
    test = cleaning.fill_for_learning(split["test"])
    predicted = store_once(learning.score_fire_size(test, trained, keep=(learning.TARGET,)), "scored-size")
    miss = F.col("predicted_frp") - F.col(learning.TARGET)
    error = labels.with_target(predicted).agg(F.sqrt(F.avg(miss * miss))).first()[0]
    agrees = error is None or abs(error - judged[learning.SIZE_BOOSTED]["test"]["rmse"]) < 1e-3
    served = serving.conforming_rows(predicted, "fire_size_predictions")
    is_number = F.col("predicted_frp").isNotNull() & ~F.isnan("predicted_frp") & (F.abs("predicted_frp") < float("inf"))
    return served.select("event_timestamp", "latitude", "longitude", "model_version", (is_number & F.lit(agrees)).alias("predicted"))


# Alerts -------------------------------------------------------------------------------------

@query
def risk_alerts(spark, sf_dir):
    return alerts.risk_alerts(risk_predictions(spark, sf_dir))


@query
def merged_alerts(spark, sf_dir):
    return all_alerts(spark, sf_dir)


@query
def alert_json(spark, sf_dir):
    return alerts.from_messages(alerts.to_messages(all_alerts(spark, sf_dir)), ALERT_MESSAGE)


# Streams ------------------------------------------------------------------------------------

def fire_messages(lineitem: DataFrame) -> DataFrame:
    """Detections as the JSON messages of a live feed, ``acq_time`` already ``HH:MM``."""
    cleaned = cleaning.clean(fire_view(lineitem), cleaning.is_near_real_time())
    return alerts.to_messages(cleaned.select(*FIRE_EVENT.names))


def publish(messages: DataFrame, location: str) -> Topic:
    """Messages as a topic folder, for the streams to read as they would a broker's topic."""
    topic = Topic(location, format="text")
    send(messages, topic)
    return topic


def live_fire(spark: SparkSession, sf_dir: str, base: str) -> Topic:
    return publish(fire_messages(table(spark, sf_dir, "lineitem")), f"{base}/fire")


@query
def stream_fire_ingest(spark, sf_dir):
    base = new_work_dir(spark, "fire-ingest")
    rows = read_messages(spark, live_fire(spark, sf_dir, base))
    drain(flows.fire_ingest(rows, f"{base}/out", f"{base}/checkpoint"))
    return spark.read.schema(flows.fire_rows(rows).schema).parquet(f"{base}/out")


@query
def stream_env_ingest(spark, sf_dir):
    base = new_work_dir(spark, "environment-ingest")
    telemetry = alerts.to_messages(environment_view(table(spark, sf_dir, "events")))
    rows = read_messages(spark, publish(telemetry, f"{base}/environment"))
    drain(flows.environment_ingest(rows, f"{base}/out", f"{base}/checkpoint"))
    return spark.read.schema(flows.environment_rows(rows).schema).parquet(f"{base}/out")


@query
def stream_anomaly(spark, sf_dir):
    base = new_work_dir(spark, "anomaly-stream")
    rows = read_messages(spark, live_fire(spark, sf_dir, base))
    out = Topic(f"{base}/anomalies", format="text")
    drain(flows.anomaly_detection(rows, fitted(spark, sf_dir), out, f"{base}/checkpoint"))
    return alerts.from_messages(read_messages_once(spark, out), ANOMALY_MESSAGE).select(*ANOMALY_COLUMNS)


@query
def stream_risk(spark, sf_dir):
    """Train and store, then score the live feed with the boosted one-vs-rest model read back from storage."""
    base = new_work_dir(spark, "risk-stream")
    trained, _ = training.train_risk(spark, stored_split(spark, sf_dir), models=(learning.RISK_BOOSTED,))
    training.store(trained, training.RISK_MODELS, f"{base}/models")
    rows, out = read_messages(spark, live_fire(spark, sf_dir, base)), Topic(f"{base}/predictions", format="text")
    drain(flows.risk_inference(rows, live.load_risk_scorer(f"{base}/models"), out.location, f"{base}/checkpoint"))
    found = alerts.from_messages(read_messages_once(spark, out), RISK_MESSAGE)
    return found.select("event_timestamp", "latitude", "longitude", "frp", F.col("risk_level").isin(trained.levels).alias("known_level"))


@query
def stream_alerts(spark, sf_dir):
    """Risk and anomaly streams into their topics, then both topics into one alert feed."""
    base = new_work_dir(spark, "alert-stream")
    risk, anomalies, out = (Topic(f"{base}/{n}", format="text") for n in ("risk", "anomalies", "alerts"))
    fire_topic, model = live_fire(spark, sf_dir, base), fitted(spark, sf_dir)
    drain(
        flows.risk_inference(read_messages(spark, fire_topic), lambda e: rule_risk(e).select(*RISK_COLUMNS),
                             risk.location, f"{base}/checkpoint-risk"),
        flows.anomaly_detection(read_messages(spark, fire_topic), model, anomalies, f"{base}/checkpoint-anomalies"),
    )
    drain(flows.alert_generation(read_messages(spark, risk), read_messages(spark, anomalies), out,
                                 f"{base}/checkpoint-alerts"))
    return alerts.from_messages(read_messages_once(spark, out), ALERT_MESSAGE)


@query
def stream_batch_tables(spark, sf_dir):
    """Per-micro-batch table writes: each batch to its own replaceable folder."""
    base = new_work_dir(spark, "batch-tables")
    write = folder_per_batch(f"{base}/out", flows.fire_rows)
    drain(batch_sink(read_messages(spark, live_fire(spark, sf_dir, base)), write, f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@query
def stream_batch_replay(spark, sf_dir):
    """A micro-batch written twice, as after a failure, replaces itself."""
    base = new_work_dir(spark, "batch-replay")
    write = folder_per_batch(f"{base}/out", flows.fire_rows)
    messages = read_messages_once(spark, live_fire(spark, sf_dir, base))
    for _ in range(2):
        write(messages, 0)
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@query
def stream_action_archive(spark, sf_dir):
    """User actions from a topic into a JSON archive."""
    base = new_work_dir(spark, "actions")
    acted = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("user_id"), F.col("event_type").alias("action"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"))
    topic = publish(alerts.to_messages(acted), f"{base}/actions")
    drain(flows.action_archive(spark, topic, f"{base}/out", f"{base}/checkpoint"))
    return spark.read.schema(ACTION_EVENT).json(f"{base}/out")


# Serving ------------------------------------------------------------------------------------

@query
def serving_rows(spark, sf_dir):
    return serving.conforming_rows(served_events(spark, sf_dir), "fire_events").drop("event_id", "created_at")


@query
def serving_rejected(spark, sf_dir):
    """Events of which some break a rule of the table (key, length, range), split into kept and rejected ones."""
    broken = served_events(spark, sf_dir).withColumns({
        "latitude": F.when(F.col("type") == 1, F.lit(None)).otherwise(F.col("latitude")),
        "confidence": F.when(F.col("type") == 2, F.repeat(F.lit("x"), F.lit(11))).otherwise(F.col("confidence")),
        "year": F.when(F.col("type") == 3, F.lit(40_000)).otherwise(F.col("year"))})
    stored = store_once(broken, "broken-events")
    sides = {"kept": serving.conforming_rows(stored, "fire_events"), "rejected": serving.rejected_rows(stored, "fire_events")}
    named = [df.select(F.lit(side).alias("side"), F.col("type").cast("int").alias("type")) for side, df in sides.items()]
    return functools.reduce(DataFrame.unionByName, named).groupBy("side", "type").agg(F.count(F.lit(1)).alias("row_count"))


@query
def serving_alert_rows(spark, sf_dir):
    return serving.conforming_rows(all_alerts(spark, sf_dir), "alerts").drop("alert_id", "created_at")


@query
def daily_fire_kpis(spark, sf_dir):
    return serving.daily_fire_kpis(served_events(spark, sf_dir))


@query
def fire_kpis(spark, sf_dir):
    kpis = serving.fire_kpis(served_events(spark, sf_dir))
    return kpis.withColumns({c: F.round(c, 6) for c in ("total_frp", "avg_frp")})


@query
def risk_distribution(spark, sf_dir):
    return serving.risk_distribution(risk_predictions(spark, sf_dir))


@query
def anomaly_summary(spark, sf_dir):
    return serving.anomaly_summary(scored(spark, sf_dir))


@query
def active_alerts(spark, sf_dir):
    """Load time is taken as the observation time, so that the newest 500 are the same everywhere."""
    rows = serving.conforming_rows(all_alerts(spark, sf_dir), "alerts", created_at=F.col("event_timestamp"))
    return serving.active_alerts(rows).drop("alert_id")


@query
def recent_events(spark, sf_dir):
    return serving.recent_events(served_events(spark, sf_dir))


@query
def event_date_bounds(spark, sf_dir):
    return serving.event_date_bounds(served_events(spark, sf_dir))


@query
def map_points(spark, sf_dir):
    return serving.map_points(serving.on_date(stored_events(spark, sf_dir)))


@query
def recent_table(spark, sf_dir):
    """All events of the newest day."""
    return serving.recent_table(serving.on_date(stored_events(spark, sf_dir)))


@query
def load_gate(spark, sf_dir):
    return validation.load_gate(served_events(spark, sf_dir))


# Files --------------------------------------------------------------------------------------

SAMPLE_ROWS = 100


def write_year_folders(spark: SparkSession, sf_dir: str, base: str, one_file: bool = False) -> None:
    """Raw detections as headered CSV per year, archive and near-real-time files side by side."""
    rows = raw(spark, sf_dir)
    if one_file:
        rows = rows.repartition("source_year")
    near = cleaning.is_near_real_time()
    products = {"fire_archive": rows.where(~near), "fire_nrt": rows.where(near).drop("type")}
    with open_writers(spark, len(FIXTURE_YEARS)):
        for name, product in products.items():
            (product.write.mode("append").partitionBy("source_year")
             .option("header", True).option("mapreduce.output.basename", name)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(base))


CSV_FOLDER = "source_year={year}"


@query
def csv_year_scan(spark, sf_dir):
    base = new_work_dir(spark, "csv")
    write_year_folders(spark, sf_dir, base)
    return files.read_years(spark, base, FIXTURE_YEARS, folder=CSV_FOLDER)


@query
def file_listing(spark, sf_dir):
    """What the listing knows of a year's files, beside the rows read from them."""
    base = new_work_dir(spark, "csv")
    write_year_folders(spark, sf_dir, base)
    listed = files.file_metadata(spark, base, FIXTURE_YEARS, CSV_FOLDER)
    near = files.is_nrt_file(F.col("file_name"))
    found = listed.groupBy("year").agg(F.bool_or(~near).alias("has_archive"), F.bool_or(near).alias("has_nrt"),
                                       (F.min("file_size") > 0).alias("all_sized"))
    rows = files.read_years(spark, base, FIXTURE_YEARS, folder=CSV_FOLDER).groupBy(F.col("source_year").alias("year"))
    totals = profiling.file_totals(listed, ["year"]).where("total_files > 0").select("year")
    return found.join(totals, "year").join(rows.agg(F.count(F.lit(1)).alias("row_count")), "year")


@query
def file_sample(spark, sf_dir):
    """The first rows of every file: one file per year and product here, so the limit counts once for each."""
    base = new_work_dir(spark, "csv")
    write_year_folders(spark, sf_dir, base, one_file=True)
    rows = files.read_years(spark, base, FIXTURE_YEARS, SAMPLE_ROWS, CSV_FOLDER)
    return rows.groupBy("source_year").agg(F.count(F.lit(1)).alias("row_count"))


@query
def history_rerun(spark, sf_dir):
    """All years, then one of them again with nothing but invalid rows: that year keeps nothing of the first run."""
    layout, rows = history.Layout.under(new_work_dir(spark, "history")), raw(spark, sf_dir)
    history.process(spark, rows, FIXTURE_YEARS, layout)
    again = rows.where(F.col("source_year").isin(FIXTURE_VALIDATION)).withColumn("latitude", F.lit(99.0))
    history.process(spark, again, FIXTURE_VALIDATION, layout)
    figures = history.report(*[spark.read.parquet(base) for base in (layout.checked, layout.curated)])
    kept = files.read_partitioned(spark, layout.features).groupBy("year").agg(F.count(F.lit(1)).alias("feature_rows"))
    return figures.join(kept, "year", "left").select(
        "year", "input_rows", "invalid_rows", "output_rows", "duplicate_rows", F.coalesce("feature_rows", F.lit(0)).alias("feature_rows"))


@query
def quality_document(spark, sf_dir):
    """The whole history job from CSV, as its stored report tells it."""
    base = new_work_dir(spark, "history")
    write_year_folders(spark, sf_dir, f"{base}/raw")
    stored = history.run(spark, f"{base}/raw", FIXTURE_YEARS, history.Layout.under(base), folder=CSV_FOLDER)
    return stored.select(
        "year", (F.size("input_files") > 0).alias("has_files"), (F.col("duration_seconds") > 0).alias("has_duration"), "input_rows",
        "invalid_rows", "duplicate_rows", "output_curated_rows", "spatial_bounds.*", "temporal_bounds.*", "quality_status")


@query
def profile_document(spark, sf_dir):
    """The profile job from CSV, as its stored report tells it."""
    base = new_work_dir(spark, "profile")
    write_year_folders(spark, sf_dir, f"{base}/raw")
    profiles.run(spark, f"{base}/raw", FIXTURE_YEARS, f"{base}/reports", folder=CSV_FOLDER)
    stored = spark.read.json(f"{base}/reports/yearly")
    return stored.select(
        F.col("year").cast("int").alias("year"), (F.col("total_files") > 0).alias("has_files"),
        (F.col("profiling_duration_sec") > 0).alias("has_duration"), "total_rows", "duplicate_rows", "valid_rows_estimate",
        "spatial_bounds.*", "temporal_bounds.*", "validation.negative_frp_count", F.array_join("distinct_values.versions", ",").alias("versions"))


@query
def history_report(spark, sf_dir):
    """The historical batch end to end, reported from its stored tables."""
    layout = history.Layout.under(new_work_dir(spark, "history"))
    return history.process(spark, raw(spark, sf_dir), FIXTURE_YEARS, layout).withColumnRenamed("year", "source_year")


@query
def history_features(spark, sf_dir):
    """The historical batch end to end, then the stored features of two years."""
    layout = history.Layout.under(new_work_dir(spark, "history"))
    history.process(spark, raw(spark, sf_dir), FIXTURE_YEARS, layout)
    return files.read_partitioned(spark, layout.features, FIXTURE_VALIDATION + FIXTURE_TEST).select(*FEATURE_COLUMNS)


@query
def raw_sample(spark, sf_dir):
    path = new_work_dir(spark, "raw-sample")
    write_raw_sample(raw(spark, sf_dir).drop("source_year"), path)
    return files.read_csv(spark, path, FIRE_EVENT).agg(F.count(F.lit(1)).alias("sample_rows"))


@query
def text_messages(spark, sf_dir):
    """Decoded message values as text lines, read back and parsed."""
    path = new_work_dir(spark, "text")
    write_text(fire_messages(table(spark, sf_dir, "lineitem")), path)
    return alerts.from_messages(files.read_text(spark, path), FIRE_EVENT)


@query
def word_count(spark, sf_dir):
    return count_words(table(spark, sf_dir, "documents"), "text")


@query
def word_count_csv(spark, sf_dir):
    """The sorted word counts as a headered CSV result, read back with inferred types."""
    path = new_work_dir(spark, "words")
    write_result_csv(count_words(table(spark, sf_dir, "documents"), "text"), path)
    return files.read_inferred_csv(spark, path).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("count").alias("total_count")
    )


@query
def sql_count(spark, sf_dir):
    return spark.sql("SELECT COUNT(*) AS total_rows FROM {data}", data=table(spark, sf_dir, "documents"))


@query
def preview(spark, sf_dir):
    return spark.sql("SELECT * FROM {data} ORDER BY doc_id LIMIT 10", data=table(spark, sf_dir, "documents"))
