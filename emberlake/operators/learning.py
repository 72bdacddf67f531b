"""Tree models for risk level and fire intensity, on MLlib."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.schemas import RISK_COLUMNS

# Model inputs.
NUMERIC = [
    "latitude", "longitude", "brightness", "bright_t31", "scan", "track", "month", "day", "hour",
    "day_of_week", "day_of_year", "is_weekend", "is_night", "latitude_bucket", "longitude_bucket",
]
CATEGORICAL = ["confidence", "daynight", "season", "type"]
LABEL = "risk_level"
TARGET = "frp"

# Model names in reports.
FOREST = "random_forest"
RISK_BOOSTED = "gbt_one_vs_rest"
SIZE_BOOSTED = "gbt"


@dataclass(frozen=True)
class TreeSettings:
    """The default sizes. Smaller ones make quick checks."""

    forest_trees: int = 100
    forest_depth: int = 8
    boost_rounds: int = 50
    boost_depth: int = 5
    seed: int = 42
    parallel_models: int = 3

    def forest(self) -> dict:
        return {"numTrees": self.forest_trees, "maxDepth": self.forest_depth, "seed": self.seed}

    def boost(self) -> dict:
        return {"maxIter": self.boost_rounds, "maxDepth": self.boost_depth, "seed": self.seed}


def feature_stages(numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL,
                   output: str = "features") -> list:
    """Index and one-hot each category (unseen values get their own slot), then assemble."""
    indexed, encoded = [f"{c}_idx" for c in categorical], [f"{c}_ohe" for c in categorical]
    return [
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        VectorAssembler(inputCols=[*numeric, *encoded], outputCol=output, handleInvalid="skip"),
    ]


def fit_features(train: DataFrame) -> PipelineModel:
    return Pipeline(stages=feature_stages()).fit(train)


def label_indexer() -> StringIndexer:
    """Most frequent level first. Training rows are all labelled, so an unknown one is an error."""
    return StringIndexer(inputCol=LABEL, outputCol="label", handleInvalid="error")


def fit_risk_features(train: DataFrame) -> PipelineModel:
    """Label indexer first, feature stages after it, so that scoring can leave the label out."""
    return Pipeline(stages=[label_indexer(), *feature_stages()]).fit(train)


def scoring_features(model: PipelineModel) -> PipelineModel:
    """The same fitted stages without the label indexer."""
    return PipelineModel(model.stages[1:])


def risk_levels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def name_level(df: DataFrame, levels: list[str]) -> DataFrame:
    """Prediction index back to its level, in the fitted order."""
    known = F.get(F.array(*[F.lit(x) for x in levels]), F.col("prediction").cast("int"))
    return df.withColumn(LABEL, F.coalesce(known, F.lit("Unknown")))


def level_converter(model: PipelineModel) -> IndexToString:
    return IndexToString(inputCol="prediction", outputCol="predicted_level", labels=risk_levels(model))


def risk_forest(settings: TreeSettings = TreeSettings()) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", **settings.forest())


def risk_boosted(settings: TreeSettings = TreeSettings()) -> OneVsRest:
    """Boosted trees are binary, so one model per level, fitted side by side."""
    boosted = GBTClassifier(labelCol="label", featuresCol="features", **settings.boost())
    return OneVsRest(classifier=boosted, labelCol="label", featuresCol="features",
                     parallelism=settings.parallel_models)


def intensity_forest(settings: TreeSettings = TreeSettings()) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=TARGET, featuresCol="features", **settings.forest())


def intensity_boosted(settings: TreeSettings = TreeSettings()) -> GBTRegressor:
    return GBTRegressor(labelCol=TARGET, featuresCol="features", **settings.boost())


@dataclass
class Trained:
    """Fitted feature stages, the models by name, and what was learnt about rows and labels."""

    features: PipelineModel
    models: dict = field(default_factory=dict)
    thresholds: tuple[float, float] | None = None
    rows: dict[str, int] = field(default_factory=dict)
    classes: dict[str, dict[str, int]] = field(default_factory=dict)

    @property
    def levels(self) -> list[str]:
        return risk_levels(self.features)


def score_risk(df: DataFrame, trained: Trained, model: str = RISK_BOOSTED) -> DataFrame:
    """Filled feature rows to risk messages."""
    scored = trained.models[model].transform(scoring_features(trained.features).transform(df))
    return name_level(scored, trained.levels).select(*RISK_COLUMNS)


def score_fire_size(df: DataFrame, trained: Trained, model: str = SIZE_BOOSTED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feature rows to predicted intensity, in serving-table shape; ``keep``: further columns behind it."""
    scored = trained.models[model].transform(trained.features.transform(df))
    return scored.select("event_timestamp", "latitude", "longitude", F.col("prediction").alias("predicted_frp"), *keep)


def best_classifier(test_metrics: dict[str, dict]) -> str:
    return max(test_metrics, key=lambda m: test_metrics[m]["f1"])


def best_regressor(test_metrics: dict[str, dict]) -> str:
    return min(test_metrics, key=lambda m: test_metrics[m]["rmse"])
