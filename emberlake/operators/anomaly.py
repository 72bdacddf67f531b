"""Z-score anomaly model: fit, score, grade."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.schemas import ANOMALY_COLUMNS

# Model inputs, decision threshold, grades and message text.
FEATURES = ["frp", "brightness", "bright_t31", "scan", "track"]
THRESHOLD = 3.0
GRADES = [(5, "CRITICAL"), (4, "HIGH")]
LOWEST_GRADE = "MEDIUM"
REASON = "Unusual wildfire observation detected. Anomaly score = "
MODEL_TYPE = "statistical_z_score"


@dataclass(frozen=True)
class ZScoreModel:
    """Ten numbers and a threshold; small enough to be literals in batch and stream plans."""

    statistics: dict[str, tuple[float, float]]
    threshold: float = THRESHOLD
    training_rows: int | None = None
    training_years: tuple[int, ...] = ()

    @property
    def features(self) -> list[str]:
        return list(self.statistics)


def fit_statistics(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """One row: count, and per feature a mean (0 if none) and sample deviation (1 if none or 0)."""
    def spread(c: str) -> Column:
        return F.coalesce(F.nullif(F.stddev_samp(c), F.lit(0.0)), F.lit(1.0))

    return df.agg(
        F.count(F.lit(1)).alias("training_rows"),
        *[F.struct(F.coalesce(F.avg(c), F.lit(0.0)).alias("mean"), spread(c).alias("std")).alias(c) for c in features],
    )


def fit(df: DataFrame, features: list[str] = FEATURES, threshold: float = THRESHOLD,
        years: tuple[int, ...] = (), digits: int | None = None) -> ZScoreModel:
    """Fit in one aggregate. ``digits`` rounds the statistics so that models compare exactly."""
    row = fit_statistics(df, features).first()
    if row["training_rows"] == 0:
        raise ValueError("no rows to fit the anomaly model on")
    keep = (lambda x: x) if digits is None else (lambda x: round(x, digits))
    stats = {c: (keep(row[c]["mean"]), keep(row[c]["std"])) for c in features}
    return ZScoreModel(stats, threshold, row["training_rows"], tuple(years))


def z_score(column: str, mean: float, std: float) -> Column:
    return F.abs((F.col(column) - F.lit(mean)) / F.lit(std or 1.0))


def score(df: DataFrame, model: ZScoreModel) -> DataFrame:
    """Add ``<feature>_z``, their maximum as ``anomaly_score`` (NULLs skipped), and the verdict."""
    z = {f"{c}_z": z_score(c, mean, std) for c, (mean, std) in model.statistics.items()}
    scored = df.withColumns(z).withColumn("anomaly_score", F.greatest(*z))
    above = F.coalesce(F.col("anomaly_score") >= model.threshold, F.lit(False))
    return scored.withColumn("is_anomaly", above.cast("int"))


def distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("count"))


def grade(score_column: Column) -> Column:
    levels = F.lit(LOWEST_GRADE)
    for least, name in reversed(GRADES):
        levels = F.when(score_column >= least, name).otherwise(levels)
    return levels


def alerts(scored: DataFrame) -> DataFrame:
    """Anomalous rows only, graded and explained, in message column order."""
    found = F.col("anomaly_score")
    return scored.where("is_anomaly = 1").withColumns({
        "alert_level": grade(found),
        "alert_reason": F.concat(F.lit(REASON), F.round(found, 2).cast("string")),
    }).select(*ANOMALY_COLUMNS)
