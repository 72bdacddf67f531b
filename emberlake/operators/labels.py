"""Time splits and the intensity-quantile risk label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.functions.quantiles import approximate_quantiles, exact_quantiles

# Label cut points, year splits.
LOW_QUANTILE, HIGH_QUANTILE = 0.33, 0.66
TRAIN_YEARS = [2020, 2021, 2022, 2023, 2024]
VALIDATION_YEARS = [2025]
TEST_YEARS = [2026]
SMALLEST_GAP = 1e-6


def in_years(df: DataFrame, years: list[int], column: str = "year") -> DataFrame:
    return df.where(F.col(column).isin(years))


def with_target(df: DataFrame) -> DataFrame:
    return df.where(F.col("frp").isNotNull())


def time_split(df: DataFrame, train: list[int], validation: list[int], test: list[int],
               column: str = "year") -> dict[str, DataFrame]:
    """Past years train, later years judge."""
    return {name: in_years(df, years, column)
            for name, years in (("train", train), ("validation", validation), ("test", test))}


def risk_thresholds(train: DataFrame, low: float = LOW_QUANTILE, high: float = HIGH_QUANTILE,
                    relative_error: float = 0.001) -> tuple[float, float]:
    """Label cut points from the training rows only; ``relative_error=0`` asks for exact ones."""
    wanted = [low, high]
    found = (approximate_quantiles(train, "frp", wanted, relative_error) if relative_error
             else exact_quantiles(train, "frp", wanted))
    if found is None:
        raise ValueError("no frp values to take quantiles of")
    q_low, q_high = found
    return q_low, q_high if q_high > q_low else q_low + SMALLEST_GAP


def risk_label(df: DataFrame, q_low: float, q_high: float, column: str = "frp",
               label: str = "risk_level") -> DataFrame:
    """Fixed cut points, inclusive above; a missing value stays unlabelled."""
    value = F.col(column)
    level = F.when(value > q_high, "High").when(value > q_low, "Medium").when(value.isNotNull(), "Low")
    return df.withColumn(label, level)


def label_distribution(df: DataFrame, label: str = "risk_level", by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("count")).orderBy(*by, label)
