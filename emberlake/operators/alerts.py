"""Risk and anomaly messages to one alert feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberlake.schemas import ALERT_COLUMNS

# Alerting risk levels with alert level and reason; feed names; message prefix.
RISK_ALERTS = {
    "High": ("HIGH", "High wildfire risk predicted by ML model"),
    "Medium": ("MEDIUM", "Medium wildfire risk predicted by ML model"),
}
RISK_SOURCE = "risk_prediction"
ANOMALY_SOURCE = "anomaly_detection"
MESSAGE_PREFIX = "WILDFIRE ALERT: "


def _per_level(position: int) -> Column:
    pairs = [F.lit(x) for level, texts in RISK_ALERTS.items() for x in (level, texts[position])]
    return F.create_map(*pairs)[F.col("risk_level")]


def _message() -> Column:
    return F.concat(F.lit(MESSAGE_PREFIX), F.col("alert_reason"))


def risk_alerts(predictions: DataFrame) -> DataFrame:
    alerting = predictions.where(F.col("risk_level").isin(list(RISK_ALERTS)))
    return alerting.withColumns({
        "anomaly_score": F.lit(None).cast("double"),
        "anomaly_alert_level": F.lit(None).cast("string"),
        "alert_level": _per_level(0),
        "alert_source": F.lit(RISK_SOURCE),
        "alert_reason": _per_level(1),
    }).withColumn("alert_message", _message()).select(*ALERT_COLUMNS)


def anomaly_alerts(anomalies: DataFrame) -> DataFrame:
    return anomalies.where("is_anomaly = 1").withColumns({
        "risk_level": F.lit(None).cast("string"),
        "anomaly_alert_level": F.col("alert_level"),
        "alert_source": F.lit(ANOMALY_SOURCE),
        "alert_message": _message(),
    }).select(*ALERT_COLUMNS)


def merge_alerts(predictions: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Works on two static frames and on two streams alike."""
    return risk_alerts(predictions).unionByName(anomaly_alerts(anomalies))


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON document per row in ``value``; NULL fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def from_messages(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Decode and flatten; a malformed document becomes a row of NULLs.

    Going through ``inline`` makes sure each document is parsed once: a filter
    on its fields would otherwise be moved below and parse again per field.
    """
    document = F.from_json(F.col(value).cast("string"), schema)
    return df.select(F.inline(F.array(document)))
