"""Column contracts. Every production read uses one of these; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType,
)

_TYPES = {"DOUBLE": DoubleType(), "INT": IntegerType(), "STRING": StringType(), "TIMESTAMP": TimestampType()}


def _schema(columns: str) -> StructType:
    """``name TYPE, ...`` without needing a running session."""
    return StructType([StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(","))])


# Column names, order and types of files, messages and tables.
MEASUREMENTS = ["latitude", "longitude", "brightness", "scan", "track", "bright_t31", "frp"]
LABELS = ["satellite", "instrument", "confidence", "daynight", "version", "acq_date"]
NATURAL_KEY = ["latitude", "longitude", "acq_date", "acq_time"]
SERVING_KEY = ["event_timestamp", "latitude", "longitude"]

RAW_NRT = _schema(
    "latitude DOUBLE, longitude DOUBLE, brightness DOUBLE, scan DOUBLE, track DOUBLE,"
    " acq_date STRING, acq_time STRING, satellite STRING, instrument STRING,"
    " confidence STRING, version STRING, bright_t31 DOUBLE, frp DOUBLE, daynight STRING"
)
RAW_ARCHIVE = StructType(RAW_NRT.fields + _schema("type INT").fields)
FIRE_EVENT = RAW_ARCHIVE
CANONICAL = StructType(RAW_ARCHIVE.fields + _schema("event_timestamp TIMESTAMP").fields)
FEATURES = StructType(
    CANONICAL.fields
    + _schema(
        "year INT, month INT, day INT, hour INT, day_of_week INT, day_of_year INT,"
        " is_weekend INT, season STRING, is_night INT, latitude_bucket DOUBLE, longitude_bucket DOUBLE"
    ).fields
)

ENVIRONMENT = _schema(
    "timestamp STRING, latitude DOUBLE, longitude DOUBLE, temperature DOUBLE, humidity DOUBLE,"
    " wind_speed DOUBLE, wind_direction DOUBLE, rainfall DOUBLE, smoke DOUBLE,"
    " air_quality_index INT, source STRING"
)
RISK_MESSAGE = _schema(
    "event_timestamp STRING, latitude DOUBLE, longitude DOUBLE, brightness DOUBLE,"
    " bright_t31 DOUBLE, frp DOUBLE, confidence STRING, daynight STRING,"
    " prediction DOUBLE, risk_level STRING"
)
ANOMALY_MESSAGE = _schema(
    "event_timestamp STRING, latitude DOUBLE, longitude DOUBLE, frp DOUBLE, brightness DOUBLE,"
    " bright_t31 DOUBLE, scan DOUBLE, track DOUBLE, confidence STRING, daynight STRING,"
    " anomaly_score DOUBLE, is_anomaly INT, alert_level STRING, alert_reason STRING"
)
ALERT_MESSAGE = _schema(
    "event_timestamp STRING, latitude DOUBLE, longitude DOUBLE, frp DOUBLE, anomaly_score DOUBLE,"
    " risk_level STRING, anomaly_alert_level STRING, alert_level STRING, alert_source STRING,"
    " alert_reason STRING, alert_message STRING"
)
ACTION_EVENT = _schema("user_id INT, action STRING, ts STRING")

_STATISTICS = MapType(StringType(), _schema("mean DOUBLE, std DOUBLE"))
ANOMALY_MODEL = StructType([
    StructField("model_type", StringType()),
    StructField("features", ArrayType(StringType())),
    StructField("threshold", DoubleType()),
    StructField("statistics", _STATISTICS),
    StructField("training_years", ArrayType(IntegerType())),
    StructField("training_rows", LongType()),
    StructField("generated_at", StringType()),
    StructField("duration_seconds", DoubleType()),
])

CANONICAL_COLUMNS = CANONICAL.names
FEATURE_COLUMNS = FEATURES.names
RISK_COLUMNS = RISK_MESSAGE.names
ANOMALY_COLUMNS = ANOMALY_MESSAGE.names
ALERT_COLUMNS = ALERT_MESSAGE.names
SERVING_EVENT_COLUMNS = [
    "event_timestamp", "latitude", "longitude", "brightness", "bright_t31", "scan", "track", "frp",
    "confidence", "daynight", "satellite", "instrument", "version", "type", "year", "season", "is_night",
]
