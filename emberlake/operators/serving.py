"""Serving tables and the queries a monitoring board asks of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.temporal import season
from emberlake.operators.dedup import drop_duplicate_events
from emberlake.schemas import SERVING_EVENT_COLUMNS, SERVING_KEY

# List lengths and model versions.
ACTIVE_ALERTS = 500
RECENT_EVENTS = 10_000
RISK_MODEL_VERSION = "risk_classifier_v1"
SIZE_MODEL_VERSION = "fire_size_regressor_v1"

# Column types of the serving tables; strN is text of at most N characters.
_PLACE = {"event_timestamp": "timestamp", "latitude": "double", "longitude": "double"}
TABLES: dict[str, dict[str, str]] = {
    "fire_events": {
        **_PLACE, "brightness": "double", "bright_t31": "double", "scan": "double", "track": "double",
        "frp": "double", "confidence": "str10", "daynight": "str1", "satellite": "str20",
        "instrument": "str20", "version": "str20", "type": "smallint", "year": "smallint",
        "season": "str10", "is_night": "smallint",
    },
    "risk_predictions": {
        **_PLACE, "brightness": "double", "bright_t31": "double", "frp": "double", "confidence": "str10",
        "daynight": "str1", "prediction": "double", "risk_level": "str10", "model_version": "str50",
    },
    "fire_size_predictions": {**_PLACE, "predicted_frp": "double", "model_version": "str50"},
    "anomalies": {
        **_PLACE, "frp": "double", "brightness": "double", "bright_t31": "double", "scan": "double",
        "track": "double", "confidence": "str10", "daynight": "str1", "anomaly_score": "double",
        "is_anomaly": "smallint", "alert_level": "str10", "alert_reason": "string",
    },
    "alerts": {
        **_PLACE, "frp": "double", "anomaly_score": "double", "risk_level": "str10",
        "anomaly_alert_level": "str10", "alert_level": "str10", "alert_source": "str30",
        "alert_reason": "string", "alert_message": "string",
    },
}
IDS = {
    "fire_events": "event_id", "risk_predictions": "prediction_id",
    "fire_size_predictions": "prediction_id", "anomalies": "anomaly_id", "alerts": "alert_id",
}
_VERSIONS = {"risk_predictions": RISK_MODEL_VERSION, "fire_size_predictions": SIZE_MODEL_VERSION}
SMALLINT = 32767


def _typed(table: str, df: DataFrame) -> DataFrame:
    defaults = {"model_version": F.lit(_VERSIONS.get(table))}
    return df.select(*[
        (F.col(c) if c in df.columns else defaults[c]).try_cast(_storage(kind)).alias(c)
        for c, kind in TABLES[table].items()
    ])


def _storage(kind: str) -> str:
    """Integers stay wide until :func:`_fits` has looked at them."""
    if kind.startswith("str"):
        return "string"
    return "bigint" if kind == "smallint" else kind


def _fits(table: str) -> Column:
    """Key columns present, text within length, integers within range."""
    terms = [F.col(c).isNotNull() for c in SERVING_KEY]
    for c, kind in TABLES[table].items():
        if kind == "smallint":
            terms.append(F.coalesce(F.abs(c) <= SMALLINT, F.lit(True)))
        elif kind.startswith("str") and kind != "string":
            terms.append(F.coalesce(F.length(c) <= int(kind[3:]), F.lit(True)))
    return reduce(Column.__and__, terms)


def conforming_rows(df: DataFrame, table: str, created_at: Column | None = None) -> DataFrame:
    """Rows the serving table accepts, typed, with a content-derived id and load time."""
    typed = _typed(table, df).where(_fits(table))
    small = {c: F.col(c).cast("smallint") for c, kind in TABLES[table].items() if kind == "smallint"}
    columns = list(TABLES[table])
    identified = typed.withColumns(small) if small else typed
    return identified.select(
        F.xxhash64(*columns).alias(IDS[table]), *columns,
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )


def store_rows(df: DataFrame, table: str) -> DataFrame:
    """Conforming rows without id and load time, which a relational store fills in itself."""
    return conforming_rows(df, table).drop(IDS[table], "created_at")


def rejected_rows(df: DataFrame, table: str) -> DataFrame:
    """The other side of :func:`conforming_rows`, so nothing is lost without a trace."""
    return _typed(table, df).where(~_fits(table))


def event_rows(curated: DataFrame) -> DataFrame:
    """Curated detections to one serving row per time and place."""
    derived = {
        "season": season(F.month("event_timestamp")),
        "is_night": F.coalesce(F.col("daynight") == "N", F.lit(False)).cast("int"),
    }
    if "year" not in curated.columns:
        derived["year"] = F.year("event_timestamp")
    return drop_duplicate_events(curated.withColumns(derived).select(*SERVING_EVENT_COLUMNS))


def _event_date() -> Column:
    return F.to_date("event_timestamp").alias("event_date")


def _numeric(column: Column, digits: int) -> Column:
    return F.round(column.cast("decimal(38,12)"), digits).cast(f"decimal(18,{digits})")


def daily_fire_kpis(events: DataFrame) -> DataFrame:
    daily = events.groupBy(_event_date()).agg(
        F.count(F.lit(1)).alias("fire_count"),
        _numeric(F.avg("frp"), 2).alias("avg_frp"),
        _numeric(F.max("frp"), 2).alias("max_frp"),
        F.count_if(F.col("daynight") == "N").alias("night_fires"),
    )
    return daily.orderBy("event_date")


def daily_fire_parts() -> tuple[dict[str, Column], dict[str, Column], dict[str, str]]:
    """Keys, parts and how parts merge, for :func:`daily_fire_kpis` carried on batch by batch."""
    parts = {"fire_count": F.count(F.lit(1)), "frp_count": F.count("frp"), "frp_sum": F.sum("frp"), "max_frp": F.max("frp"),
             "night_fires": F.count_if(F.col("daynight") == "N")}
    return {"event_date": _event_date()}, parts, {p: "max" if p == "max_frp" else "sum" for p in parts}


def daily_fire_figures(parts: DataFrame) -> DataFrame:
    """The columns of :func:`daily_fire_kpis` from merged parts."""
    return parts.select(
        "event_date", "fire_count", _numeric(F.try_divide("frp_sum", "frp_count"), 2).alias("avg_frp"),
        _numeric(F.col("max_frp"), 2).alias("max_frp"), "night_fires",
    ).orderBy("event_date")


def anomaly_parts() -> tuple[dict[str, Column], dict[str, Column], dict[str, str]]:
    """The same for :func:`anomaly_summary`."""
    parts = {"anomaly_count": F.count_if(F.col("is_anomaly") == 1), "score_count": F.count("anomaly_score"), "score_sum": F.sum("anomaly_score")}
    return {"event_date": _event_date()}, parts, {p: "sum" for p in parts}


def anomaly_figures(parts: DataFrame) -> DataFrame:
    score = _numeric(F.try_divide("score_sum", "score_count"), 3)
    return parts.select("event_date", "anomaly_count", score.alias("avg_anomaly_score")).orderBy(F.col("event_date").desc())


def fire_kpis(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("total_fires"),
        F.coalesce(F.sum("frp"), F.lit(0.0)).alias("total_frp"),
        F.coalesce(F.avg("frp"), F.lit(0.0)).alias("avg_frp"),
        F.count_if(F.col("is_night") == 1).alias("night_fires"),
    )


def risk_distribution(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    daily = anomalies.groupBy(_event_date()).agg(
        F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
        _numeric(F.avg("anomaly_score"), 3).alias("avg_anomaly_score"),
    )
    return daily.orderBy(F.col("event_date").desc())


# Columns the board shows.
ALERT_BOARD = [
    "alert_id", "event_timestamp", "latitude", "longitude", "frp", "anomaly_score", "risk_level",
    "alert_level", "alert_source", "alert_reason", "alert_message", "created_at",
]


def active_alerts(alerts: DataFrame, limit: int = ACTIVE_ALERTS) -> DataFrame:
    """Newest alerts; the remaining columns settle ties."""
    ties = ["event_timestamp", "latitude", "longitude", "alert_source", "alert_reason", "frp"]
    return alerts.select(*ALERT_BOARD).orderBy(F.col("created_at").desc(), *ties).limit(limit)


def recent_events(events: DataFrame, limit: int = RECENT_EVENTS) -> DataFrame:
    newest = [F.col("event_timestamp").desc(), "latitude", "longitude"]
    return events.select(*SERVING_EVENT_COLUMNS).orderBy(*newest).limit(limit)


def event_date_bounds(events: DataFrame) -> DataFrame:
    date = F.to_date("event_timestamp")
    return events.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def on_date(events: DataFrame, date=None) -> DataFrame:
    """Events of one day; the newest day, found inside the same plan, if none is named."""
    day = event_date_bounds(events).select("max_date").scalar() if date is None else F.lit(date)
    return events.where(F.to_date("event_timestamp") == day)


# Columns of the map and of the event table.
MAP_COLUMNS = ["latitude", "longitude", "frp", "brightness", "confidence", "event_timestamp"]
TABLE_COLUMNS = [
    "event_timestamp", "latitude", "longitude", "frp", "brightness", "confidence", "daynight", "satellite",
]


def map_points(events: DataFrame) -> DataFrame:
    return events.select(*MAP_COLUMNS).dropna(subset=["latitude", "longitude"])


def recent_table(events: DataFrame) -> DataFrame:
    return events.select(*TABLE_COLUMNS)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Expose serving tables and the views over them to ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    views = {
        "v_daily_fire_kpis": ("fire_events", lambda t: daily_fire_kpis(t).orderBy(F.col("event_date").desc())),
        "v_risk_distribution": ("risk_predictions", risk_distribution),
        "v_anomaly_summary": ("anomalies", anomaly_summary),
        "v_active_alerts": ("alerts", active_alerts),
    }
    for name, (table, view) in views.items():
        if table in tables:
            view(spark.table(table)).createOrReplaceTempView(name)
