"""Detection- and telemetry-shaped views of the provided test tables.

Column expressions only, so nothing is materialised before a query asks for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Time split on the seven shipping years: NRT rows occur only in the last one.
FIXTURE_TRAIN = [1995, 1996, 1997, 1998, 1999]
FIXTURE_VALIDATION = [2000]
FIXTURE_TEST = [2001]

_NRT = "(year(l_shipdate) = 2001 AND l_linestatus = 'O')"

FIRE_COLUMNS = {
    "latitude": "(l_suppkey*1291 % 1900)/1e1 - 9e1",
    "longitude": "((l_suppkey*2741 + l_linenumber*13) % 3690)/1e1 - 1.8e2",
    "brightness": "CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN -1e0"
                  " ELSE 2.08e2 + l_extendedprice/1e3 END",
    "scan": "l_discount*1e1",
    "track": "l_tax*1e1",
    "acq_date": "CASE WHEN l_partkey % 89 = 0 THEN 'bad-date' ELSE date_format(l_shipdate, 'yyyy-MM-dd') END",
    "acq_time": "CASE WHEN l_partkey % 83 = 0 THEN '2460'"
                " ELSE CAST((l_linenumber*5 % 24)*100 + l_suppkey % 60 AS STRING) END",
    "satellite": "'SNPP'",
    "instrument": "'VIIRS'",
    "confidence": "CASE WHEN l_partkey % 40 = 2 THEN ' ' WHEN l_returnflag = 'R' THEN ' l'"
                  " WHEN l_returnflag = 'A' THEN 'n ' ELSE 'h' END",
    "version": f"CASE WHEN {_NRT} THEN '2.0NRT' ELSE '2' END",
    "bright_t31": "2.2e2 + l_quantity",
    "frp": "CASE WHEN l_partkey % 50 = 1 THEN NULL ELSE l_quantity*l_extendedprice/1e5 END",
    "daynight": "CASE WHEN l_linestatus = 'O' THEN 'D' ELSE 'N' END",
    "type": f"CASE WHEN {_NRT} THEN NULL ELSE CAST(l_partkey % 4 AS INT) END",
}

#: Detections within the month that the telemetry covers, so that the two can meet.
_LINKED_TIME = "timestampadd(MINUTE, pmod(l_partkey*7919 + l_orderkey*13, 43200), TIMESTAMP '2024-01-01 00:00:00')"
LINKED_COLUMNS = {
    **FIRE_COLUMNS,
    "acq_date": f"date_format({_LINKED_TIME}, 'yyyy-MM-dd')",
    "acq_time": f"date_format({_LINKED_TIME}, 'HHmm')",
}

ENVIRONMENT_COLUMNS = {
    "timestamp": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "latitude": "(user_id*1291 % 1900)/1e1 - 9e1",
    "longitude": "(user_id*2741 % 3690)/1e1 - 1.8e2",
    "temperature": "value/1e1",
    "humidity": "CAST(event_id % 100 AS DOUBLE)",
    "wind_speed": "CAST(event_id % 60 AS DOUBLE)",
    "wind_direction": "CAST(event_id % 360 AS DOUBLE)",
    "rainfall": "CAST(event_id % 12 AS DOUBLE)",
    "smoke": "value",
    "air_quality_index": "CAST(get_json_object(props, '$.k') AS INT)",
    "source": "event_type",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(df: DataFrame, columns: dict[str, str], *extra: str) -> DataFrame:
    return df.selectExpr(*extra, *[f"{sql} AS {name}" for name, sql in columns.items()])


def fire_view(lineitem: DataFrame, with_year: bool = False) -> DataFrame:
    """Archive-shaped raw rows; ``source_year`` stands for the year folder of a raw file."""
    return _view(lineitem, FIRE_COLUMNS, *(["year(l_shipdate) AS source_year"] if with_year else []))


def linked_fire_view(lineitem: DataFrame) -> DataFrame:
    """Like :func:`fire_view`, in the month of the telemetry."""
    return _view(lineitem, LINKED_COLUMNS)


def environment_view(events: DataFrame) -> DataFrame:
    return _view(events, ENVIRONMENT_COLUMNS)


def fire(spark: SparkSession, sf_dir: str, with_year: bool = False) -> DataFrame:
    return fire_view(table(spark, sf_dir, "lineitem"), with_year)


def environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return environment_view(table(spark, sf_dir, "events"))
