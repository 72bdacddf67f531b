"""Independent SQL for the queries in the registry, over the same tables."""

from __future__ import annotations

# Model names.
FOREST, RISK_BOOSTED, SIZE_BOOSTED = "random_forest", "gbt_one_vs_rest", "gbt"
CATEGORICAL = ("confidence", "daynight", "season", "type")
NUMERIC = ("latitude", "longitude", "brightness", "bright_t31", "scan", "track", "month", "day", "hour", "day_of_week",
           "day_of_year", "is_weekend", "is_night", "latitude_bucket", "longitude_bucket")

# Stages as common table expressions, each naming the ones it builds on.
STAGES: dict[str, tuple[tuple[str, ...], str]] = {
    "fire": ((), """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS source_year,
               (l_suppkey*1291 % 1900)/1e1 - 9e1 AS latitude,
               ((l_suppkey*2741 + l_linenumber*13) % 3690)/1e1 - 1.8e2 AS longitude,
               CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN -1e0
                    ELSE 2.08e2 + l_extendedprice/1e3 END AS brightness,
               l_discount*1e1 AS scan, l_tax*1e1 AS track,
               CASE WHEN l_partkey % 89 = 0 THEN 'bad-date' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS acq_date,
               CASE WHEN l_partkey % 83 = 0 THEN '2460'
                    ELSE CAST((l_linenumber*5 % 24)*100 + l_suppkey % 60 AS VARCHAR) END AS acq_time,
               'SNPP' AS satellite, 'VIIRS' AS instrument,
               CASE WHEN l_partkey % 40 = 2 THEN ' ' WHEN l_returnflag = 'R' THEN ' l'
                    WHEN l_returnflag = 'A' THEN 'n ' ELSE 'h' END AS confidence,
               CASE WHEN year(l_shipdate) = 2001 AND l_linestatus = 'O' THEN '2.0NRT' ELSE '2' END AS version,
               2.2e2 + l_quantity AS bright_t31,
               CASE WHEN l_partkey % 50 = 1 THEN NULL ELSE l_quantity*l_extendedprice/1e5 END AS frp,
               CASE WHEN l_linestatus = 'O' THEN 'D' ELSE 'N' END AS daynight,
               CASE WHEN year(l_shipdate) = 2001 AND l_linestatus = 'O' THEN NULL
                    ELSE CAST(l_partkey % 4 AS INTEGER) END AS type
        FROM lineitem"""),
    "env": ((), """
        SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
               (user_id*1291 % 1900)/1e1 - 9e1 AS latitude, (user_id*2741 % 3690)/1e1 - 1.8e2 AS longitude,
               value/1e1 AS temperature, CAST(event_id % 100 AS DOUBLE) AS humidity,
               CAST(event_id % 60 AS DOUBLE) AS wind_speed, CAST(event_id % 360 AS DOUBLE) AS wind_direction,
               CAST(event_id % 12 AS DOUBLE) AS rainfall, value AS smoke,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS air_quality_index, event_type AS source
        FROM events"""),
    "timed": (("fire",), """
        SELECT * REPLACE (
                 NULLIF(trim(acq_date), '') AS acq_date,
                 substr(lpad(trim(acq_time), 4, '0'), 1, 2) || ':' || substr(lpad(trim(acq_time), 4, '0'), 3, 2)
                   AS acq_time,
                 NULLIF(trim(confidence), '') AS confidence,
                 CASE WHEN contains(version, 'NRT') THEN NULL ELSE type END AS type)
        FROM fire"""),
    "cleaned": (("timed",), """
        SELECT *, try_strptime(acq_date || ' ' || acq_time, '%Y-%m-%d %H:%M') AS event_timestamp FROM timed"""),
    "flagged": (("cleaned",), r"""
        SELECT *,
               COALESCE(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, FALSE) AS coordinates_ok,
               event_timestamp IS NOT NULL AND COALESCE(regexp_matches(acq_date, '^\d{4}-\d{2}-\d{2}$'), FALSE)
                 AND try_strptime(acq_date, '%Y-%m-%d') IS NOT NULL AS time_ok,
               (brightness IS NULL OR brightness > 0) AND (bright_t31 IS NULL OR bright_t31 > 0)
                 AND (frp IS NULL OR frp >= 0) AND (scan IS NULL OR scan >= 0)
                 AND (track IS NULL OR track >= 0) AS measurements_ok
        FROM cleaned"""),
    "valid": (("flagged",), """
        SELECT * EXCLUDE (coordinates_ok, time_ok, measurements_ok) FROM flagged
        WHERE coordinates_ok AND time_ok AND measurements_ok"""),
    "curated": (("valid",), """
        SELECT * EXCLUDE (r) FROM (
          SELECT *, ROW_NUMBER() OVER (
            PARTITION BY latitude, longitude, acq_date, acq_time
            ORDER BY brightness NULLS FIRST, scan NULLS FIRST, track NULLS FIRST, satellite NULLS FIRST,
                     instrument NULLS FIRST, confidence NULLS FIRST, version NULLS FIRST, bright_t31 NULLS FIRST,
                     frp NULLS FIRST, daynight NULLS FIRST, type NULLS FIRST, event_timestamp NULLS FIRST) AS r
          FROM valid) WHERE r = 1"""),
    "feats": (("curated",), """
        SELECT * EXCLUDE (source_year),
               CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month,
               CAST(day(event_timestamp) AS INTEGER) AS day, CAST(hour(event_timestamp) AS INTEGER) AS hour,
               CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS day_of_week,
               CAST(dayofyear(event_timestamp) AS INTEGER) AS day_of_year,
               CASE WHEN dayofweek(event_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN month(event_timestamp) IN (12, 1, 2) THEN 'Winter'
                    WHEN month(event_timestamp) IN (3, 4, 5) THEN 'Spring'
                    WHEN month(event_timestamp) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
               CASE WHEN daynight = 'N' THEN 1 ELSE 0 END AS is_night,
               round(latitude, 1) AS latitude_bucket, round(longitude, 1) AS longitude_bucket
        FROM curated"""),
    "stats": (("feats",), " UNION ALL ".join(f"""
        SELECT '{c}' AS feature, COUNT(*) AS training_rows, round(COALESCE(AVG({c}), 0), 9) AS mean,
               round(COALESCE(NULLIF(stddev_samp({c}), 0), 1), 9) AS std
        FROM feats WHERE year BETWEEN 1995 AND 2000""" for c in ("frp", "brightness", "bright_t31", "scan", "track"))),
    "model": (("stats",), "SELECT " + ", ".join(
        f"MAX(CASE WHEN feature = '{c}' THEN {s} END) AS {c}_{s}"
        for c in ("frp", "brightness", "bright_t31", "scan", "track") for s in ("mean", "std")) + " FROM stats"),
    "scored": (("feats", "model"), """
        SELECT *, CASE WHEN anomaly_score >= 3 THEN 1 ELSE 0 END AS is_anomaly FROM (
          SELECT *, greatest(frp_z, brightness_z, bright_t31_z, scan_z, track_z) AS anomaly_score FROM (
            SELECT feats.*, """ + ", ".join(
        f"abs(({c} - {c}_mean) / {c}_std) AS {c}_z" for c in ("frp", "brightness", "bright_t31", "scan", "track")) + """
            FROM feats, model))"""),
    "found": (("scored",), """
        SELECT event_timestamp, latitude, longitude, frp, brightness, bright_t31, scan, track, confidence, daynight,
               anomaly_score, is_anomaly,
               CASE WHEN anomaly_score >= 5 THEN 'CRITICAL' WHEN anomaly_score >= 4 THEN 'HIGH'
                    ELSE 'MEDIUM' END AS alert_level,
               'Unusual wildfire observation detected. Anomaly score = '
                 || CAST(round(anomaly_score, 2) AS VARCHAR) AS alert_reason
        FROM scored WHERE is_anomaly = 1"""),
    "cuts": (("feats",), """
        SELECT quantile_disc(frp, 0.33) AS low, quantile_disc(frp, 0.66) AS high
        FROM feats WHERE frp IS NOT NULL AND year BETWEEN 1995 AND 1999"""),
    "labelled": (("feats", "cuts"), """
        SELECT feats.*, CASE WHEN frp <= low THEN 'Low' WHEN frp <= high THEN 'Medium' ELSE 'High' END AS risk_level,
               CASE WHEN year <= 1999 THEN 'train' WHEN year = 2000 THEN 'validation' ELSE 'test' END AS split
        FROM feats, cuts WHERE frp IS NOT NULL"""),
    "judged": (("labelled",), """
        SELECT split, risk_level AS label, CASE WHEN bright_t31 > 254 THEN 'High' WHEN bright_t31 > 237 THEN 'Medium'
               ELSE 'Low' END AS prediction FROM labelled"""),
    "predictions": (("curated",), """
        SELECT event_timestamp, latitude, longitude, brightness, bright_t31, frp, confidence, daynight,
               CASE WHEN bright_t31 > 254 THEN 0e0 WHEN bright_t31 > 237 THEN 2e0 ELSE 1e0 END AS prediction,
               CASE WHEN bright_t31 > 254 THEN 'High' WHEN bright_t31 > 237 THEN 'Medium' ELSE 'Low' END AS risk_level
        FROM curated"""),
    "risky": (("predictions",), """
        SELECT event_timestamp, latitude, longitude, frp, CAST(NULL AS DOUBLE) AS anomaly_score, risk_level,
               CAST(NULL AS VARCHAR) AS anomaly_alert_level, upper(risk_level) AS alert_level,
               'risk_prediction' AS alert_source,
               risk_level || ' wildfire risk predicted by ML model' AS alert_reason,
               'WILDFIRE ALERT: ' || risk_level || ' wildfire risk predicted by ML model' AS alert_message
        FROM predictions WHERE risk_level IN ('High', 'Medium')"""),
    "merged": (("risky", "found"), """
        SELECT * FROM risky UNION ALL
        SELECT event_timestamp, latitude, longitude, frp, anomaly_score, NULL, alert_level, alert_level,
               'anomaly_detection', alert_reason, 'WILDFIRE ALERT: ' || alert_reason FROM found"""),
    "learning": (("labelled",), """
        SELECT * REPLACE (
            COALESCE(CAST(type AS VARCHAR), 'unknown') AS type, COALESCE(confidence, 'unknown') AS confidence,
            COALESCE(brightness, 0) AS brightness, COALESCE(bright_t31, 0) AS bright_t31,
            COALESCE(scan, 0) AS scan, COALESCE(track, 0) AS track) FROM labelled"""),
    "categories": (("learning",), " UNION ALL ".join(f"""
        SELECT '{c}' AS column_name, {c} AS value,
               CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS INTEGER) AS index
        FROM learning WHERE split = 'train' GROUP BY {c}""" for c in CATEGORICAL)),
    "sizes": (("categories",), "SELECT " + ", ".join(
        f"COUNT(*) FILTER (WHERE column_name = '{c}') + 1 AS {c}_size" for c in CATEGORICAL) + " FROM categories"),
    "events_served": (("feats",), """
        SELECT event_timestamp, latitude, longitude, brightness, bright_t31, scan, track, frp, confidence, daynight,
               satellite, instrument, version, type, year, season, is_night
        FROM (SELECT *, ROW_NUMBER() OVER (
                PARTITION BY event_timestamp, latitude, longitude
                ORDER BY brightness NULLS FIRST, bright_t31 NULLS FIRST, scan NULLS FIRST, track NULLS FIRST,
                         frp NULLS FIRST, confidence NULLS FIRST, daynight NULLS FIRST, satellite NULLS FIRST,
                         instrument NULLS FIRST, version NULLS FIRST, type NULLS FIRST) AS r FROM feats)
        WHERE r = 1"""),
    "live_scored": (("cleaned", "model"), """
        SELECT *, CASE WHEN anomaly_score >= 3 THEN 1 ELSE 0 END AS is_anomaly FROM (
          SELECT *, greatest(frp_z, brightness_z, bright_t31_z, scan_z, track_z) AS anomaly_score FROM (
            SELECT cleaned.*, """ + ", ".join(
        f"abs(({c} - {c}_mean) / {c}_std) AS {c}_z" for c in ("frp", "brightness", "bright_t31", "scan", "track")) + """
            FROM cleaned, model))"""),
    "live_found": (("live_scored",), """
        SELECT strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.000Z') AS event_timestamp,
               latitude, longitude, frp, brightness, bright_t31, scan, track, confidence, daynight,
               anomaly_score, is_anomaly,
               CASE WHEN anomaly_score >= 5 THEN 'CRITICAL' WHEN anomaly_score >= 4 THEN 'HIGH'
                    ELSE 'MEDIUM' END AS alert_level,
               'Unusual wildfire observation detected. Anomaly score = '
                 || CAST(round(anomaly_score, 2) AS VARCHAR) AS alert_reason
        FROM live_scored WHERE is_anomaly = 1"""),
    "live_risky": (("cleaned",), """
        SELECT strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.000Z') AS event_timestamp, latitude, longitude, frp,
               CASE WHEN bright_t31 > 254 THEN 'High' ELSE 'Medium' END AS risk_level
        FROM cleaned WHERE bright_t31 > 237"""),
    "ingested": (("cleaned",), """
        SELECT * EXCLUDE (source_year), CAST(year(event_timestamp) AS INTEGER) AS year,
               CAST(month(event_timestamp) AS INTEGER) AS month, CAST(day(event_timestamp) AS INTEGER) AS day,
               CAST(hour(event_timestamp) AS INTEGER) AS hour,
               CASE WHEN daynight = 'N' THEN 1 ELSE 0 END AS is_night,
               round(latitude, 1) AS latitude_bucket, round(longitude, 1) AS longitude_bucket
        FROM cleaned WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"""),
    "env_rows": (("env",), """
        SELECT *, CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month,
               CAST(day(event_timestamp) AS INTEGER) AS day
        FROM (SELECT *, try_strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp FROM env
              WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)"""),
    "quality": (("flagged", "curated"), """
        SELECT source_year, input_rows, invalid_rows, COALESCE(output_rows, 0) AS output_rows,
               input_rows - invalid_rows - COALESCE(output_rows, 0) AS duplicate_rows,
               min_latitude, max_latitude, min_longitude, max_longitude, min_acq_date, max_acq_date,
               min_brightness, max_brightness, min_frp, max_frp, avg_brightness, avg_frp,
               CASE WHEN invalid_rows = 0 THEN 'PASSED' ELSE 'PASSED_WITH_WARNINGS' END AS quality_status
        FROM (SELECT source_year, COUNT(*) AS input_rows,
                     COUNT(*) FILTER (WHERE NOT (coordinates_ok AND time_ok AND measurements_ok)) AS invalid_rows
              FROM flagged GROUP BY 1)
        LEFT JOIN (SELECT source_year, COUNT(*) AS output_rows,
                     min(latitude) AS min_latitude, max(latitude) AS max_latitude,
                     min(longitude) AS min_longitude, max(longitude) AS max_longitude,
                     min(acq_date) AS min_acq_date, max(acq_date) AS max_acq_date,
                     min(brightness) AS min_brightness, max(brightness) AS max_brightness,
                     min(frp) AS min_frp, max(frp) AS max_frp,
                     round(NULLIF(avg(brightness), 0), 2) AS avg_brightness, round(NULLIF(avg(frp), 0), 2) AS avg_frp
              FROM curated GROUP BY 1) USING (source_year)"""),
    "linked": ((), """
        SELECT (l_suppkey*1291 % 1900)/1e1 - 9e1 AS latitude,
               ((l_suppkey*2741 + l_linenumber*13) % 3690)/1e1 - 1.8e2 AS longitude,
               CASE WHEN l_partkey % 50 = 1 THEN NULL ELSE l_quantity*l_extendedprice/1e5 END AS frp,
               TIMESTAMP '2024-01-01' + to_minutes(CAST((l_partkey*7919 + l_orderkey*13) % 43200 AS BIGINT)) AS event_timestamp
        FROM lineitem"""),
    "linked_full": ((), """
        SELECT (l_suppkey*1291 % 1900)/1e1 - 9e1 AS latitude,
               ((l_suppkey*2741 + l_linenumber*13) % 3690)/1e1 - 1.8e2 AS longitude,
               CASE WHEN l_partkey % 50 = 1 THEN NULL ELSE l_quantity*l_extendedprice/1e5 END AS frp,
               TIMESTAMP '2024-01-01' + to_minutes(CAST((l_partkey*7919 + l_orderkey*13) % 43200 AS BIGINT)) AS event_timestamp,
               2.2e2 + l_quantity AS bright_t31, CASE WHEN l_linestatus = 'O' THEN 'D' ELSE 'N' END AS daynight
        FROM lineitem WHERE (l_suppkey*1291 % 1900)/1e1 - 9e1 BETWEEN -90 AND 90
          AND ((l_suppkey*2741 + l_linenumber*13) % 3690)/1e1 - 1.8e2 BETWEEN -180 AND 180"""),
    "readings": (("env_rows",), """
        SELECT event_timestamp AS reading_time, latitude AS reading_latitude, longitude AS reading_longitude,
               temperature, humidity, wind_speed, wind_direction, rainfall, smoke, air_quality_index, source FROM env_rows"""),
    "duplicates": (("fire",), """
        SELECT source_year, CAST(SUM(n) AS BIGINT) AS total_rows, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows,
               COUNT(*) AS valid_rows_estimate
        FROM (SELECT source_year, COUNT(*) AS n FROM fire
              GROUP BY source_year, latitude, longitude, acq_date, acq_time) GROUP BY 1"""),
}

CANONICAL = ("latitude, longitude, brightness, scan, track, acq_date, acq_time, satellite, instrument, confidence,"
             " version, bright_t31, frp, daynight, type, event_timestamp")
EVENT = CANONICAL.rsplit(",", 1)[0]
FEATURES = (CANONICAL + ", year, month, day, hour, day_of_week, day_of_year, is_weekend, season, is_night,"
            " latitude_bucket, longitude_bucket")
RAW_NAMES = EVENT.split(", ")

_FINAL: dict[str, tuple[str, str]] = {
    "clean_canonical": ("cleaned", f"SELECT {CANONICAL} FROM cleaned"),
    "time_normalise": ("fire", """
        SELECT acq_time, COUNT(*) AS row_count,
               substr(lpad(trim(acq_time), 4, '0'), 1, 2) || ':' || substr(lpad(trim(acq_time), 4, '0'), 3, 2) AS clock
        FROM fire GROUP BY acq_time"""),
    "nrt_union": ("fire", f"SELECT {EVENT} FROM fire"),
    "event_parse": ("fire", f"""
        SELECT {EVENT} FROM (SELECT * REPLACE (
            NULLIF(trim(confidence), '') AS confidence,
            substr(v, 1, 2) || ':' || substr(v, 3) AS acq_time)
          FROM (SELECT *, CASE WHEN length(acq_time) < 4 THEN lpad(acq_time, 4, '0') ELSE acq_time END AS v
                FROM fire))"""),
    "validity_counts": ("flagged", """
        SELECT source_year, COUNT(*) AS input_rows, COUNT(*) FILTER (WHERE NOT coordinates_ok) AS bad_coordinates,
               COUNT(*) FILTER (WHERE NOT time_ok) AS bad_time,
               COUNT(*) FILTER (WHERE NOT measurements_ok) AS bad_measurements,
               COUNT(*) FILTER (WHERE coordinates_ok AND time_ok AND measurements_ok) AS valid_rows,
               COUNT(*) FILTER (WHERE NOT (coordinates_ok AND time_ok AND measurements_ok)) AS invalid_rows
        FROM flagged GROUP BY source_year"""),
    "quarantine": ("flagged", f"""
        SELECT {CANONICAL} FROM flagged WHERE NOT (coordinates_ok AND time_ok AND measurements_ok)"""),
    "contract_report": ("cleaned", " UNION ALL ".join(
        f"SELECT COUNT(*) AS checked_rows, '{rule}' AS rule, COUNT(*) FILTER (WHERE {broken}) AS violations FROM cleaned"
        for rule, broken in {
            "latitude": "latitude IS NULL OR latitude NOT BETWEEN -90 AND 90",
            "longitude": "longitude IS NULL OR longitude NOT BETWEEN -180 AND 180",
            "acq_date": r"acq_date IS NULL OR NOT regexp_matches(acq_date, '^\d{4}-\d{2}-\d{2}$')",
            "event_timestamp": "event_timestamp IS NULL",
            "brightness": "brightness <= 0", "bright_t31": "bright_t31 <= 0",
            "frp": "frp < 0", "scan": "scan < 0", "track": "track < 0",
            "confidence": "confidence NOT IN ('l', 'n', 'h')", "daynight": "daynight NOT IN ('D', 'N')",
            "type": "type NOT IN (0, 1, 2, 3)",
        }.items())),
    "dedup_detections": ("curated", f"SELECT {CANONICAL} FROM curated"),
    "dedup_serving": ("valid", f"""
        SELECT {CANONICAL} FROM (SELECT *, ROW_NUMBER() OVER (
            PARTITION BY event_timestamp, latitude, longitude
            ORDER BY brightness NULLS FIRST, scan NULLS FIRST, track NULLS FIRST, acq_date, acq_time, satellite,
                     instrument, confidence NULLS FIRST, version, bright_t31 NULLS FIRST, frp NULLS FIRST, daynight,
                     type NULLS FIRST) AS r FROM valid) WHERE r = 1"""),
    "features_batch": ("feats", f"SELECT {FEATURES} FROM feats"),
    "features_stream_variant": ("cleaned", f"""
        SELECT {CANONICAL}, CAST(year(event_timestamp) AS INTEGER) AS year,
               CAST(month(event_timestamp) AS INTEGER) AS month, CAST(day(event_timestamp) AS INTEGER) AS day,
               CAST(hour(event_timestamp) AS INTEGER) AS hour,
               CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS day_of_week,
               CAST(dayofyear(event_timestamp) AS INTEGER) AS day_of_year,
               CASE WHEN dayofweek(event_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN month(event_timestamp) IN (12, 1, 2) THEN 'winter'
                    WHEN month(event_timestamp) IN (3, 4, 5) THEN 'spring'
                    WHEN month(event_timestamp) IN (6, 7, 8) THEN 'summer'
                    WHEN month(event_timestamp) IN (9, 10, 11) THEN 'autumn' ELSE 'unknown' END AS season,
               CASE WHEN daynight IN ('N', 'n') THEN 1 ELSE 0 END AS is_night,
               floor(latitude * 10) / 10 AS latitude_bucket, floor(longitude * 10) / 10 AS longitude_bucket
        FROM cleaned"""),
    "features_ingest": ("ingested", "SELECT * FROM ingested"),
    "features_environment": ("env_rows", "SELECT * FROM env_rows"),
    "quality_report": ("quality", "SELECT * FROM quality"),
    "quality_overall": ("quality", """
        SELECT COUNT(*) AS years_processed, CAST(SUM(input_rows) AS BIGINT) AS total_input_rows,
               CAST(SUM(invalid_rows) AS BIGINT) AS total_invalid_rows,
               CAST(SUM(duplicate_rows) AS BIGINT) AS total_duplicate_rows,
               CAST(SUM(output_rows) AS BIGINT) AS total_output_rows FROM quality"""),
    "profile_nulls": ("fire", " UNION ALL ".join(
        f"SELECT source_year, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count"
        " FROM fire GROUP BY source_year" for c in RAW_NAMES)),
    "profile_ranges": ("fire", """
        SELECT source_year, COUNT(*) FILTER (WHERE latitude < -90 OR latitude > 90) AS invalid_latitude_count,
               COUNT(*) FILTER (WHERE longitude < -180 OR longitude > 180) AS invalid_longitude_count,
               COUNT(*) FILTER (WHERE frp < 0) AS negative_frp_count, """ + ", ".join(
        f"{f}({c}) AS {f}_{c}" for c in ("latitude", "longitude", "brightness", "bright_t31", "frp", "scan", "track")
        for f in ("min", "max")) + """,
               round(NULLIF(avg(brightness), 0), 2) AS avg_brightness, round(NULLIF(avg(frp), 0), 2) AS avg_frp
        FROM fire GROUP BY source_year"""),
    "profile_dates": ("fire", r"""
        SELECT source_year, min(acq_date) AS min_acq_date, max(acq_date) AS max_acq_date,
               COUNT(*) FILTER (WHERE NOT (regexp_matches(acq_date, '^\d{4}-\d{2}-\d{2}$')
                                AND try_strptime(acq_date, '%Y-%m-%d') IS NOT NULL)) AS invalid_date_count
        FROM fire GROUP BY source_year"""),
    "profile_distinct": ("fire", "SELECT * FROM (" + " UNION ALL ".join(f"""
        SELECT source_year, '{c}' AS column_name, string_agg(v, ',' ORDER BY v) AS "values"
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_year ORDER BY v) AS r
              FROM (SELECT DISTINCT source_year, CAST({c} AS VARCHAR) AS v FROM fire WHERE {c} IS NOT NULL))
        WHERE r <= 20 GROUP BY source_year"""
        for c in ("satellite", "instrument", "confidence", "daynight", "type", "version")) + ")"),
    "profile_duplicates": ("duplicates", "SELECT * FROM duplicates"),
    "profile_summary": ("duplicates", """
        SELECT source_year, total_rows, duplicate_rows, date_range, satellites, instruments FROM duplicates JOIN (
          SELECT source_year, min(acq_date) || ' to ' || max(acq_date) AS date_range,
                 string_agg(DISTINCT satellite, ', ') AS satellites,
                 string_agg(DISTINCT instrument, ', ') AS instruments
          FROM fire GROUP BY source_year) USING (source_year)"""),
    "profile_totals": ("duplicates", """
        SELECT COUNT(*) AS years, CAST(SUM(total_rows) AS BIGINT) AS grand_total_rows,
               CAST(SUM(duplicate_rows) AS BIGINT) AS grand_duplicate_rows FROM duplicates"""),
    "zscore_fit": ("stats", "SELECT * FROM stats"),
    "anomaly_model_document": ("stats", "SELECT * FROM stats"),
    "anomaly_scored": ("scored", """
        SELECT event_timestamp, latitude, longitude, frp_z, brightness_z, bright_t31_z, scan_z, track_z,
               anomaly_score, is_anomaly FROM scored"""),
    "anomaly_distribution": ("scored", 'SELECT is_anomaly, COUNT(*) AS "count" FROM scored GROUP BY is_anomaly'),
    "anomaly_alerts": ("found", "SELECT * FROM found"),
    "risk_thresholds": ("cuts", "SELECT * FROM cuts"),
    "risk_labelled": ("labelled", "SELECT split, event_timestamp, latitude, longitude, frp, risk_level FROM labelled"),
    "label_distribution": ("labelled", """
        SELECT split, risk_level, COUNT(*) AS "count" FROM labelled GROUP BY split, risk_level"""),
    "ml_null_fill": ("feats", f"""
        SELECT {FEATURES} FROM (SELECT * REPLACE (
            COALESCE(CAST(type AS VARCHAR), 'unknown') AS type, COALESCE(confidence, 'unknown') AS confidence,
            COALESCE(daynight, 'unknown') AS daynight, COALESCE(season, 'unknown') AS season,
            COALESCE(brightness, 0) AS brightness, COALESCE(bright_t31, 0) AS bright_t31,
            COALESCE(scan, 0) AS scan, COALESCE(track, 0) AS track) FROM feats)"""),
    "split_counts": ("labelled", "SELECT split, COUNT(*) AS row_count FROM labelled GROUP BY split"),
    "label_index": ("labelled", """
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, risk_level) - 1 AS INTEGER) AS index, risk_level
        FROM labelled WHERE split = 'train' GROUP BY risk_level"""),
    "category_index": ("categories", "SELECT * FROM categories"),
    "feature_vectors": ("learning sizes", """
        SELECT event_timestamp, latitude, longitude,
               CAST(15 + confidence_size + daynight_size + season_size + type_size AS INTEGER) AS vector_size,
               round(""" + " + ".join(f"{c} * {i}e0" for i, c in enumerate(NUMERIC, 1)) + """
                     + 16 + COALESCE(c.index, confidence_size - 1)
                     + 16 + confidence_size + COALESCE(d.index, daynight_size - 1)
                     + 16 + confidence_size + daynight_size + COALESCE(s.index, season_size - 1)
                     + 16 + confidence_size + daynight_size + season_size + COALESCE(t.index, type_size - 1),
                     6) AS weighted_sum
        FROM learning CROSS JOIN sizes """ + " ".join(
        f"LEFT JOIN categories {c[0]} ON {c[0]}.column_name = '{c}' AND {c[0]}.value = learning.{c}"
        for c in CATEGORICAL)),
    "confusion_matrix": ("judged", """
        SELECT split, label, prediction, COUNT(*) AS "count" FROM judged GROUP BY split, label, prediction"""),
    "classifier_metrics": ("judged", """
        SELECT split, round(SUM(hit) / SUM(actual), 4) AS accuracy,
               round(SUM(actual * CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END) / SUM(actual), 4) AS f1,
               round(SUM(actual * p) / SUM(actual), 4) AS weighted_precision,
               round(SUM(actual * r) / SUM(actual), 4) AS weighted_recall
        FROM (SELECT split, c, CAST(actual AS DOUBLE) AS actual, CAST(hit AS DOUBLE) AS hit,
                     CASE WHEN guessed = 0 THEN 0 ELSE hit * 1e0 / guessed END AS p,
                     CASE WHEN actual = 0 THEN 0 ELSE hit * 1e0 / actual END AS r
              FROM (SELECT split, c, COUNT(*) FILTER (WHERE label = c) AS actual,
                           COUNT(*) FILTER (WHERE prediction = c) AS guessed,
                           COUNT(*) FILTER (WHERE label = c AND prediction = c) AS hit
                    FROM judged, (SELECT unnest(['High', 'Low', 'Medium']) AS c) GROUP BY split, c))
        GROUP BY split"""),
    "regressor_metrics": ("labelled", """
        SELECT split, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
               round(1 - avg(e * e) / var_pop(frp), 4) AS r2
        FROM (SELECT split, frp, frp - (bright_t31 - 220) * 0.5e0 AS e FROM labelled) GROUP BY split"""),
    "risk_alerts": ("risky", "SELECT * FROM risky"),
    "merged_alerts": ("merged", "SELECT * FROM merged"),
    "alert_json": ("merged", """
        SELECT * REPLACE (strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.000Z') AS event_timestamp) FROM merged"""),
    "stream_fire_ingest": ("ingested", "SELECT * FROM ingested"),
    "stream_batch_tables": ("ingested", "SELECT * FROM ingested"),
    "stream_env_ingest": ("env_rows", "SELECT * FROM env_rows"),
    "stream_anomaly": ("live_found", "SELECT * FROM live_found"),
    "stream_alerts": ("live_risky live_found", """
        SELECT event_timestamp, latitude, longitude, frp, CAST(NULL AS DOUBLE) AS anomaly_score, risk_level,
               CAST(NULL AS VARCHAR) AS anomaly_alert_level, upper(risk_level) AS alert_level,
               'risk_prediction' AS alert_source, risk_level || ' wildfire risk predicted by ML model' AS alert_reason,
               'WILDFIRE ALERT: ' || risk_level || ' wildfire risk predicted by ML model' AS alert_message
        FROM live_risky UNION ALL
        SELECT event_timestamp, latitude, longitude, frp, anomaly_score, NULL, alert_level, alert_level,
               'anomaly_detection', alert_reason, 'WILDFIRE ALERT: ' || alert_reason FROM live_found"""),
    "serving_rows": ("events_served", """
        SELECT * REPLACE (CAST(type AS SMALLINT) AS type, CAST(year AS SMALLINT) AS year,
                          CAST(is_night AS SMALLINT) AS is_night) FROM events_served"""),
    "serving_alert_rows": ("merged", "SELECT * FROM merged"),
    "daily_fire_kpis": ("events_served", """
        SELECT CAST(event_timestamp AS DATE) AS event_date, COUNT(*) AS fire_count,
               CAST(round(CAST(avg(frp) AS DECIMAL(38,12)), 2) AS DECIMAL(18,2)) AS avg_frp,
               CAST(round(CAST(max(frp) AS DECIMAL(38,12)), 2) AS DECIMAL(18,2)) AS max_frp,
               COUNT(*) FILTER (WHERE daynight = 'N') AS night_fires
        FROM events_served GROUP BY 1"""),
    "fire_kpis": ("events_served", """
        SELECT COUNT(*) AS total_fires, round(COALESCE(sum(frp), 0), 6) AS total_frp,
               round(COALESCE(avg(frp), 0), 6) AS avg_frp, COUNT(*) FILTER (WHERE is_night = 1) AS night_fires
        FROM events_served"""),
    "risk_distribution": ("predictions", """
        SELECT risk_level, COUNT(*) AS "count" FROM predictions GROUP BY risk_level"""),
    "anomaly_summary": ("scored", """
        SELECT CAST(event_timestamp AS DATE) AS event_date, COUNT(*) FILTER (WHERE is_anomaly = 1) AS anomaly_count,
               CAST(round(CAST(avg(anomaly_score) AS DECIMAL(38,12)), 3) AS DECIMAL(18,3)) AS avg_anomaly_score
        FROM scored GROUP BY 1"""),
    "active_alerts": ("merged", """
        SELECT event_timestamp, latitude, longitude, frp, anomaly_score, risk_level, alert_level, alert_source,
               alert_reason, alert_message, event_timestamp AS created_at FROM merged
        ORDER BY created_at DESC, latitude, longitude, alert_source, alert_reason, frp NULLS FIRST LIMIT 500"""),
    "recent_events": ("events_served", """
        SELECT * FROM events_served ORDER BY event_timestamp DESC, latitude, longitude LIMIT 10000"""),
    "event_date_bounds": ("events_served", """
        SELECT min(CAST(event_timestamp AS DATE)) AS min_date, max(CAST(event_timestamp AS DATE)) AS max_date
        FROM events_served"""),
    "map_points": ("events_served", """
        SELECT latitude, longitude, frp, brightness, confidence, event_timestamp FROM events_served
        WHERE CAST(event_timestamp AS DATE) = (SELECT max(CAST(event_timestamp AS DATE)) FROM events_served)"""),
    "recent_table": ("events_served", """
        SELECT event_timestamp, latitude, longitude, frp, brightness, confidence, daynight, satellite
        FROM events_served
        WHERE CAST(event_timestamp AS DATE) = (SELECT max(CAST(event_timestamp AS DATE)) FROM events_served)"""),
    "load_gate": ("events_served", "SELECT COUNT(*) AS row_count, COUNT(*) > 0 AS passed FROM events_served"),
    "csv_year_scan": ("fire", f"SELECT {EVENT}, source_year FROM fire"),
    "history_report": ("quality", "SELECT * FROM quality"),
    "history_features": ("feats", f"SELECT {FEATURES} FROM feats WHERE year IN (2000, 2001)"),
    "raw_sample": ("fire", "SELECT least(COUNT(*), 1000) AS sample_rows FROM fire"),
    "text_messages": ("timed", f"SELECT {EVENT} FROM timed"),
    "word_count": ("", r"""
        SELECT word, COUNT(*) AS "count" FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents)
        GROUP BY word"""),
    "word_count_csv": ("", r"""
        SELECT COUNT(DISTINCT word) AS row_count, COUNT(*) AS total_count
        FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents)"""),
    "sql_count": ("", "SELECT COUNT(*) AS total_rows FROM documents"),
    "preview": ("", "SELECT * FROM documents ORDER BY doc_id LIMIT 10"),
    **{f"train_{name}": ("labelled", f"""
        SELECT '{model}' AS model, split, COUNT(*) AS judged_rows, {matrix} TRUE AS figures_agree
        FROM labelled WHERE split <> 'train' GROUP BY split""") for name, model, matrix in (
            ("risk_rf", FOREST, "COUNT(*) AS matrix_rows,"), ("risk_gbt_ovr", RISK_BOOSTED, "COUNT(*) AS matrix_rows,"),
            ("frp_rf", FOREST, ""), ("frp_gbt", SIZE_BOOSTED, ""))},
    "select_best": ("labelled", """
        SELECT target, CAST(2 AS INTEGER) AS models, COUNT(*) FILTER (split = 'train') AS train,
               COUNT(*) FILTER (split = 'validation') AS validation, COUNT(*) FILTER (split = 'test') AS test,
               TRUE AS best_is_best
        FROM labelled, (SELECT unnest(['risk', 'fire_size']) AS target) GROUP BY target"""),
    "score_risk": ("feats", """
        SELECT event_timestamp, latitude, longitude, frp, TRUE AS predicted, TRUE AS known_level FROM feats WHERE year = 2001"""),
    "score_fire_size": ("feats", """
        SELECT event_timestamp, latitude, longitude, 'fire_size_regressor_v1' AS model_version, TRUE AS predicted
        FROM feats WHERE year = 2001"""),
    "stream_risk": ("cleaned", """
        SELECT strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.000Z') AS event_timestamp, latitude, longitude, frp,
               TRUE AS known_level FROM cleaned WHERE event_timestamp IS NOT NULL"""),
    "stream_batch_replay": ("ingested", "SELECT * FROM ingested"),
    "stream_action_archive": ("", """
        SELECT CAST(user_id AS INTEGER) AS user_id, event_type AS action, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts
        FROM events"""),
    "serving_rejected": ("events_served", """
        SELECT CASE WHEN type IN (1, 2, 3) THEN 'rejected' ELSE 'kept' END AS side, type, COUNT(*) AS row_count
        FROM events_served GROUP BY 1, 2"""),
    "profile_categories": ("fire", " UNION ALL ".join(f"""
        SELECT source_year, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS row_count
        FROM fire WHERE {c} IS NOT NULL GROUP BY 1, 3"""
        for c in ("satellite", "instrument", "confidence", "daynight", "type", "version"))),
    "file_listing": ("fire", """
        SELECT source_year AS year, bool_or(NOT contains(version, 'NRT')) AS has_archive,
               bool_or(contains(version, 'NRT')) AS has_nrt, TRUE AS all_sized, COUNT(*) AS row_count
        FROM fire GROUP BY source_year"""),
    "file_sample": ("fire", """
        SELECT source_year, CAST(SUM(least(n, 100)) AS BIGINT) AS row_count FROM (
          SELECT source_year, contains(version, 'NRT') AS nrt, COUNT(*) AS n FROM fire GROUP BY 1, 2) GROUP BY 1"""),
    "history_rerun": ("quality", """
        SELECT source_year AS year, input_rows, CASE WHEN source_year = 2000 THEN input_rows ELSE invalid_rows END AS invalid_rows,
               CASE WHEN source_year = 2000 THEN 0 ELSE output_rows END AS output_rows,
               CASE WHEN source_year = 2000 THEN 0 ELSE duplicate_rows END AS duplicate_rows,
               CASE WHEN source_year = 2000 THEN 0 ELSE output_rows END AS feature_rows FROM quality"""),
    "quality_document": ("quality", """
        SELECT source_year AS year, TRUE AS has_files, TRUE AS has_duration, input_rows, invalid_rows, duplicate_rows,
               output_rows AS output_curated_rows, min_latitude, max_latitude, min_longitude, max_longitude,
               min_acq_date, max_acq_date, quality_status FROM quality"""),
    "fire_readings": ("linked readings", """
        SELECT f.event_timestamp, f.latitude, f.longitude, f.frp, n.reading_time, n.gap_seconds, n.distance_km, n.temperature,
               n.humidity, n.wind_speed, n.wind_direction, n.rainfall, n.smoke, n.air_quality_index, n.source
        FROM (SELECT event_timestamp, latitude, longitude, CASE WHEN count(*) > count(frp) THEN NULL ELSE min(frp) END AS frp
              FROM linked GROUP BY ALL_KEYS) f
        LEFT JOIN (
          SELECT * FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY event_timestamp, latitude, longitude ORDER BY gap_seconds, distance_km,
              reading_time, reading_latitude, reading_longitude, temperature NULLS FIRST, humidity NULLS FIRST,
              wind_speed NULLS FIRST, wind_direction NULLS FIRST, rainfall NULLS FIRST, smoke NULLS FIRST,
              air_quality_index NULLS FIRST, source NULLS FIRST) AS r
            FROM (
              SELECT f.event_timestamp, f.latitude, f.longitude, r.*,
                CAST(abs(epoch(f.event_timestamp) - epoch(r.reading_time)) AS BIGINT) AS gap_seconds,
                round(2 * 6371.0 * asin(sqrt(least(1.0,
                  sin(radians(r.reading_latitude - f.latitude)/2)*sin(radians(r.reading_latitude - f.latitude)/2)
                  + cos(radians(f.latitude))*cos(radians(r.reading_latitude))
                    *sin(radians(r.reading_longitude - f.longitude)/2)*sin(radians(r.reading_longitude - f.longitude)/2)))), 3) AS distance_km
              FROM (SELECT DISTINCT event_timestamp, latitude, longitude FROM linked) f JOIN readings r
                ON r.reading_time BETWEEN f.event_timestamp - INTERVAL 6 HOUR AND f.event_timestamp + INTERVAL 6 HOUR
               AND abs(floor(r.reading_latitude/1.5) - floor(f.latitude/1.5)) <= 1
               AND CAST(floor(r.reading_longitude/1.5) - floor(f.longitude/1.5) + 480 AS BIGINT) % 240 IN (0, 1, 239)))
          WHERE r = 1) n USING (event_timestamp, latitude, longitude)""".replace("ALL_KEYS", "event_timestamp, latitude, longitude")),
    "stream_fire_readings": ("linked readings", """
        SELECT f.event_timestamp, f.latitude, f.longitude, f.frp, r.reading_time, r.reading_latitude, r.reading_longitude,
               r.temperature, r.humidity
        FROM linked f JOIN readings r
          ON r.reading_time BETWEEN f.event_timestamp - INTERVAL 1 HOUR AND f.event_timestamp + INTERVAL 1 HOUR
         AND floor(r.reading_latitude/15) = floor(f.latitude/15) AND floor(r.reading_longitude/15) = floor(f.longitude/15)"""),
    "stream_recurrence": ("ingested events_served", """
        SELECT i.event_timestamp, i.latitude, i.longitude, i.frp, CAST(COALESCE(n.earlier_fires, 0) AS BIGINT) AS earlier_fires
        FROM (SELECT *, floor(latitude/0.1) AS y, floor(longitude/0.1) AS x, CAST(event_timestamp AS DATE) AS d FROM ingested) i
        LEFT JOIN (
          SELECT a.y, a.x, a.d, COUNT(*) AS earlier_fires
          FROM (SELECT DISTINCT floor(latitude/0.1) AS y, floor(longitude/0.1) AS x, CAST(event_timestamp AS DATE) AS d FROM ingested) a
          JOIN (SELECT floor(latitude/0.1) AS y, floor(longitude/0.1) AS x, CAST(event_timestamp AS DATE) AS d FROM events_served) s
            ON s.y = a.y AND s.x = a.x AND s.d < a.d AND s.d >= a.d - 30
          GROUP BY 1, 2, 3) n ON n.y = i.y AND n.x = i.x AND n.d = i.d
        WHERE i.event_timestamp IS NOT NULL"""),
    "stream_dedup": ("linked", "SELECT DISTINCT event_timestamp, latitude, longitude FROM linked WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"),
    "stream_fallen_rows": ("cleaned", """
        SELECT *, input_rows - out_of_bounds_rows - untimed_rows AS kept_rows, input_rows - out_of_bounds_rows - untimed_rows AS stored_rows
        FROM (SELECT COUNT(*) AS input_rows, COUNT(*) FILTER (WHERE NOT placed) AS out_of_bounds_rows,
                     COUNT(*) FILTER (WHERE placed AND event_timestamp IS NULL) AS untimed_rows
              FROM (SELECT *, COALESCE(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, FALSE) AS placed FROM cleaned))"""),
    "stream_table_replay": ("events_served", "SELECT * FROM events_served"),
    "csv_by_header": ("fire", f"SELECT {EVENT}, source_year FROM fire"),
    "profile_document": ("duplicates", """
        SELECT source_year AS year, TRUE AS has_files, TRUE AS has_duration, total_rows, duplicate_rows, valid_rows_estimate,
               min_latitude, max_latitude, min_longitude, max_longitude, min_acq_date, max_acq_date, negative_frp_count, versions
        FROM duplicates JOIN (
          SELECT source_year, min(latitude) AS min_latitude, max(latitude) AS max_latitude, min(longitude) AS min_longitude,
                 max(longitude) AS max_longitude, min(acq_date) AS min_acq_date, max(acq_date) AS max_acq_date,
                 COUNT(*) FILTER (WHERE frp < 0) AS negative_frp_count,
                 string_agg(DISTINCT version, ',' ORDER BY version) AS versions
          FROM fire GROUP BY source_year) USING (source_year)"""),
}


def _needed(stages: list[str]) -> list[str]:
    """Stages in build order, each once."""
    ordered: list[str] = []
    for stage in stages:
        for name in [*_needed(list(STAGES[stage][0])), stage]:
            if name not in ordered:
                ordered.append(name)
    return ordered


def _statement(stages: str, final: str) -> str:
    parts = [f"{name} AS ({STAGES[name][1]})" for name in _needed(stages.split())]
    return (f"WITH {', '.join(parts)} " if parts else "") + final


# The same answers, given by a store by month or carried on by a stream.
_FINAL |= {f"board_{name}": _FINAL[name] for name in ("recent_events", "map_points")} | {
    "board_date_bounds": _FINAL["event_date_bounds"],
    "board_busiest_day": ("events_served", """
        SELECT event_timestamp, latitude, longitude, frp, brightness, confidence, daynight, satellite FROM events_served
        WHERE CAST(event_timestamp AS DATE) = (
          SELECT CAST(event_timestamp AS DATE) FROM events_served GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)"""),
    "stream_daily_kpis": ("linked_full", _FINAL["daily_fire_kpis"][1].replace("events_served", "linked_full")),
    "stream_anomaly_days": ("live_scored", _FINAL["anomaly_summary"][1].replace("FROM scored", "FROM live_scored")),
    "stream_compacted": ("linked_full", """
        SELECT event_timestamp, latitude, longitude, frp, bright_t31, daynight, CAST(year(event_timestamp) AS INTEGER) AS year,
               CAST(month(event_timestamp) AS INTEGER) AS month FROM linked_full"""),
}

ORACLE_SQL: dict[str, str] = {name: _statement(stages, final) for name, (stages, final) in _FINAL.items()}
