"""SQL that must give the same rows as the registered queries, written for DuckDB."""

from __future__ import annotations

from telemetra.queries.forest_sql import forest
from telemetra.queries.fixture import AS_OF, RANGE, RAW_SQL
from telemetra.queries.catalog import BACKFILL_RANGES, EARLY_SUMMARY, LATE_SUMMARY, MAX_SHIFT, OFF_HOUR, ROLLING_DELAY, SENSOR, SENSOR_WINDOW

_NUMBERS = ("pm2_5", "pm10", "no2", "o3", "temperature", "humidity")
_NUMBER_LIST = ", ".join(_NUMBERS)
_NULLABLE_LIST = _NUMBER_LIST.replace("humidity", "CAST(humidity AS DOUBLE) AS humidity")
_RAW_LIST = f"sensor_id, lat, lon, {_NUMBER_LIST}, status, is_true_anomaly"
_TIME_TEXT = "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f')"

_HEAT = (
    "CAST(ROUND(CAST(CAST(temperature*1.1e0 + humidity*0.05e0 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"
)
_AQI = (
    "CASE WHEN pm2_5 IS NULL THEN 'unknown' WHEN pm2_5 <= 12 THEN 'good' WHEN pm2_5 <= 35.4e0 THEN 'moderate' "
    "WHEN pm2_5 <= 55.4e0 THEN 'unhealthy_sensitive' WHEN pm2_5 <= 150 THEN 'unhealthy' ELSE 'hazardous' END"
)
_VALID = (
    "sensor_id IS NOT NULL AND status = 'active' AND pm2_5 BETWEEN 0 AND 500 AND pm10 BETWEEN 0 AND 600 "
    "AND temperature BETWEEN -50 AND 60 AND humidity BETWEEN 0 AND 100"
)
_FLAG = "(pm2_5 > 35.4e0 OR pm10 > 50 OR no2 > 85 OR o3 > 100 OR temperature > 40 OR humidity > 85)"
_REASON = (
    "CASE WHEN pm2_5 > 35.4e0 THEN 'HIGH_PM2_5' WHEN pm10 > 50 THEN 'HIGH_PM10' WHEN no2 > 85 THEN 'HIGH_NO2' "
    "WHEN o3 > 100 THEN 'HIGH_O3' WHEN temperature > 40 THEN 'EXTREME_TEMP' ELSE 'HIGH_HUMIDITY' END"
)
_SEVERITY = "CASE WHEN pm2_5 > 150 OR no2 > 200 THEN 'critical' ELSE 'warning' END"

_BASE = f"""
raw AS (
  SELECT event_id AS row_id, * EXCLUDE (event_id) FROM ({RAW_SQL.format(events="events")}) AS derived
),
readings AS (
  SELECT *, {_AQI} AS aqi_category, {_HEAT} AS heat_index FROM raw WHERE {_VALID}
),
anomalies AS (
  SELECT *, {_REASON} AS anomaly_reason, {_SEVERITY} AS severity FROM readings WHERE {_FLAG}
)"""


def _sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([_BASE, *ctes]) + "\n" + body


def _round(expression: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def _in_window(as_of: str) -> str:
    return f"event_time >= TIMESTAMP '{as_of}' - INTERVAL 24 HOURS AND event_time < TIMESTAMP '{as_of}'"


# --- messages


def _json_number(name: str) -> str:
    return f"""'"{name}":' || CAST({name} AS VARCHAR)"""


def _json(fields: str) -> str:
    measurements = ", ".join(_json_number(name) for name in _NUMBERS)
    return (
        """'{"sensor_id":"' || sensor_id || '","timestamp":"' || """
        + _TIME_TEXT
        + f""" || '","measurements":{{' || concat_ws(',', {measurements}) || '}},{fields}"""
        + f""" || ',"processed_at":"{AS_OF.replace(" ", "T")}.000Z","is_true_anomaly":"' || is_true_anomaly || '"}}'"""
    )


_PROCESSED_JSON = _json(
    """' || '"aqi_category":"' || aqi_category || '","heat_index":' || CAST(heat_index AS VARCHAR)"""
)
_ANOMALY_JSON = _json("""' || '"anomaly_reason":"' || anomaly_reason || '","severity":"' || severity || '"'""")

# --- aggregates

_AVERAGES = ", ".join(f"AVG({name}) AS avg_{name}" for name in _NUMBERS)
_STATS = (
    f"sensor_id, {_AVERAGES}, MAX(pm2_5) AS max_pm2_5, MAX(pm10) AS max_pm10, MAX(no2) AS max_no2, "
    "MAX(temperature) AS max_temperature, MIN(pm2_5) AS min_pm2_5, CAST(COUNT(*) AS INTEGER) AS total_readings"
)
_SHOWN_STATS = (
    "s.sensor_id, "
    + ", ".join(f"{_round(f's.avg_{name}', 6)} AS avg_{name}" for name in _NUMBERS)
    + ", s.max_pm2_5, s.max_pm10, s.max_no2, s.max_temperature, s.min_pm2_5, s.total_readings"
)


def _stats(source: str, name: str = "stats") -> str:
    return f"{name} AS (SELECT {_STATS} FROM {source} GROUP BY sensor_id)"


def _dominant(source: str, name: str = "dominant") -> str:
    return f"""{name} AS (
  SELECT sensor_id, aqi_category AS dominant_aqi FROM (
    SELECT sensor_id, aqi_category, ROW_NUMBER() OVER (
      PARTITION BY sensor_id ORDER BY COUNT(*) DESC, aqi_category ASC NULLS LAST) AS place
    FROM {source} GROUP BY sensor_id, aqi_category) AS ranked
  WHERE place = 1)"""


def _counts(source: str, name: str = "counts") -> str:
    return (
        f"{name} AS (SELECT sensor_id, CAST(COUNT(*) AS INTEGER) AS anomaly_count FROM {source} GROUP BY sensor_id)"
    )


_SUMMARY_COLUMNS = [
    *[(f"{kind}_{name}", 1 if f"{kind}_{name}" == "avg_humidity" else 2) for kind, name in (
        ("avg", "pm2_5"), ("max", "pm2_5"), ("min", "pm2_5"), ("avg", "pm10"), ("max", "pm10"), ("avg", "no2"),
        ("max", "no2"), ("avg", "o3"), ("avg", "temperature"), ("max", "temperature"), ("avg", "humidity"),
    )]
]


def _summary(as_of: str, name: str) -> list[str]:
    """The CTEs of one daily summary."""
    shown = ", ".join(f"{_round(f's.{column}', digits)} AS {column}" for column, digits in _SUMMARY_COLUMNS)
    return [
        f"{name}_window AS (SELECT * FROM readings WHERE {_in_window(as_of)})",
        f"{name}_found AS (SELECT * FROM anomalies WHERE {_in_window(as_of)})",
        _stats(f"{name}_window", f"{name}_stats"),
        _counts(f"{name}_found", f"{name}_counts"),
        _dominant(f"{name}_window", f"{name}_dominant"),
        f"""{name} AS (
  SELECT CAST(TIMESTAMP '{as_of}' AS DATE) AS summary_date, s.sensor_id, {shown}, s.total_readings,
    COALESCE(c.anomaly_count, 0) AS anomaly_count, d.dominant_aqi, TIMESTAMP '{as_of}' AS created_at
  FROM {name}_stats s LEFT JOIN {name}_counts c ON s.sensor_id = c.sensor_id
  LEFT JOIN {name}_dominant d ON s.sensor_id = d.sensor_id)""",
    ]


_EARLY = _summary(EARLY_SUMMARY, "early")
_LATE = _summary(LATE_SUMMARY, "late")
_TODAY = _summary(AS_OF, "today")
_OFF_HOUR = _summary(OFF_HOUR, "today")

_CLASS_NAMES = ("good", "moderate", "unhealthy_sensitive", "unhealthy", "hazardous", "unknown")
_PARTIALS = f"""
SELECT sensor_id, date_trunc('hour', event_time) AS event_time, COUNT(*) AS n, COUNT(*) FILTER (WHERE {_FLAG}) AS n_anomalies,
  {", ".join(f"{_round(f'SUM(CAST({name} AS DOUBLE))', 6)} AS sum_{name}, COUNT({name}) AS n_{name}" for name in _NUMBERS)},
  MAX(pm2_5) AS max_pm2_5, MAX(pm10) AS max_pm10, MAX(no2) AS max_no2, MAX(temperature) AS max_temperature, MIN(pm2_5) AS min_pm2_5,
  {", ".join(f"COUNT(*) FILTER (WHERE aqi_category = '{name}') AS class_{name}" for name in _CLASS_NAMES)},
  COUNT(*) FILTER (WHERE aqi_category IS NULL) AS class_none
FROM readings WHERE event_time IS NOT NULL GROUP BY ALL"""
# Every window of 24 hours that ends on an hour and no later than the stream's last event time less its delay.
_ROLLING = f"""
WITH ends AS (
  SELECT unnest(generate_series(date_trunc('hour', MIN(event_time)), MAX(event_time) - INTERVAL '{ROLLING_DELAY}', INTERVAL 1 HOUR)) AS as_of
  FROM readings
),
inside AS (SELECT as_of, r.* FROM ends JOIN readings r ON event_time >= as_of - INTERVAL 24 HOURS AND event_time < as_of),
classes AS (
  SELECT as_of, sensor_id, aqi_category, ROW_NUMBER() OVER (
    PARTITION BY as_of, sensor_id ORDER BY COUNT(*) DESC, aqi_category ASC NULLS LAST) AS place
  FROM inside GROUP BY as_of, sensor_id, aqi_category
),
rolled AS (
  SELECT as_of, {_STATS}, CAST(COUNT(*) FILTER (WHERE {_FLAG}) AS INTEGER) AS anomaly_count FROM inside GROUP BY as_of, sensor_id
)
SELECT s.as_of, s.sensor_id, {", ".join(f"{_round(f's.{column}', digits)} AS {column}" for column, digits in _SUMMARY_COLUMNS)},
  s.total_readings, s.anomaly_count, c.aqi_category AS dominant_aqi
FROM rolled s JOIN classes c ON c.place = 1 AND c.as_of = s.as_of AND c.sensor_id = s.sensor_id"""

# --- models

_COMPLETE = (
    " AND ".join(f"{name} IS NOT NULL AND NOT isnan(CAST({name} AS DOUBLE))" for name in _NUMBERS)
    + " AND humidity BETWEEN 0 AND 100"
)
_PREDICTIONS = f"""predictions AS (
  SELECT row_id, sensor_id, event_time,
    CASE WHEN lower(is_true_anomaly) = 'true' THEN -1 ELSE 1 END AS by_label,
    CASE WHEN {_FLAG} THEN -1 ELSE 1 END AS by_rule
  FROM readings)"""
_SOURCES = """sources AS (
  SELECT 'label' AS source, event_time, by_label AS prediction FROM predictions
  UNION ALL SELECT 'rule' AS source, event_time, by_rule AS prediction FROM predictions)"""
_COUNTED = "COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE prediction = -1) AS n_anomalies"
_RATE = "CAST(n_anomalies AS DOUBLE) / CAST(n_rows AS DOUBLE)"
_MODELS = f"""models AS (
  SELECT source || '_' || strftime(day, '%Y-%m-%d') AS model_id, day + INTERVAL 24 HOURS AS created_at, n_rows,
    {_RATE} AS anomaly_rate, 1e0 - abs(0.05e0 - {_RATE}) AS health_score
  FROM (SELECT source, date_trunc('day', event_time) AS day, {_COUNTED} FROM sources GROUP BY ALL) AS daily)"""
_BY_AGE = "ORDER BY created_at, model_id"


def _history(source: str) -> str:
    return f"""history AS (
  SELECT *, CASE WHEN health_score > champion_score THEN 'promote' ELSE 'keep' END AS decision FROM (
    SELECT *, greatest(COALESCE(MAX(health_score) OVER (
      {_BY_AGE} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.9e0), 0.9e0) AS champion_score
    FROM {source}) AS compared)"""


_CURRENT = """current_champion AS (
  SELECT model_id, created_at AS promoted_at FROM history WHERE decision = 'promote'
  ORDER BY created_at DESC, model_id DESC LIMIT 1)"""

# Rows above the interpolated 0.95 quantile of n different scores.
_HEALTH = (
    f"n_rows, {_round(_RATE, 3)} AS anomaly_rate, {_round(f'1e0 - abs(0.05e0 - {_RATE})', 3)} AS health_score"
)
_ALL_FORESTS = forest(f"SELECT * FROM readings WHERE {_COMPLETE}")
_RANGE_FORESTS = [
    cte
    for place, (start, end) in enumerate(BACKFILL_RANGES)
    for cte in forest(
        f"SELECT * FROM readings WHERE event_time BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}' AND {_COMPLETE}", f"r{place}"
    )
]


def _judged(name: str) -> str:
    """Counts of a forest's predictions, and its threshold."""
    return (
        f"SELECT {_COUNTED}, round(quantile_cont(score, 0.95), 9) AS threshold FROM {name}_scores"
    )


def _range_key(start: str, end: str) -> str:
    return "isolation_forest_" + "_to_".join(text.replace(" ", "T").replace(":", "-") for text in (start, end))


# --- series

_HOURLY = """hourly AS (
  SELECT sensor_id, CAST(floor(epoch(date_trunc('hour', event_time)) / 3600) AS BIGINT) AS hour,
    AVG(pm2_5) AS current, COUNT(*) AS n_readings
  FROM readings GROUP BY ALL)"""


def _neighbour(offset: int, name: str) -> str:
    return f"{name} AS (SELECT sensor_id, hour - ({offset}) AS hour, current AS {name} FROM hourly)"


_LAGGED = [
    _HOURLY,
    _neighbour(-1, "lag_1"),
    _neighbour(-2, "lag_2"),
    _neighbour(-3, "lag_3"),
    _neighbour(1, "next_hour"),
    """lagged AS (
  SELECT * FROM hourly LEFT JOIN lag_1 USING (sensor_id, hour) LEFT JOIN lag_2 USING (sensor_id, hour)
  LEFT JOIN lag_3 USING (sensor_id, hour) LEFT JOIN next_hour USING (sensor_id, hour))""",
]

_KEPT = "\n  UNION ALL\n  ".join(
    [
        "SELECT * FROM late",
        "SELECT * FROM early WHERE NOT EXISTS (SELECT 1 FROM late WHERE late.summary_date = early.summary_date"
        " AND late.sensor_id = early.sensor_id)",
    ]
)
_PROFILE = ", ".join(
    [f"{_round(f'AVG({name})', 6)} AS mean_{name}" for name in _NUMBERS]
    + [f"{_round(f'stddev_samp({name})', 6)} AS std_{name}" for name in _NUMBERS]
)
_MOVED = ", ".join(
    f"CASE WHEN abs(r.mean_{name} - t.mean_{name}) > t.std_{name} * {MAX_SHIFT}e0 THEN '{name}' END"
    for name in _NUMBERS
)
_MOMENTS = ", ".join(
    [f"AVG({name}) AS mean_{name}" for name in _NUMBERS] + [f"stddev_samp({name}) AS std_{name}" for name in _NUMBERS]
)
_RECENT = f"event_time >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOURS AND pm2_5 IS NOT NULL"
_IN_RANGE = (
    f"event_time >= TIMESTAMP '{RANGE[0]}' AND event_time <= TIMESTAMP '{RANGE[1]}' AND pm2_5 IS NOT NULL"
)
_TRUTH = "lower(is_true_anomaly) = 'true'"
_DAMAGED = "row_id % 6 <> 4"

_READING_COLUMNS = (
    f"row_id, sensor_id, event_time, lat, lon, {_NUMBER_LIST}, aqi_category, heat_index, is_true_anomaly"
)
_ANOMALY_COLUMNS = f"row_id, sensor_id, event_time, {_NUMBER_LIST}, anomaly_reason, severity, is_true_anomaly"


def _unless_damaged(expression: str, name: str) -> str:
    return f"CASE WHEN {_DAMAGED} THEN NULL ELSE {expression} END AS {name}"


CHECKS: dict[str, str] = {
    "s_parse_json": _sql(
        f"SELECT row_id, sensor_id, {_TIME_TEXT} AS timestamp, lat, lon, {_NULLABLE_LIST}, status, is_true_anomaly "
        "FROM raw"
    ),
    "s_parse_malformed": _sql(
        f"SELECT row_id, {_unless_damaged('sensor_id', 'sensor_id')}, {_unless_damaged(_TIME_TEXT, 'timestamp')}, "
        f"{_unless_damaged('pm2_5', 'pm2_5')}, {_unless_damaged('CAST(humidity AS DOUBLE)', 'humidity')}, "
        f"{_unless_damaged('status', 'status')} FROM raw"
    ),
    "s_processed_json": _sql(f"SELECT sensor_id AS key, {_PROCESSED_JSON} AS value FROM readings"),
    "s_anomaly_json": _sql(f"SELECT sensor_id AS key, {_ANOMALY_JSON} AS value FROM anomalies"),
    "s_stream_ingest": _sql(f"SELECT {_READING_COLUMNS} FROM readings"),
    "s_stream_anomalies": _sql(f"SELECT {_ANOMALY_COLUMNS} FROM anomalies"),
    "f_clean": _sql(f"SELECT row_id, event_time, {_RAW_LIST} FROM raw WHERE {_VALID}"),
    "f_rejected": _sql(
        f"SELECT row_id, event_time, sensor_id, lat, lon, {_NULLABLE_LIST}, status, is_true_anomaly "
        f"FROM raw WHERE NOT COALESCE({_VALID}, FALSE)"
    ),
    "f_anomalies": _sql(f"SELECT row_id, sensor_id, {_NUMBER_LIST} FROM anomalies"),
    "f_rolling_24h": _sql(f"SELECT row_id, sensor_id, event_time FROM readings WHERE {_in_window(AS_OF)}"),
    "p_enrich": _sql(
        f"SELECT row_id, sensor_id, {_TIME_TEXT} AS timestamp, {_NUMBER_LIST}, aqi_category, heat_index FROM readings"
    ),
    "p_flatten_readings": _sql(f"SELECT {_READING_COLUMNS} FROM readings"),
    "p_flatten_anomalies": _sql(f"SELECT {_ANOMALY_COLUMNS} FROM anomalies"),
    "p_anomaly_reason": _sql("SELECT row_id, anomaly_reason FROM anomalies"),
    "p_anomaly_severity": _sql("SELECT row_id, severity FROM anomalies"),
    "p_debug_projection": _sql(
        f"SELECT sensor_id, {_TIME_TEXT} AS timestamp, pm2_5, temperature AS temp, aqi_category, is_true_anomaly "
        "FROM readings"
    ),
    "q_quality_report": _sql(
        f"""SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {_VALID}) AS n_valid,
  COUNT(*) - COUNT(*) FILTER (WHERE {_VALID}) AS n_rejected,
  COUNT(*) FILTER (WHERE sensor_id IS NULL) AS failed_sensor_id,
  COUNT(*) FILTER (WHERE status IS DISTINCT FROM 'active') AS failed_status,
  COUNT(*) FILTER (WHERE pm2_5 IS NULL OR pm2_5 NOT BETWEEN 0 AND 500) AS failed_pm2_5,
  COUNT(*) FILTER (WHERE pm10 IS NULL OR pm10 NOT BETWEEN 0 AND 600) AS failed_pm10,
  COUNT(*) FILTER (WHERE temperature IS NULL OR temperature NOT BETWEEN -50 AND 60) AS failed_temperature,
  COUNT(*) FILTER (WHERE humidity IS NULL OR humidity NOT BETWEEN 0 AND 100) AS failed_humidity
FROM raw"""
    ),
    "x_event_time": _sql(
        """SELECT row_id, CASE row_id % 6 WHEN 1 THEN event_time - INTERVAL 2 HOURS
  WHEN 2 THEN date_trunc('day', event_time) WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE event_time END AS event_time
FROM raw"""
    ),
    "x_round_numeric": _sql(
        f"SELECT row_id, {_round('pm2_5/3e0', 2)} AS two_digits, {_round('pm2_5/3e0', 1)} AS one_digit FROM raw"
    ),
    "x_heat_index": _sql(f"SELECT row_id, {_HEAT} AS heat_index FROM raw"),
    "x_aqi_category": _sql(f"SELECT row_id, {_AQI} AS aqi_category FROM raw"),
    "x_model_key": _sql(
        """SELECT row_id, 'isolation_forest_' || strftime(event_time, '%Y-%m-%dT%H-%M-%S') || '_to_' ||
  strftime(event_time + INTERVAL 24 HOURS, '%Y-%m-%dT%H-%M-%S') AS model_key FROM raw"""
    ),
    "a_sensor_stats": _sql(f"SELECT {_SHOWN_STATS} FROM stats s", _stats("readings")),
    "a_anomaly_counts": _sql("SELECT * FROM counts", _counts("anomalies")),
    "a_aqi_frequency": _sql("SELECT sensor_id, aqi_category, COUNT(*) AS n FROM readings GROUP BY ALL"),
    "a_dominant_aqi": _sql("SELECT * FROM dominant", _dominant("readings")),
    "j_readings_anomalies": _sql(
        f"SELECT {_SHOWN_STATS}, COALESCE(c.anomaly_count, 0) AS anomaly_count "
        "FROM stats s LEFT JOIN counts c ON s.sensor_id = c.sensor_id",
        _stats("readings"),
        _counts(f"(SELECT * FROM anomalies WHERE {_in_window(AS_OF)}) AS recent"),
    ),
    "j_readings_dominant": _sql(
        f"SELECT {_SHOWN_STATS}, d.dominant_aqi FROM stats s LEFT JOIN dominant d ON s.sensor_id = d.sensor_id",
        _stats("readings"),
        _dominant(f"(SELECT * FROM readings WHERE {_in_window(AS_OF)}) AS recent"),
    ),
    "a_daily_summary": _sql("SELECT * FROM today", *_TODAY),
    "s_stream_once": _sql("SELECT DISTINCT sensor_id, event_time FROM readings"),
    "u_unique_append": _sql(
        "SELECT sensor_id, event_time, MIN(row_id % 2) AS batch_id FROM readings GROUP BY sensor_id, event_time"
    ),
    "s_rolling_summary": _sql(f"SELECT * FROM ({_ROLLING}) AS windows"),
    "a_hourly_partials": _sql(_PARTIALS),
    "a_summary_from_hours": _sql("SELECT * FROM today", *_TODAY),
    "a_summary_off_hour": _sql("SELECT * FROM today", *_OFF_HOUR),
    "a_summary_report": _sql(
        "SELECT sensor_id, summary_date, total_readings, anomaly_count, dominant_aqi FROM today ORDER BY sensor_id",
        *_TODAY,
    ),
    "a_summary_size": _sql("SELECT COUNT(*) AS total_sensors FROM today", *_TODAY),
    "u_summary_upsert": _sql(_KEPT, *_EARLY, *_LATE),
    "u_versioned_upsert": _sql(_KEPT, *_EARLY, *_LATE),
    "s_compacted_readings": _sql(f"SELECT {_READING_COLUMNS} FROM readings"),
    "f_sensor_window": _sql(
        f"SELECT row_id, sensor_id, event_time, pm2_5 FROM readings WHERE sensor_id = '{SENSOR}' "
        f"AND event_time >= TIMESTAMP '{SENSOR_WINDOW[0]}' AND event_time < TIMESTAMP '{SENSOR_WINDOW[1]}'"
    ),
    "d_saved_models": _sql(
        f"""SELECT 'forecast' AS kind, 1 AS version, COUNT(*) AS n_rows, COUNT(*) AS n_outputs, 0 AS n_different
            FROM (SELECT DISTINCT sensor_id, date_trunc('hour', event_time) FROM readings) AS hours
            UNION ALL SELECT 'clusters', 1, COUNT(*), COUNT(*) FILTER (WHERE complete), 0
            FROM (SELECT {" AND ".join(f"COUNT({name}) > 1" for name in _NUMBERS)} AS complete FROM readings GROUP BY sensor_id) AS sensors
            UNION ALL SELECT 'classifier', 1, COUNT(*), COUNT(*) FILTER (WHERE {" AND ".join(f"{name} IS NOT NULL AND NOT isnan(CAST({name} AS DOUBLE))" for name in _NUMBERS)}), 0 FROM readings"""
    ),
    "u_uniqueness_check": _sql(
        "SELECT summary_date, sensor_id, COUNT(*) AS n_rows FROM (SELECT * FROM early UNION ALL SELECT * FROM late) "
        "AS both_runs GROUP BY summary_date, sensor_id HAVING COUNT(*) > 1",
        *_EARLY,
        *_LATE,
    ),
    "g_new_data_ready": _sql(
        f"SELECT CASE WHEN COUNT(*) >= 50 THEN 1 ELSE 0 END AS ready FROM readings "
        f"WHERE event_time >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOURS"
    ),
    "g_summary_ready": _sql("SELECT CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END AS ready FROM today", *_TODAY),
    "g_retrain_needed": _sql(
        "SELECT CASE WHEN moved_features <> '' THEN 1 ELSE 0 END AS retrain, moved_features FROM ("
        f"SELECT concat_ws(',', {_MOVED}) AS moved_features FROM recent r, trained t) AS compared",
        f"recent AS (SELECT {_MOMENTS} FROM readings WHERE {_RECENT})",
        f"trained AS (SELECT {_MOMENTS} FROM readings WHERE {_IN_RANGE})",
    ),
    "m_extract_24h": _sql(f"SELECT row_id, {_NUMBER_LIST} FROM readings WHERE {_RECENT}"),
    "m_extract_range": _sql(f"SELECT row_id, {_NUMBER_LIST} FROM readings WHERE {_IN_RANGE}"),
    "m_validate": _sql(f"SELECT row_id, {_NUMBER_LIST} FROM readings WHERE {_COMPLETE}"),
    "m_validation_counts": _sql(
        f"SELECT COUNT(*) AS n_extracted, COUNT(*) FILTER (WHERE {_COMPLETE}) AS n_valid, "
        f"COUNT(*) - COUNT(*) FILTER (WHERE {_COMPLETE}) AS n_rejected FROM readings"
    ),
    "m_forest_fit": _sql(
        f"""SELECT 'all' AS model_id, * EXCLUDE (threshold, path_length), {_round("threshold", 9)} AS threshold,
            {_round("path_length", 9)} AS path_length FROM f_nodes""",
        *_ALL_FORESTS,
    ),
    "m_forest_score": _sql(f"SELECT row_id, {_round('score', 9)} AS score, prediction FROM f_scores", *_ALL_FORESTS),
    "d_stream_scoring": _sql(
        f"SELECT r.row_id, r.sensor_id, {_round('s.score', 9)} AS score, s.prediction FROM readings r LEFT JOIN f_scores s ON s.row_id = r.row_id",
        *_ALL_FORESTS,
    ),
    "m_forest_health": _sql(f"SELECT {_HEALTH}, threshold FROM ({_judged('f')}) AS counted", *_ALL_FORESTS),
    "m_backfill": _sql(
        " UNION ALL ".join(
            f"SELECT '{_range_key(*bounds)}' AS model_id, {_HEALTH}, threshold FROM ({_judged(f'r{place}')}) AS counted_{place}"
            for place, bounds in enumerate(BACKFILL_RANGES)
        ),
        *_RANGE_FORESTS,
    ),
    "m_health_score": _sql(
        f"SELECT *, {_RATE} AS anomaly_rate, 1e0 - abs(0.05e0 - {_RATE}) AS health_score "
        f"FROM (SELECT source, {_COUNTED} FROM sources GROUP BY source) AS counted",
        _PREDICTIONS,
        _SOURCES,
    ),
    "m_pathological_guard": _sql(
        f"SELECT *, {_RATE} AS anomaly_rate, 1e0 - abs(0.05e0 - {_RATE}) AS health_score, "
        "n_anomalies = 0 OR n_anomalies = n_rows AS pathological FROM (SELECT sensor_id, "
        "date_trunc('hour', event_time) AS hour, COUNT(*) AS n_rows, "
        "COUNT(*) FILTER (WHERE by_rule = -1) AS n_anomalies FROM predictions GROUP BY ALL) AS counted",
        _PREDICTIONS,
    ),
    "m_promotion_history": _sql("SELECT * FROM history", _PREDICTIONS, _SOURCES, _MODELS, _history("models")),
    "m_promotion_decision": _sql(
        "SELECT *, CASE WHEN health_score > champion_score THEN 'promote' ELSE 'keep' END AS decision FROM ("
        "SELECT m.*, COALESCE((SELECT health_score FROM models JOIN current_champion USING (model_id)), 0.9e0) "
        f"AS champion_score FROM models m WHERE created_at > TIMESTAMP '{AS_OF}') AS candidates",
        _PREDICTIONS,
        _SOURCES,
        _MODELS,
        _history(f"(SELECT * FROM models WHERE created_at <= TIMESTAMP '{AS_OF}') AS known"),
        _CURRENT,
    ),
    "m_current_model": _sql(
        "SELECT m.*, c.promoted_at FROM models m JOIN current_champion c USING (model_id)",
        _PREDICTIONS,
        _SOURCES,
        _MODELS,
        _history("models"),
        _CURRENT,
    ),
    "m_model_versions": _sql(
        f"SELECT *, CAST(ROW_NUMBER() OVER ({_BY_AGE}) AS INTEGER) AS version FROM models",
        _PREDICTIONS,
        _SOURCES,
        _MODELS,
    ),
    "m_champion_challenger": _sql(
        """SELECT *, CASE WHEN challenger_health > champion_health THEN 'challenger' ELSE 'champion' END AS better FROM (
  SELECT *, 1e0 - abs(0.05e0 - champion_rate) AS champion_health,
    1e0 - abs(0.05e0 - challenger_rate) AS challenger_health
  FROM (SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE by_rule = by_label) AS n_agreeing,
      CAST(COUNT(*) FILTER (WHERE by_rule = -1) AS DOUBLE) / COUNT(*) AS champion_rate,
      CAST(COUNT(*) FILTER (WHERE by_label = -1) AS DOUBLE) / COUNT(*) AS challenger_rate
    FROM predictions) AS rates) AS scored""",
        _PREDICTIONS,
    ),
    "d_label_eval": _sql(
        f"""SELECT *, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy,
  CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS "precision", CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0) AS recall,
  CAST(2*tp AS DOUBLE) / NULLIF(2*tp + fp + fn, 0) AS f1
FROM (SELECT sensor_id, COUNT(*) FILTER (WHERE flag AND truth) AS tp, COUNT(*) FILTER (WHERE flag AND NOT truth) AS fp,
    COUNT(*) FILTER (WHERE NOT flag AND truth) AS fn, COUNT(*) FILTER (WHERE NOT flag AND NOT truth) AS tn
  FROM (SELECT sensor_id, COALESCE({_FLAG}, FALSE) AS flag, COALESCE({_TRUTH}, FALSE) AS truth FROM readings) AS marked
  GROUP BY sensor_id) AS cells"""
    ),
    "d_hourly_lags": _sql(
        "SELECT sensor_id, hour, n_readings, "
        + ", ".join(f"{_round(name, 6)} AS {name}" for name in ("current", "lag_1", "lag_2", "lag_3", "next_hour"))
        + " FROM lagged",
        *_LAGGED,
    ),
    "d_forecast_persistence": _sql(
        f"SELECT COUNT(*) AS n_hours, {_round('AVG(abs(current - next_hour))', 6)} AS mae, "
        f"{_round('sqrt(AVG((current - next_hour) * (current - next_hour)))', 6)} AS rmse "
        "FROM lagged WHERE next_hour IS NOT NULL",
        *_LAGGED,
    ),
    "d_sensor_profile": _sql(
        f"SELECT sensor_id, COUNT(*) AS n_readings, {_PROFILE}, "
        f"{_round(f'AVG(CASE WHEN {_FLAG} THEN 1e0 ELSE 0e0 END)', 6)} AS anomaly_share FROM readings GROUP BY sensor_id"
    ),
}
