"""Small hand-made inputs."""

from __future__ import annotations

import json
from datetime import datetime

from telemetra import schemas

GOOD = {
    "sensor_id": "a",
    "timestamp": "2024-02-06T09:45:00Z",
    "location": {"lat": 51.5, "lon": 7.25},
    "measurements": {"pm2_5": 17.25, "pm10": 31.5, "no2": 28.75, "o3": 64.5, "temperature": 18.5, "humidity": 52},
    "status": "active",
    "is_true_anomaly": True,
}


def message(**changes) -> dict:
    """A good message; measurement names change the nested value, None removes a field."""
    body = json.loads(json.dumps(GOOD))
    for name, value in changes.items():
        target = body["measurements"] if name in body["measurements"] else body
        if value is None:
            target.pop(name)
        else:
            target[name] = value
    return body


def messages(spark, bodies):
    """Message rows from dicts, raw text, or None."""
    rows = []
    for place, body in enumerate(bodies):
        text = json.dumps(body) if isinstance(body, dict) else body
        rows.append((place, None, None if text is None else bytearray(text, "utf-8")))
    return spark.createDataFrame(rows, "row_id BIGINT, key STRING, value BINARY")


def flat(spark, rows):
    """Flat readings from dicts with only the columns that matter."""
    names = ["row_id", "sensor_id", "event_time", *schemas.FEATURES, "status", "aqi_category", "is_true_anomaly"]
    defaults = {
        "sensor_id": "a", "event_time": datetime(2024, 1, 14, 12), "pm2_5": 10.0, "pm10": 10.0, "no2": 10.0,
        "o3": 10.0, "temperature": 20.0, "humidity": 50, "status": "active", "aqi_category": "good",
        "is_true_anomaly": "false",
    }
    full = [tuple({"row_id": place, **defaults, **row}[name] for name in names) for place, row in enumerate(rows)]
    kinds = (
        "row_id BIGINT, sensor_id STRING, event_time TIMESTAMP, pm2_5 DOUBLE, pm10 DOUBLE, no2 DOUBLE, o3 DOUBLE, "
        "temperature DOUBLE, humidity INT, status STRING, aqi_category STRING, is_true_anomaly STRING"
    )
    return spark.createDataFrame(full, kinds)
