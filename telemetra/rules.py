"""Business rules as data: the one place where limits and labels are written down."""

from __future__ import annotations

# Results depend on these limits and words.
ACTIVE_STATUS = "active"

VALID_RANGES = (
    ("pm2_5", 0, 500),
    ("pm10", 0, 600),
    ("temperature", -50, 60),
    ("humidity", 0, 100),
)

ANOMALY_THRESHOLDS = (
    ("pm2_5", 35.4, "HIGH_PM2_5"),
    ("pm10", 50.0, "HIGH_PM10"),
    ("no2", 85.0, "HIGH_NO2"),
    ("o3", 100.0, "HIGH_O3"),
    ("temperature", 40.0, "EXTREME_TEMP"),
    ("humidity", 85, "HIGH_HUMIDITY"),
)

CRITICAL_THRESHOLDS = (("pm2_5", 150), ("no2", 200))
SEVERITY_CRITICAL = "critical"
SEVERITY_WARNING = "warning"

AQI_UPPER_BOUNDS = (
    (12, "good"),
    (35.4, "moderate"),
    (55.4, "unhealthy_sensitive"),
    (150, "unhealthy"),
)
AQI_ABOVE = "hazardous"
AQI_MISSING = "unknown"

HEAT_INDEX_TEMPERATURE = 1.1
HEAT_INDEX_HUMIDITY = 0.05

SUMMARY_HOURS = 24
TRAINING_HUMIDITY = (0, 100)
MIN_TRAINING_ROWS = 50
CONTAMINATION = 0.05
N_TREES = 100
MAX_SAMPLES = 256
SEED = 42
CHAMPION_SCORE = 0.90
ANOMALY, NORMAL = -1, 1
