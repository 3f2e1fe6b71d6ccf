"""Sensor telemetry analytics on Spark: streaming ETL, daily summaries and an anomaly model."""
