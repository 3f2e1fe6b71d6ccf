"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the engine's settings to a session builder."""
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    return builder


def pin_utc(spark: SparkSession) -> SparkSession:
    """Zone-less event times are UTC, so text and literals must be read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


class NoSharedFolder(RuntimeError):
    """Executors on several machines need a folder that all of them see."""


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table, below a folder that all executors share.

    That is the one the session names in ``spark.checkpoint.dir``, or else its warehouse, and no setting of the session is
    changed. A warehouse in a machine's own files is no such folder unless all executors run in this one process.
    """
    named, warehouse = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir")
    if named is None and warehouse.startswith(("/", "file:")) and not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
        raise NoSharedFolder(f"set spark.checkpoint.dir: {warehouse} is a folder of one machine")
    root = named or f"{warehouse}/_intermediate"
    return f"{root.rstrip('/')}/telemetra/{name}-{uuid.uuid4().hex}"
