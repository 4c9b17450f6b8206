"""SparkSession with the settings that the engine's semantics and plans assume."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "thermaquilt", **settings: str) -> SparkSession:
    """UTC, ANSI arithmetic, adaptive execution with skew joins; further settings by keyword with __ for dots."""
    conf = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.parquet.aggregatePushdown": "true"}
    conf |= {k.replace("__", "."): v for k, v in settings.items()}
    return SparkSession.builder.appName(app).config(map=conf).getOrCreate()
