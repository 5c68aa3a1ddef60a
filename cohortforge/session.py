"""Session settings this library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(name: str = "cohortforge", **more: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map={**SETTINGS, **more}).getOrCreate()
