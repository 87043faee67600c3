"""A session with the settings the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC days, errors instead of silent overflow, plans that adapt to what the shuffles carry.
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}


def session(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName("causeway")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
