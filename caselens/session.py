"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "caselens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Skip the per-expression Python stack capture: plans here are long.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Durations are epoch differences, so the session zone must not have DST."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
