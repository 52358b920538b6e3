"""Spark session with the settings the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Every setting is a plain, documented Spark option.
RECOMMENDED = {
    # wall-clock columns are zone-less, so parsing must not meet a DST gap
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # call sites of every column expression double the time to build a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # per-order set aggregates see far more than the default 128 groups per task
    # before they would fall back to sorting
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def build_session(app_name: str = "martwright", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with ``RECOMMENDED`` plus ``conf``; the master comes from spark-submit or ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
