"""Queries over the event log and the run log of the layered refresh."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from martwright.functions.times import second_diff
from martwright.sources.logs import DAY


def _since(as_of: dt.datetime | Column | None, interval: str) -> Column:
    if as_of is None:
        return F.localtimestamp() - F.expr(f"INTERVAL {interval}")
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return moment.cast("timestamp_ntz") - F.expr(f"INTERVAL {interval}")


def with_record(events: DataFrame) -> DataFrame:
    """``events`` with the JSON text ``record`` parsed, once and for all; text that is no JSON becomes NULL."""
    return events.withColumn("record", F.try_parse_json("record"))


def _newer(log: DataFrame, time: str, since: Column) -> DataFrame:
    """Rows from ``since`` on. Of a log that is stored by day, only the days asked for are read."""
    newer = log.where(F.col(time) >= since)
    return newer.where(F.col(DAY) >= since.cast("date")) if DAY in log.columns else newer


def recent_logs(
    events: DataFrame, as_of: dt.datetime | Column | None = None, hours: int = 24, n: int = 100
) -> DataFrame:
    """Newest ``n`` log lines of the last ``hours``; the severity comes from ``record``, a VARIANT or its JSON text."""
    if not isinstance(events.schema["record"].dataType, VariantType):
        events = with_record(events)
    return (
        _newer(events, "timestamp", _since(as_of, f"{hours} HOURS"))
        .select(
            "timestamp",
            F.try_variant_get("record", "$.severity_text", "string").alias("severity"),
            F.col("value").cast("string").alias("message"),
        )
        .orderBy(F.desc("timestamp"), "severity", "message")
        .limit(n)
    )


def run_history(
    run_log: DataFrame, as_of: dt.datetime | Column | None = None, days: int = 7, n: int = 100
) -> DataFrame:
    """Newest ``n`` runs scheduled in the last ``days`` with their duration in seconds."""
    return (
        _newer(run_log, "scheduled_time", _since(as_of, f"{days} DAYS"))
        .select(
            "name",
            "state",
            "scheduled_time",
            "completed_time",
            second_diff("scheduled_time", "completed_time").alias("duration_sec"),
            "error_message",
        )
        .orderBy(F.desc("scheduled_time"), "name", "completed_time", "state", "error_message")
        .limit(n)
    )


def failed_runs(run_log: DataFrame) -> DataFrame:
    """Every failed run, newest first."""
    return (
        run_log.where("state = 'FAILED'")
        .select("name", "state", "error_message", "scheduled_time")
        .orderBy(F.desc("scheduled_time"), "name")
    )
