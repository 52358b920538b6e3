"""Date and time expressions. Times are zone-less, whatever the zone of the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month/day/year hour:minute; month, day and hour may have one or two digits.
_LANDING = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{2})$"


def parse_ts_or_iso(c: Column | str) -> Column:
    """Timestamp in the landing format or in ISO; anything else is NULL."""
    # rearranged to ISO and cast without a zone, so no time falls into a gap of the session's zone
    return F.regexp_replace(c, _LANDING, "$3-$1-$2 $4").try_cast("timestamp_ntz")


def parse_ts(c: Column | str) -> Column:
    """Timestamp in the landing format; anything else is NULL."""
    column = F.col(c) if isinstance(c, str) else c
    return F.when(F.contains(column, F.lit("/")), parse_ts_or_iso(column))


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar-day boundaries between two times (23:59 to 00:01 is one day)."""
    return F.datediff(end, start)


def second_diff(start: Column | str, end: Column | str) -> Column:
    """Second boundaries between two times."""
    return F.timestamp_diff("SECOND", F.date_trunc("SECOND", start), F.date_trunc("SECOND", end))
