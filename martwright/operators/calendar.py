"""Calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.numbers import banded, flag

# First day of the standard calendar, and its quarter labels.
FIRST_DAY = dt.date(2016, 1, 1)
QUARTER_LABELS = {1: "Q1 (Jan-Mar)", 2: "Q2 (Apr-Jun)", 3: "Q3 (Jul-Sep)", 4: "Q4 (Oct-Dec)"}


def _as_date(day: dt.date | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day)


def date_spine(
    spark: SparkSession,
    start: dt.date | Column = FIRST_DAY,
    days: int | None = None,
    as_of: dt.date | Column | None = None,
) -> DataFrame:
    """All dates from ``start`` to ``as_of`` (today by default), at most ``days`` of them if given.

    ``start`` and ``as_of`` are dates or scalar subqueries.
    """
    first, last = _as_date(start), F.current_date() if as_of is None else _as_date(as_of)
    ends = spark.range(1).select(first.cast("date").alias("first"), last.cast("date").alias("last"))
    if days is not None:
        ends = ends.withColumn("last", F.least("last", F.date_add("first", days - 1)))
    # one row per day of a few decades
    return ends.where("first <= last").select(F.explode(F.sequence("first", "last")).alias("date_id"))


def with_calendar(df: DataFrame, day: str = "date_id") -> DataFrame:
    """Calendar attributes of a date column; ``week_of_year`` is the ISO week."""
    quarter = F.quarter(day)
    return df.select(
        "*",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week_of_year"),
        quarter.alias("quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.date_format(day, "yyyy-'Q'Q").alias("year_quarter"),
        F.dayname(day).alias("day_name"),
        F.monthname(day).alias("month_name"),
        flag(F.weekday(day) >= 5).alias("is_weekend"),
        banded([(quarter == n, F.lit(label)) for n, label in QUARTER_LABELS.items()], None).alias("quarter_label"),
    )


def date_dimension(
    spark: SparkSession,
    start: dt.date | Column = FIRST_DAY,
    days: int | None = None,
    as_of: dt.date | Column | None = None,
) -> DataFrame:
    return with_calendar(date_spine(spark, start, days, as_of))
