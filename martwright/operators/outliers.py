"""Interquartile-range outlier fences over a whole column."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.operators.quantiles import exact_quantiles


def iqr_bounds(df: DataFrame, value: str, width: float, k: str = "1.5") -> DataFrame:
    """One row ``q1, q3, iqr, lower_bound, upper_bound`` over the non-null values.

    All in exact decimals, so that a value equal to a bound compares as equal.
    ``width`` is that of ``exact_quantiles``.
    """
    quartiles = exact_quantiles(df, value, {"q1": "0.25", "q3": "0.75"}, width)
    iqr = (F.col("q3") - F.col("q1")).alias("iqr")
    step = F.lit(Decimal(k)) * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        "q1", "q3", iqr, (F.col("q1") - step).alias("lower_bound"), (F.col("q3") + step).alias("upper_bound")
    )


def fence(bounds: DataFrame) -> tuple[Column, Column]:
    """Lower and upper bound of a one-row ``iqr_bounds`` frame as columns for any other frame.

    They are scalar subqueries: the row is computed once and reaches the tasks as a constant.
    """
    row = bounds.select(F.struct("lower_bound", "upper_bound").alias("fence")).scalar()
    return row["lower_bound"], row["upper_bound"]


def keep_inside(df: DataFrame, value: str, bounds: DataFrame) -> DataFrame:
    """Rows whose value lies inside the fence, bounds included; NULL is dropped."""
    low, high = fence(bounds)
    return df.where(F.col(value).between(low, high))


def outside_flag(value: str, bounds: DataFrame) -> Column:
    """True for a value strictly outside the fence."""
    low, high = fence(bounds)
    return (F.col(value) < low) | (F.col(value) > high)
