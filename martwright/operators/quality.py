"""Row filters for data quality."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_not_null(df: DataFrame, *names: str) -> DataFrame:
    """Rows where every named column has a value.

    Unlike ``dropna`` these conditions reach a Parquet scan.
    """
    return df.where(reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in names]))


def drop_flagged(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Rows where no flag is true. A NULL flag drops the row, as ``NOT NULL`` is not true."""
    return df.where(~reduce(lambda a, b: a | b, flags.values()))


def chronology_flags(purchase: str, approved: str, carrier: str, delivered: str, estimated: str) -> dict[str, Column]:
    """Conditions under which the times of an order contradict each other."""
    return {
        "is_delivery_before_purchase": F.col(delivered) < F.col(purchase),
        "is_delivery_before_carrier": F.col(delivered) < F.col(carrier),
        "is_approval_before_purchase": F.col(approved) < F.col(purchase),
        "is_estimated_before_purchase": F.col(estimated) < F.col(purchase),
    }
