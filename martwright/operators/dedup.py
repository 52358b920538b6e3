"""Keep-one deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first by ``order_by``.

    Give a total order, or the row kept among equals is arbitrary. The filter on
    row number 1 lets Spark cut every key to one row before the shuffle
    (``WindowGroupLimit``), so a key that holds a large share of the rows sends
    one row per map task, not all of them.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def ascending(*names: str) -> list[Column]:
    """Tie-break columns, NULL last."""
    return [F.asc_nulls_last(name) for name in names]
