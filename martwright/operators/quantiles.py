"""Exact interpolated quantiles that no single task has to hold.

Spark's ``percentile`` and ``median`` keep one count per distinct value of a
group in one task. Here the values are counted first (a hash aggregate with map-side
combine), the counts are summed into ranges of the value domain, the few ranges that
hold a wanted rank are found by a running sum, and only their values are looked at one
by one. A running sum therefore sees at most (domain / ``width``) ranges of a group, and
then at most (``width`` / resolution) values of a range: for cents up to 10**8 and a
width of 1,024 that is about 10**5 each, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, str],
    width: float,
    by: Sequence[str] = (),
) -> DataFrame:
    """``by`` + ``n`` + one decimal column per entry of ``quantiles`` (name -> fraction as text).

    ``value`` is an integer or decimal column; NULLs are not counted. Results are exact decimals, as far as 38 digits
    hold them. Without ``by`` the result is exactly one row. The definition is the continuous
    one: rank ``q * (n - 1)``, linear between the two neighbours.
    """
    by = list(by)
    kind = df.schema[value].dataType
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    # never NULL here; saying so spares the join below a filter, and lets Spark run the
    # counting once for both uses
    value_range = F.coalesce(F.floor(F.col(value).cast("double") / width), F.lit(0)).alias("_range")
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value_range, F.col(value).alias("_value"))
        .agg(F.count("*").alias("_n"))
    )

    in_order = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (
        counted.groupBy(*by, "_range")
        .agg(F.sum("_n").alias("_range_n"))
        .withColumn("_before", F.sum("_range_n").over(in_order) - F.col("_range_n"))
        .withColumn("n", F.sum("_range_n").over(Window.partitionBy(*by)))
    )
    wanted = [rank for q in quantiles.values() for rank in _ranks(q)]
    hits = [(rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_range_n")) for rank in wanted]
    ranges = ranges.where(_any(hits)).drop("_range_n")
    if not by:
        ranges = F.broadcast(ranges)  # two ranks per quantile, so at most 2 * len(quantiles) rows

    in_range = Window.partitionBy(*by, "_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.join(ranges, [*by, "_range"]).withColumn(
        "_start", F.col("_before") + F.sum("_n").over(in_range) - F.col("_n")
    )

    def value_at(rank: Column) -> Column:
        here = (rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_n"))
        return F.max(F.when(here, F.col("_value")))

    neighbours = []
    for name, q in quantiles.items():
        low, high = _ranks(q)
        neighbours += [value_at(low).alias(f"_{name}_low"), value_at(high).alias(f"_{name}_high")]
    picked = ranked.groupBy(*by).agg(F.max("n").alias("n"), *neighbours)
    return picked.select(
        *by, F.coalesce("n", F.lit(0)).alias("n"), *[_between(name, q, scale).alias(name) for name, q in quantiles.items()]
    )


def _position(q: str) -> Column:
    return F.lit(Decimal(q)) * (F.col("n") - 1)


def _ranks(q: str) -> tuple[Column, Column]:
    return F.floor(_position(q)), F.ceil(_position(q))


def _between(name: str, q: str, scale: int) -> Column:
    low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
    digits = max(0, -Decimal(q).as_tuple().exponent)
    fraction = (_position(q) - F.floor(_position(q))).cast(f"decimal({digits + 1},{digits})")
    # so many digits that neither the product nor the sum needs more than 38
    whole = 38 - digits - 4
    step = (high - low).cast(f"decimal({whole},{scale})") * fraction
    exact = low.cast(f"decimal({whole},{scale})") + step
    return exact.cast(f"decimal({min(38, 24 + scale + digits)},{scale + digits})")


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out
