"""Number expressions: safe casts, clamps and class labels."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """Decimal rounded half-up to ``scale``; text that is no number, or too large, is NULL."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def to_number(c: Column | str) -> Column:
    """Number as the text has it, to 18 decimals, to compare or to round once; anything else is NULL."""
    return to_decimal(c, 38, 18)


def to_int(c: Column | str) -> Column:
    """Integer rounded half-up (``'1.5'`` is 2, ``'1.0'`` is 1); anything else is NULL."""
    # plain digits, by far the most common, need no decimal arithmetic
    return F.coalesce(_col(c).try_cast("int"), F.round(to_number(c), 0).try_cast("int"))


def clamp(c: Column, low: Any, high: Any) -> Column:
    """Values outside ``low..high`` move to the nearer bound; NULL stays NULL."""
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def clamp_positive(c: Column, floor: Any, high: Any) -> Column:
    """Zero and negative values become ``floor``, values above ``high`` become ``high``.

    Unlike ``clamp`` a value between 0 and ``floor`` is kept.
    """
    return F.when(c <= 0, F.lit(floor)).when(c > high, F.lit(high)).otherwise(c)


def banded(cases: Sequence[tuple[Column, Any]], default: Any) -> Column:
    """Label of the first true condition, else ``default`` (also when all are NULL)."""
    (first, label), *rest = cases
    out = F.when(first, label)
    for condition, label in rest:
        out = out.when(condition, label)
    return out.otherwise(default)


def flag(condition: Column) -> Column:
    """Two-valued flag: a NULL condition counts as false."""
    return F.when(condition, True).otherwise(False)


def safe_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """Rounded quotient, NULL where the denominator is zero."""
    return F.round(numerator / F.nullif(denominator, F.lit(0)), scale)
