"""Joins to a side that has one row per key, safe against hot keys on the other side."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys looked for at most, whatever the number of partitions.
_MOST_KEYS = 10_000
# Counters of the heavy-hitter sketch, per key looked for.
_TRACKED = 10


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str) -> list[tuple[str, int]]:
    """Values of ``key`` that hold more rows than a shuffle partition should, with the parts to split them into.

    A key is hot from the mean share of a partition on, so there are at most as many as partitions, and all their parts
    together at most twice as many. A one-pass sketch per task of fixed size finds them: one scan of one
    column and no shuffle by key. A key that the sketch misses or adds changes the speed of a join that uses the list, never its rows.
    """
    partitions = partitions_of(df)
    most = min(partitions, _MOST_KEYS)
    found = df.agg(F.expr(f"approx_top_k(`{key}`, {most}, {most * _TRACKED})").alias("top"), F.count("*").alias("total")).first()
    out = []
    for item, count in found["top"] or ():
        if item is not None and count * partitions > found["total"]:
            out.append((item, math.ceil(count * partitions / found["total"])))
    return out


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: Sequence[str],
    how: str = "left",
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """``left`` with the columns of ``right``, which has at most one row per ``right_key``.

    ``right_key`` is dropped and ``left_key`` comes first; no other names may be shared. Rows of a hot key are split by a hash
    of ``spread_by`` into parts of about a partition's rows, and the one row of that key on the right is copied to each part; NULL
    keys, which match nothing, are spread as well; every other key joins as usual. Hot keys are looked for in the column
    ``left_key`` of ``hot_from``: give a landing or a stored table that has about the same distribution when computing ``left``
    a second time would be expensive. They are found once, before the join is planned, so both sides split
    the same keys.
    """
    spark = left.sparkSession
    partitions = partitions_of(left)
    keys = hot_keys(left if hot_from is None else hot_from, left_key)
    unique_side = right.withColumnRenamed(right_key, left_key)
    # at most one row per partition
    parts = F.broadcast(spark.createDataFrame(keys, f"`{left_key}` {left.schema[left_key].dataType.simpleString()}, _parts int"))
    place = F.when(F.col(left_key).isNull(), F.lit(partitions)).otherwise(F.coalesce("_parts", F.lit(1)))
    salted = left.join(parts, left_key, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), place).cast("int")).drop("_parts")
    every = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    # the arrays are never empty, so outer is the same, and spares a filter on every row
    copies = unique_side.join(parts, left_key, "left").withColumn("_salt", F.explode_outer(every)).drop("_parts")
    return salted.join(copies, [left_key, "_salt"], how).drop("_salt")
