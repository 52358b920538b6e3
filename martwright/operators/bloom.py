"""Bloom filters of join keys, for the scan of the other side of a join.

Spark builds such filters itself, but only where statistics of files tell it that the scan is large and the other side selective. Here the filter is
asked for: a bit set in 64-bit words, built and tested with plain expressions. It reaches the scan as a scalar subquery, and its size comes
from the number of keys, counted in the same query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits per key, each key setting two: about one other key in 20 passes.
BITS = 8
# Words of a filter at most (8 MB), and bits per key below which a filter passes too much to be worth its scan.
MOST_WORDS = 1 << 20
LEAST_BITS = 2


@dataclass
class BloomFilter:
    """``words``: an array of 64-bit words, NULL where the keys are too many for a filter."""

    words: Column

    def passes(self, key: str | Column) -> Column:
        """False only for keys that are not in; NULL is none of them."""
        size = F.size(self.words).cast("long")
        tests = [F.getbit(F.element_at(self.words, (F.floor(place / 64) + 1).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1 for place in _places(key, size)]
        return F.col(key).isNotNull() & (self.words.isNull() | tests[0] & tests[1])


def _places(key: str | Column, words: Column) -> tuple[Column, Column]:
    """The two bits of a key among those of all words."""
    first = F.xxhash64(key)
    return F.pmod(first, words * 64), F.pmod(F.xxhash64(first, F.lit(1)), words * 64)


def bloom_filter(keys: DataFrame, key: str, bits: int = BITS, most_words: int = MOST_WORDS) -> BloomFilter:
    """Filter of the values of ``key``, which may repeat; nothing runs before the query that uses it.

    With more keys than ``most_words`` hold at ``LEAST_BITS`` each there is no filter, and everything passes: what tasks get stays bounded.
    """
    n = keys.agg(F.count(key)).scalar()
    words = F.least(F.lit(most_words).cast("long"), F.greatest(F.lit(1).cast("long"), F.ceil(n * bits / 64)))
    fits = n * LEAST_BITS <= most_words * 64
    places = keys.where(F.col(key).isNotNull() & fits).select(F.explode(F.array(*_places(key, words))).alias("place"))
    set_bits = places.select(F.floor(F.col("place") / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int")).alias("bits"))
    # every word has a row, so that a word's number is its place
    spark = keys.sparkSession
    none = spark.range(1, numPartitions=1).select(F.explode(F.sequence(F.lit(0).cast("long"), words - 1)).alias("word"), F.lit(0).cast("long").alias("bits"))
    merged = set_bits.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"])
    return BloomFilter(merged.agg(F.when(fits, in_order)).scalar())
