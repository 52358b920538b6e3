"""Best-fit packing of token sequences by minimum bin slack.

A bin starts with the longest piece left; a subset-sum over the lengths still available, done on bit sets,
finds the fullest way to fill the rest, and those pieces are removed. Only lengths decide, and there are
at most ``capacity`` of them, so bins are made from the histogram of lengths: a way to fill a bin is used as often
as its lengths last, and each search uses up a length. The histogram, and the list of ways, stay small whatever
the data. Pieces find their bin by their rank among the pieces of their length, which
Spark computes in parts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.encoding import TOKENIZER, Encoder
from martwright.llm.recurring import NO_ID, keyed
from martwright.llm.storage import released, small_batches, store

CAPACITY = 2048
END_ID = 0
# Rows of one length that are numbered together.
PART_ROWS = 2000

# (length, first rank, bin of the first rank, pieces of the length in a bin, their place in the bin)
Run = tuple[int, int, int, int, int]


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, with how many of each, whose sum comes nearest to ``room`` from below."""
    reached, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:  # 1, 2, 4, ... pieces at once reach every number of them
            many = min(part, left)
            after = (reached | reached << (many * length)) & mask
            if after != reached:
                steps.append((length, many, reached))
                reached = after
            left, part = left - many, part * 2
        if reached >> room & 1:
            break
    target = reached.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, many, before in reversed(steps):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + many
            target -= many * length
    return chosen


def pack(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Runs that place every piece, and the number of bins."""
    left = {length: n for length, n in histogram.items() if n}
    used = dict.fromkeys(left, 0)
    runs: list[Run] = []
    bins = 0
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        chosen = fullest({n: k for n, k in rest.items() if k}, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[length] // many for length, many in chosen.items())
        place = 0
        for length, many in sorted(chosen.items(), reverse=True):
            runs.append((length, used[length], bins, many, place))
            place += many * length
            used[length] += times * many
            left[length] -= times * many
            if not left[length]:
                del left[length]
        bins += times
    return runs, bins


def _pieces(tokenizer: str, capacity: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], []]
            for i, text in zip(batch.column("_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encoder.ids(text), END_ID).astype("<u4")
                # all pieces but the first are full
                edges = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for piece, (start, end) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    row = (i, piece, start, end - start, zlib.crc32(ids[start:end].tobytes()))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["_id", "piece", "start", "length", "ids_crc32"]
            )

    return rows


def _placed(runs: list[Run]):
    by_length: dict[int, list[np.ndarray]] = {}
    for length in {r[0] for r in runs}:
        by_length[length] = [np.array(c) for c in list(zip(*sorted(r for r in runs if r[0] == length), strict=True))[1:]]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for value in np.unique(length):
                own = np.flatnonzero(length == value)
                first, bin_, many, place = by_length[int(value)]
                run = np.searchsorted(first, rank[own], "right") - 1
                nth = rank[own] - first[run]
                sequence[own] = bin_[run] + nth // many[run]
                offset[own] = place[run] + nth % many[run] * value
            keep = ["_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"]
            )

    return rows


def pack_documents(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is its token ids and an end id; only one longer than ``capacity`` is cut, so that all pieces but its first are full.
    Other columns of ``docs`` are not read. A NULL text is empty and so is one end id; rows that repeat are
    packed each; a NULL id stays NULL. No rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    schema = "_id long, piece int, start long, length long, ids_crc32 long"
    pieces = store(keyed(docs, id_column, text_column).mapInArrow(released(_pieces(tokenizer, capacity)), schema), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = pack(histogram, capacity)

    # rank of a piece among those of its length: parts of them are counted, then numbered
    parts = max(64, sum(histogram.values()) // part_rows)
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("_id", "start"), F.lit(parts)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("length", "part")
        .count()
        .select("length", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("length", "part").orderBy("_id", "start", "ids_crc32")
    ranked = (
        dealt.withColumn("number", F.row_number().over(within) - 1)
        .join(before, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("number"))
        .select("_id", "piece", "start", "length", "ids_crc32", "rank")
    )
    placed = ranked.mapInArrow(released(_placed(runs)), f"{schema}, sequence_id long, offset long")
    return placed.withColumn("_id", F.nullif("_id", F.lit(NO_ID))).withColumnRenamed("_id", id_column)
