"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots that never change, by id and checksum, so that rows without an id, or
with one id, are spread as well; many rows that are equal in both are dealt to several slots. The bytes of each slot are summed,
and a stored, versioned map says which shard holds a slot. Rebalancing edits the map: it moves whole
slots, as few as it can, and writes the next version; a record's slot stays the same for good.

The law is ``bytes``: the shards' sizes are near equal. A map has one row per slot, so it is small
whatever the data; everything that grows with the data stays in Spark.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm.storage import store

SLOTS = 6144
SHARDS = 24
# Bytes that a record takes besides its text.
RECORD_BYTES = 8
# Rows of equal id and checksum that a slot takes in any case.
_EQUAL_ROWS = 100

Sizes = dict[int, tuple[int, int]]


def records(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS) -> DataFrame:
    """``id, size, text_crc32, virtual_slot`` of each row, written to the shared folder.

    The slot depends on id and checksum alone, but for rows of which so many are equal in both that they would fill a good part of a slot: they
    are dealt to as many slots as that takes, by their place in the written table.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias(id_column),
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = store(rows, "records")
    same = [id_column, "text_crc32"]
    counts = rows.groupBy(*same).agg(F.count("*").alias("n"))
    share = F.greatest(F.lit(_EQUAL_ROWS), F.lit(rows.count()) / (4 * slots))
    # at most four per slot
    equal = F.broadcast(counts.where(F.col("n") > share).select(*(F.col(c).alias(f"_{c}") for c in same), F.ceil(F.col("n") / share).alias("parts")))
    found = rows.join(equal, F.col(id_column).eqNullSafe(F.col(f"_{id_column}")) & (F.col("text_crc32") == F.col("_text_crc32")), "left")
    part = F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0).cast("long"))
    slot = F.pmod(F.xxhash64(id_column, "text_crc32", part), F.lit(slots)).cast("int")
    return found.select(id_column, "size", "text_crc32", slot.alias("virtual_slot"))


def slot_sizes(of: DataFrame) -> Sizes:
    """Rows and bytes of each slot that has any; at most as many entries as there are slots."""
    sums = of.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    return {r["virtual_slot"]: (r["rows"], r["bytes"]) for r in sums.collect()}


def first_map(sizes: Sizes, shards: int = SHARDS, slots: int = SLOTS) -> dict[int, int]:
    """Slot -> shard: the largest slots first, each to the smallest shard so far (then the one with fewest slots)."""
    loads = [(0, 0, shard) for shard in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, (0, 0))[1], s)):
        size, held, shard = heapq.heappop(loads)
        out[slot] = shard
        heapq.heappush(loads, (size + sizes.get(slot, (0, 0))[1], held + 1, shard))
    return out


def rebalanced(old: dict[int, int], sizes: Sizes, shards: int, tolerance: float = 0.01) -> dict[int, int]:
    """``old`` edited for ``shards`` shards and the sizes of today.

    Slots of shards that no longer exist move, and then one slot at a time to the smallest shard, from the largest that is larger
    by more than ``tolerance`` of the mean and has a slot whose move lessens the larger of the two. Every other
    slot stays where it is.
    """
    size = {slot: sizes.get(slot, (0, 0))[1] for slot in old}
    out = dict(old)
    held: list[set[int]] = [set() for _ in range(shards)]
    homeless = []
    for slot, shard in old.items():
        if shard < shards:
            held[shard].add(slot)
        else:
            homeless.append(slot)
    load = [sum(size[s] for s in own) for own in held]

    def move(slot: int, to: int) -> None:
        held[to].add(slot)
        load[to] += size[slot]
        out[slot] = to

    for slot in sorted(homeless, key=lambda s: (-size[s], s)):
        move(slot, min(range(shards), key=lambda k: (load[k], k)))
    slack = tolerance * sum(load) / shards

    def one_move() -> bool:
        least = min(range(shards), key=lambda k: (load[k], k))
        for donor in sorted(range(shards), key=lambda k: (-load[k], k)):
            gap = load[donor] - load[least]
            if gap <= slack:
                return False
            fitting = [s for s in held[donor] if 0 < size[s] < gap]
            if fitting:
                # the slot that comes nearest to halving the gap
                slot = min(fitting, key=lambda s: (abs(gap - 2 * size[s]), s))
                held[donor].remove(slot)
                load[donor] -= size[slot]
                move(slot, least)
                return True
        return False

    while one_move():
        pass
    return out


def save_map(spark: SparkSession, path: str, version: int, slot_map: dict[int, int]) -> None:
    """Add a version of the map to the table at ``path``; versions are never overwritten."""
    rows = [(slot, shard) for slot, shard in sorted(slot_map.items())]
    spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> dict[int, int]:
    """A version of the map, the newest if none is named."""
    table = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return {r["virtual_slot"]: r["shard"] for r in table.where(F.col("version") == version).collect()}


def place(of: DataFrame, slot_map: dict[int, int], sizes: Sizes, id_column: str = "doc_id") -> DataFrame:
    """``records`` with ``shard`` and ``slot``, the place within the shard, gapless from 0.

    Rows are numbered within their virtual slot, and the slots of a shard follow each other, so that no task holds
    more than the rows of some slots. ``sizes`` must be those of ``of``.
    """
    next_free: dict[int, int] = {}
    rows = []
    for slot, shard in sorted(slot_map.items()):
        first = next_free.get(shard, 0)
        rows.append((slot, shard, first))
        next_free[shard] = first + sizes.get(slot, (0, 0))[0]
    # one row per virtual slot: a fixed size
    starts = F.broadcast(of.sparkSession.createDataFrame(rows, "virtual_slot int, shard int, first long"))
    within = Window.partitionBy("virtual_slot").orderBy(id_column, "text_crc32", "size")
    return (
        of.withColumn("number", F.row_number().over(within) - 1)
        .join(starts, "virtual_slot")
        .withColumn("slot", F.col("first") + F.col("number"))
        .drop("first", "number")
    )


def shard_documents(
    docs: DataFrame,
    map_path: str,
    shards: int = SHARDS,
    slots: int = SLOTS,
    id_column: str = "doc_id",
    text_column: str = "text",
    version: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``text_crc32``, ``virtual_slot``, ``shard`` and ``slot``.

    Without ``version`` a first map is made and stored under ``map_path`` as version 0; otherwise
    the stored version is used as it is. Other columns of ``docs`` are not read. A NULL text counts as
    empty and a NULL id is a value like another; rows that repeat an id and a text share a slot, but for many of them, and get a place
    each, in the order of id, checksum and size. No rows give no rows, and a map of even slot counts.
    """
    of = records(docs, id_column, text_column, slots)
    sizes = slot_sizes(of)
    if version is None:
        slot_map, version = first_map(sizes, shards, slots), 0
        save_map(docs.sparkSession, map_path, version, slot_map)
    else:
        slot_map = load_map(docs.sparkSession, map_path, version)
    return place(of, slot_map, sizes, id_column)
