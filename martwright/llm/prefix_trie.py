"""The prefix trie of rebuilt conversations, from weighted sequences.

A conversation is rebuilt as the first turns of an original and its own turns after as many. A node of the trie is a distinct beginning of
rebuilt conversations. Identical conversations are collapsed first, into one sequence with a weight (their number) and a list of their ids; only
the turns of sequences, one conversation each, are looked at further. A sequence that another one continues is dropped by an anti-join;
the others are the leaves. A node then sums over the sequences that begin with it.

Sums over the subtree of a node need no walk: of all turns of a node's members at its depth or below, those are saved that another
member with a smaller id has too. A sequence's turns that no smaller id has begin at one depth, so what it saves below any
depth follows from two running sums of bytes.

A turn is known by 120 bits of the SHA-256 of its role and text, a beginning by the XOR of two 64-bit hashes of its turns and their
places. XOR combines in any order, so a long conversation is cut into cells, by ranges of its turns: each cell is a window of its own,
and what comes before it is added afterwards. Ids with the longest sequences, beginnings that all conversations share, and
sequences that a third of them have are summed with map-side combination; lists of ids are hashed as streams of sorted parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.storage import small_batches, store

# Conversations whose beginnings are shared, and number that the turns taken from the original are below.
FAMILY = 5
FIRST_TURNS = 9
_EMPTY = hashlib.sha256().hexdigest()
# Bytes of a part of a list of ids.
PART_BYTES = 1 << 18

_SEQUENCE = ["a", "b", "length"]
_NODE = ["a", "b", "depth"]


@dataclass
class Trie:
    """``nodes``: see ``prefix_trie``; ``sequences``: hashes, length, smallest id and number of the identical conversations; ``ends``: their ids, in parts."""

    nodes: DataFrame
    sequences: DataFrame
    ends: DataFrame


def original(conv: Column) -> Column:
    """The conversation that ``conv`` takes its first turns from: the remainder has the sign of the id."""
    return conv - conv % FAMILY


def first_turns(conv: Column) -> Column:
    return (F.crc32(conv.cast("string")) % FIRST_TURNS).cast("int")


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, cell, at, x, y, bytes``: every turn by its place ``at`` in its conversation.

    Rows are sorted over all tasks by conversation and turn, so that a task has a range of them, the cell; places are counted in the cell
    and the turns of earlier cells are added.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), role_.alias("role"), text_.alias("text"))
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    x, y = (F.conv(F.substring(digest, start, 15), 16, 10).cast("long") for start in (1, 16))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    rows = rows.where("conv IS NOT NULL").repartitionByRange("conv", *order)
    # the order among equal turns is settled here, so that texts need not be kept
    rows = rows.sortWithinPartitions("conv", *order).select(
        "conv", F.spark_partition_id().alias("cell"), F.monotonically_increasing_id().alias("row"), x.alias("x"), y.alias("y"), F.octet_length("text").cast("long").alias("bytes")
    )
    rows = store(rows, "turns")
    within = F.row_number().over(Window.partitionBy("conv", "cell").orderBy("row")) - 1
    rows = rows.repartition("conv", "cell").withColumn("within", within)
    before = _before(rows.groupBy("conv", "cell").agg(F.count("*").alias("n")), n=F.sum)
    return rows.join(before, ["conv", "cell"], "left").select(
        "conv", "cell", (F.col("within") + F.coalesce("n", F.lit(0))).alias("at"), "x", "y", "bytes"
    )


def _before(cells: DataFrame, **totals) -> DataFrame:
    """Of each cell that is not its conversation's first: the totals of the conversation's earlier cells.

    A task's range of rows begins within one conversation at most, so there are at most as many such cells as there were tasks.
    """
    several = cells.groupBy("conv").agg(F.count("*").alias("cells")).where("cells > 1").select("conv")
    earlier = Window.partitionBy("conv").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    found = cells.join(several, "conv", "left_semi").select("conv", "cell", *(f(c).over(earlier).alias(c) for c, f in totals.items()))
    return F.broadcast(found.where(F.col(next(iter(totals))).isNotNull()))


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations, and ``conv, cell, at, g, h, bytes`` of their rebuilt turns."""
    own = turns.groupBy("conv").agg(F.count("*").alias("n"), F.min("cell").alias("first_cell"))
    own = own.select("conv", "n", "first_cell", original(F.col("conv")).alias("base"), first_turns(F.col("conv")).alias("take"))
    lengths = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = own.join(lengths, "base", "left").select("conv", "base", "take", "first_cell", F.least("take", F.coalesce("base_n", F.lit(0))).alias("taken"))
    convs = store(convs, "conversations")
    beginnings = turns.where(F.col("at") < FIRST_TURNS - 1).select(F.col("conv").alias("base"), "at", "x", "y", "bytes")
    begun = convs.join(beginnings, "base").where("at < take").select("conv", F.col("first_cell").alias("cell"), "at", "x", "y", "bytes")
    rest = turns.join(convs.select("conv", "take", "taken"), "conv").where("at >= take")
    rest = rest.select("conv", "cell", (F.col("at") - F.col("take") + F.col("taken")).alias("at"), "x", "y", "bytes")
    g, h = F.xxhash64("at", "x", "y"), F.xxhash64("y", "at", "x")
    rebuilt = begun.unionByName(rest).select("conv", "cell", F.col("at").cast("long").alias("at"), g.alias("g"), h.alias("h"), "bytes")
    return convs, store(rebuilt, "rebuilt")


def _beginnings(rebuilt: DataFrame, sequences: DataFrame) -> DataFrame:
    """``conv, a, b, depth, up_a, up_b, bytes, above``: the beginnings of one conversation of each sequence, that above it, and the bytes above."""
    rows = rebuilt.join(sequences.select("conv"), "conv", "left_semi").repartition("conv", "cell")
    so_far = Window.partitionBy("conv", "cell").orderBy("at")
    rows = rows.select("*", *(f(c).over(so_far).alias(n) for n, c, f in (("in_g", "g", F.bit_xor), ("in_h", "h", F.bit_xor), ("in_bytes", "bytes", F.sum))))
    totals = rebuilt.join(sequences.select("conv"), "conv", "left_semi").groupBy("conv", "cell")
    totals = totals.agg(F.bit_xor("g").alias("off_g"), F.bit_xor("h").alias("off_h"), F.sum("bytes").alias("off_bytes"))
    rows = rows.join(_before(totals, off_g=F.bit_xor, off_h=F.bit_xor, off_bytes=F.sum), ["conv", "cell"], "left")
    zero = F.lit(0).cast("long")
    a = F.col("in_g").bitwiseXOR(F.coalesce("off_g", zero))
    b = F.col("in_h").bitwiseXOR(F.coalesce("off_h", zero))
    above = F.col("in_bytes") + F.coalesce("off_bytes", zero) - F.col("bytes")
    return rows.select("conv", a.alias("a"), b.alias("b"), (F.col("at") + 1).alias("depth"), a.bitwiseXOR(F.col("g")).alias("up_a"), b.bitwiseXOR(F.col("h")).alias("up_b"), "bytes", above.alias("above"))


def _parts(most: int):
    """Sorted ids of each sequence, joined to parts of about ``most`` bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size, found, held = None, None, [], 0, [], 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [()] * 5
            types = [pa.int64()] * 4 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*_SEQUENCE, "first", "ids"])

        for batch in batches:
            for *own, conv in zip(*(batch.column(c).to_pylist() for c in (*_SEQUENCE, "conv")), strict=True):
                if own != key or size > most:
                    if ids:
                        found.append((*key, first, ",".join(ids)))
                        held += size
                    key, first, ids, size = own, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if held > 16 * PART_BYTES:
                yield out()
                found, held = [], 0
        if ids:
            found.append((*key, first, ",".join(ids)))
        yield out()

    return rows


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the parts of each sequence, which come one after the other."""
    columns = [*_SEQUENCE, "ids"]
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
    found = []
    for key, own in groupby(rows, key=lambda r: r[:3]):
        digest, comma = hashlib.sha256(), b""
        for row in own:
            digest.update(comma + row[3].encode())
            comma = b","
        found.append((*key, digest.hexdigest()))
        if len(found) >= 10_000:
            yield _hash_batch(found)
            found = []
    yield _hash_batch(found)


def _hash_batch(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [()] * 4
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*_SEQUENCE, "ends_sha256"])


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_bytes: int = PART_BYTES) -> Trie:
    """The trie of all rebuilt conversations, one row per node.

    ``conv_id`` smallest member, ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs`` members, ``n_children``, ``n_leaves`` below (a leaf has itself),
    ``saved_tokens`` bytes of turns below that are there more than once, ``ends_sha256`` of the sorted ids of the conversations that end there.

    Turns are ordered by number, NULL first, then role and text, so that rows that repeat are turns that repeat. NULL roles and texts are empty. Rows
    without a conversation belong to none and are left out. Of an empty table there is no node, not even the root. Other columns aren't read.
    """
    small_batches(conversations.sparkSession)
    convs, rebuilt = _rebuilt(_turns(conversations, conv, turn, role, text))
    totals = rebuilt.groupBy("conv").agg(F.bit_xor("g").alias("a"), F.bit_xor("h").alias("b"), F.count("*").alias("length"), F.sum("bytes").alias("total"))
    zero = F.lit(0).cast("long")
    ended = convs.select("conv").join(totals, "conv", "left").select("conv", *(F.coalesce(c, zero).alias(c) for c in (*_SEQUENCE, "total")))
    ended = store(ended, "ended")

    # whole sequences, each with its weight and the conversation that stands for it
    sequences = store(ended.groupBy(*_SEQUENCE).agg(F.min("conv").alias("conv"), F.count("*").alias("weight"), F.max("total").alias("total")), "sequences")
    beginnings = store(_beginnings(rebuilt, sequences), "beginnings")
    proper = beginnings.select(F.col("up_a").alias("a"), F.col("up_b").alias("b"), (F.col("depth") - 1).alias("length"))
    leaves = sequences.join(proper, _SEQUENCE, "left_anti").select("conv", F.lit(1).alias("leaf"))

    # the smallest member of a node, and from which depth on a sequence is it
    weighted = beginnings.join(sequences.select("conv", "weight", "total"), "conv")
    smallest = store(beginnings.groupBy(*_NODE).agg(F.min("conv").alias("conv_id")), "smallest")
    new = beginnings.join(smallest, _NODE).where("conv = conv_id").groupBy("conv").agg(F.min("above").alias("new_above"))
    facts = store(sequences.select("conv", "total").join(new, "conv", "left").join(leaves, "conv", "left").select(
        "conv", F.coalesce("new_above", "total").alias("new_above"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf")), "facts")
    saved = F.col("weight") * (F.col("total") - F.col("above")) - (F.col("total") - F.greatest("above", "new_above"))
    nodes = weighted.join(facts, "conv").groupBy(*_NODE).agg(
        F.min("conv").alias("conv_id"),
        F.min("up_a").alias("up_a"),
        F.min("up_b").alias("up_b"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(saved).alias("saved_tokens"),
    )
    # the root, which every sequence begins with
    root = sequences.join(facts, "conv").agg(
        F.min("conv").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * F.col("total") - (F.col("total") - F.col("new_above"))).alias("saved_tokens"),
    )
    none = F.lit(None).cast("long")
    root = root.where("conv_id IS NOT NULL").select(zero.alias("a"), zero.alias("b"), zero.alias("depth"), none.alias("up_a"), none.alias("up_b"), "conv_id", "n_convs", "n_leaves", "saved_tokens")
    nodes = store(nodes.select(root.columns[:3] + ["up_a", "up_b", "conv_id", "n_convs", "n_leaves", "saved_tokens"]).unionByName(root), "nodes")

    above_key = [F.col("up_a").alias("a"), F.col("up_b").alias("b"), (F.col("depth") - 1).alias("depth")]
    children = nodes.where("depth > 0").groupBy(*above_key).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    ends = ended.repartitionByRange(*_SEQUENCE, "conv").sortWithinPartitions(*_SEQUENCE, "conv").select(*_SEQUENCE, "conv")
    ends = store(ends.mapInArrow(_parts(part_bytes), "a long, b long, length long, first long, ids string"), "ends")
    hashed = ends.repartition(*_SEQUENCE).sortWithinPartitions(*_SEQUENCE, "first").mapInArrow(_hashed, "a long, b long, length long, ends_sha256 string")
    out = nodes.join(children, _NODE, "left").join(hashed.withColumnRenamed("length", "depth"), _NODE, "left").join(parents, ["up_a", "up_b", "depth"], "left")
    return Trie(
        out.select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        ),
        sequences,
        ends,
    )
