"""Where windows of words or bytes recur, anywhere in a table of documents.

Shared by the two substring operators. Each document is cut into blocks (see ``rolling``) by
content alone, so equal windows lie in blocks with equal leaders. Leaders are counted over
all documents with map-side combination and joined back to the blocks that have them, a
join that adaptive execution can split at a hot leader. Only blocks with a leader that
occurs elsewhere are looked at further:

* equal blocks, when all blocks of a leader are equal: they recur as a whole;
* other blocks go, as content, to the task that owns their leader, where the operator's
  own structure (``locate``) finds what recurs;
* leaders with more than ``group_rows`` blocks would overfill a task. Their windows
  are counted as rows of (leader, window hash), which combine before they are shuffled.

Window hashes are compared under equal leaders only, so two different windows count as equal only where
two independent 64-bit hashes agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.rolling import BYTE_HASHES, Rolling, WordHashes, blocks
from martwright.llm.storage import small_batches, store

# id given to rows without one, inside these operators only
NO_ID = -(2**63)
KEY = ["_id", "_h"]
# Blocks of one leader that one task may hold; at some hundred bytes each, a few MB.
GROUP_ROWS = 5000
# Bytes of blocks that one structure is built for, above which the next leader starts a new one.
CHUNK_BYTES = 2_000_000

# leaders and contents of blocks -> spans of each block
Locate = Callable[[list[int], list[bytes]], list[list[tuple[int, int]]]]


class Words:
    """Units are words between ASCII white space."""

    def __init__(self):
        self._hashes = WordHashes()

    def units(self, text: bytes) -> list[bytes]:
        return text.split()

    def hashes(self, units: list[bytes]) -> np.ndarray:
        return self._hashes.of(units)

    def content(self, units: list[bytes], start: int, end: int) -> bytes:
        return b" ".join(units[start:end])


class Bytes:
    """Units are the bytes of the UTF-8 text."""

    def units(self, text: bytes) -> bytes:
        return text

    def hashes(self, units: bytes) -> np.ndarray:
        return BYTE_HASHES[np.frombuffer(units, np.uint8)]

    def content(self, units: bytes, start: int, end: int) -> bytes:
        return units[start:end]


def _key(id_column: str, text: Column) -> dict[str, Column]:
    return {"_id": F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)), "_h": F.xxhash64(text)}


def keyed(docs: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    """``_id, _h, text``: never NULL; equal rows have equal keys, other rows that share an id have not. ``more`` columns may follow."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(*(c.alias(name) for name, c in _key(id_column, text).items()), text.alias("text"), *more)


def with_key(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the key that ``keyed`` gives its rows."""
    return docs.withColumns(_key(id_column, F.coalesce(F.col(text_column).cast("string"), F.lit(""))))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _block_rows(unit: type, window: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = unit()
        for batch in batches:
            found, counts = [], []
            for text in texts_of(batch):
                found.append(blocks(kind.hashes(kind.units(text)), window, gram))
                counts.append(len(found[-1][0]))
            leader, first, last, content, repeats = (np.concatenate(x) for x in zip(*found, strict=True))
            owner = np.repeat(np.arange(batch.num_rows), counts)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k).take(pa.array(owner)) for k in KEY),
                    pa.array(_signed(leader)),
                    pa.array(_signed(content)),
                    pa.array(first.astype(np.int32)),
                    pa.array(last.astype(np.int32)),
                    pa.array(repeats),
                ],
                names=[*KEY, "leader", "content", "first", "last", "repeats"],
            )

    return rows


def _contents(unit: type, window: int):
    """Content of the wanted blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = unit()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for i, h, text, wanted in zip(
                batch.column("_id").to_pylist(), batch.column("_h").to_pylist(), texts_of(batch), batch.column("blocks").to_pylist(), strict=True
            ):
                units = kind.units(text)
                for b in wanted:
                    row = (b["leader"], i, h, b["first"], kind.content(units, b["first"], b["last"] + window))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["leader", *KEY, "first", "block"]
            )

    return rows


def _window_rows(unit: type, window: int):
    """Hash of every window of the wanted blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = unit()
        for batch in batches:
            for row, text in enumerate(texts_of(batch)):
                hashes = Rolling(kind.hashes(kind.units(text))).every(window)
                wanted = batch.column("blocks")[row].as_py()
                starts = [np.arange(b["first"], b["last"] + 1) for b in wanted]
                leader = np.repeat([b["leader"] for b in wanted], [len(s) for s in starts]).astype(np.int64)
                start = np.concatenate(starts)
                n = len(start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(leader),
                        pa.array(_signed(hashes[start])),
                        *(pa.array(np.full(n, batch.column(k)[row].as_py())) for k in KEY),
                        pa.array(start.astype(np.int32)),
                    ],
                    names=["leader", "hash", *KEY, "start"],
                )

    return rows


def _located(locate: Locate, chunk_bytes: int):
    """Spans that ``locate`` finds in rows sorted by leader; all blocks of a leader reach it together."""

    def spans_of(rows: list[tuple]) -> pa.RecordBatch:
        found = locate([r[0] for r in rows], [r[4] for r in rows])
        out: list[list[int]] = [[], [], [], []]
        for (_, i, h, first, _), spans in zip(rows, found, strict=True):
            for start, end in spans:
                for column, value in zip(out, (i, h, first + start, first + end), strict=True):
                    column.append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[*KEY, "start", "end"]
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, leader = 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("leader", *KEY, "first", "block")), strict=True):
                if row[0] != leader and size >= chunk_bytes:
                    yield spans_of(held)
                    held, size = [], 0
                leader = row[0]
                held.append(row)
                size += len(row[4])
        if held:
            yield spans_of(held)

    return rows


def recurring_spans(
    texts: DataFrame,
    unit: type,
    window: int,
    gram: int,
    locate: Locate,
    whole_blocks: bool,
    keep_first: bool = False,
    group_rows: int = GROUP_ROWS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``_id, _h, start, end``: spans of units covered by windows that recur; their union is what recurs.

    ``texts`` comes from ``keyed``. ``locate`` gets the leaders and contents of blocks, in the order of their
    documents within a leader, and returns the spans of each block. With ``whole_blocks`` a leader
    whose blocks are all equal needs no ``locate``; otherwise those go to it too. With
    ``keep_first`` the first place of a window, by id and position, is left out.
    """
    spark = texts.sparkSession
    small_batches(spark)
    schema = "_id long, _h long, leader long, content long, first int, last int, repeats boolean"
    found = store(texts.mapInArrow(_block_rows(unit, window, gram), schema), "blocks")

    counted = found.groupBy("leader").agg(
        F.count("*").alias("n"),
        (F.min("content") == F.max("content")).alias("equal"),
        F.max("repeats").alias("repeats"),
        *([F.min(F.struct(*KEY, "first")).alias("earliest")] if keep_first else []),
    )
    counted = counted.where("n > 1 OR repeats").select(
        "leader",
        *(["earliest"] if keep_first else []),
        F.when(F.col("equal") & ~F.col("repeats") & F.lit(whole_blocks), "whole")
        .when(F.col("n") > group_rows, "counted")
        .otherwise("located")
        .alias("way"),
    )
    wanted = store(found.drop("content", "repeats").join(counted, "leader"), "recurring")

    def with_text(way: str) -> DataFrame:
        per_document = wanted.where(F.col("way") == way).groupBy(*KEY).agg(F.collect_set(F.struct("leader", "first", "last")).alias("blocks"))
        return texts.join(per_document.select(*(F.coalesce(k, F.lit(0)).alias(k) for k in KEY), "blocks"), KEY)

    block_rows = with_text("located").mapInArrow(_contents(unit, window), "leader long, _id long, _h long, first int, block binary")
    located = (
        block_rows.repartition("leader")
        .sortWithinPartitions("leader", *KEY, "first")
        .mapInArrow(_located(locate, chunk_bytes), "_id long, _h long, start int, end int")
    )
    spans = located
    if whole_blocks:
        whole = wanted.where("way = 'whole'")
        if keep_first:
            whole = whole.where(F.struct(*KEY, "first") != F.col("earliest"))
        whole = whole.select(*KEY, F.col("first").alias("start"), (F.col("last") + window).alias("end"))
        spans = spans.unionByName(whole)
    if not wanted.where("way = 'counted'").isEmpty():
        windows = with_text("counted").mapInArrow(_window_rows(unit, window), "leader long, hash long, _id long, _h long, start int")
        often = windows.groupBy("leader", "hash").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "start")).alias("earliest"))
        counted_spans = windows.join(often.where("n > 1").drop("n"), ["leader", "hash"])
        if keep_first:
            counted_spans = counted_spans.where(F.struct(*KEY, "start") != F.col("earliest"))
        spans = spans.unionByName(counted_spans.select(*KEY, "start", (F.col("start") + window).alias("end")))
    return spans


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``texts`` with ``spans``, an array of its recurring spans or NULL."""
    per_document = spans.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    per_document = per_document.select(*(F.coalesce(k, F.lit(0)).alias(k) for k in KEY), "spans")
    return texts.join(per_document, KEY, "left")


def runs_of(mask: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Spans covered by the windows whose starts are set in ``mask``."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [(int(a), int(b) - 1 + window) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of a list of spans, in order."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs
