"""Substring deduplication by longest-previous-factor arrays over suffix arrays.

The bytes that can recur are cut out by leaders (see ``recurring``); all places of a byte string share
a leader, so the blocks of some leaders are a text of their own. For that text the suffixes are sorted,
up to ``window`` bytes, by prefix tripling: ranks of 8 bytes give ranks of 24, of 72 and so on.
In suffix order, the nearest suffixes on both sides that start earlier in the text give
the longest previous factor of each position: the longer of the prefixes that it has in common with those two, up to ``window``
bytes. Prefixes of neighbours are measured down the same ranks, and the least on the way holds for two further apart. Where its length is ``window``, the string has occurred before.
The nearest ones that start later tell, in the same way, whether it occurs again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.recurring import NO_ID, Bytes, keyed, merged, recurring_spans, runs_of, texts_of, with_spans

WINDOW = 200
GRAM = 32
# Sorting is fastest on texts that fit the processor's cache. Three ranks of a text of under 2 ** 21 bytes fit a key.
TEXT_BYTES = 300_000
_FIRST = 8
_RANK_BITS = 21
# Least values of 1, 2, ... 8 bytes.
_BYTE_STEPS = np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks: equal keys have equal ranks, smaller ones smaller ranks."""
    order = np.argsort(keys)
    new = np.ones(len(keys), np.int64)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(new) - 1
    return ranks


def _nearest_smaller(values: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the nearest one before it with a smaller value, or -1, and the least of ``common`` on the way, or 0.

    ``common`` is what a place has in common with the one before it.
    """
    near = np.arange(len(values)) - 1
    least = common.copy()
    open_ = np.flatnonzero(near >= 0)
    while len(open_):
        open_ = open_[values[near[open_]] > values[open_]]
        # all values between are larger than the one passed, hence larger than this one
        passed = near[open_]
        least[open_] = np.minimum(least[open_], least[passed])
        near[open_] = near[passed]
        open_ = open_[near[open_] >= 0]
    least[near < 0] = 0
    return near, least


class Ranks:
    """Ranks of the 8, 24, 72 ... and ``window`` bytes at each place of a text, by prefix tripling.

    ``room``: bytes from a place to the end of its block. A rank is ``-1`` where a block ends sooner. Needs a window of 24 bytes
    at least.
    """

    def __init__(self, text: np.ndarray, room: np.ndarray, window: int):
        self.room, self.window = room, window
        length = _FIRST
        padded = np.concatenate((text, np.zeros(_FIRST - 1, np.uint8)))
        self.keys = np.lib.stride_tricks.sliding_window_view(padded, _FIRST).copy().view(">u8").ravel().astype(np.uint64)
        exact = len(text) < 2**_RANK_BITS
        ranks = np.full(len(text), -1, np.int64)
        places = np.flatnonzero(room >= length)
        ranks[places] = _ranks(self.keys[places])
        self.levels = [(length, ranks.astype(np.int32))]
        while length < window:
            longer = min(3 * length, window)
            places = places[room[places] >= longer]
            a, b, c = ranks[places], ranks[places + (longer - length) // 2], ranks[places + longer - length]
            ranks = np.full(len(text), -1, np.int64)
            if exact:
                ranks[places] = _ranks((a << 2 * _RANK_BITS) | (b << _RANK_BITS) | c)
            else:  # a group of very long blocks: two steps, each of two ranks
                ranks[places] = _ranks((_ranks((a << 31) | b) << 31) | c)
            length = longer
            self.levels.append((length, ranks.astype(np.int32)))

    def of_windows(self) -> np.ndarray:
        return self.levels[-1][1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the prefix that the places ``a`` and ``b`` have in common, within their blocks and up to ``window``."""
        found = np.zeros(len(a), np.int64)
        # the whole window first; below, what is left is less than three times as long as a level
        (_, whole), *shorter = reversed(self.levels)
        left = np.flatnonzero(whole[a] != whole[b])
        found[whole[a] == whole[b]] = self.window
        for length, ranks in shorter:
            going = left
            for _ in range(2):
                x, y = a[going] + found[going], b[going] + found[going]
                # a block may end here, so that its next place is no longer its own
                room = np.minimum(self.room[a[going]], self.room[b[going]]) - found[going]
                going = going[room >= length][ranks[x[room >= length]] == ranks[y[room >= length]]]
                found[going] += length
        room = np.minimum(self.room[a[left]], self.room[b[left]]) - found[left]
        left, room = left[room > 0], room[room > 0]
        differ = self.keys[a[left] + found[left]] ^ self.keys[b[left] + found[left]]
        equal = _FIRST - np.searchsorted(_BYTE_STEPS, differ, "right")
        found[left] += np.minimum(equal, room)
        return found


def previous_factors(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest previous factors of the places in ``order``, sorted by their suffixes, which have prefixes of length ``common`` with the place before.

    Previous are smaller values of ``order``; with negative places, the factor of each is the longest that starts later.
    """
    _, before = _nearest_smaller(order, common)
    _, after = _nearest_smaller(order[::-1], np.concatenate(([0], common[:0:-1]))[: len(order)])
    return np.maximum(before, after[::-1])


class _Locate:
    def __init__(self, window: int, keep_first: bool):
        self.window, self.keep_first = window, keep_first

    def __call__(self, leaders: list[int], blocks: list[bytes]) -> list[list[tuple[int, int]]]:
        rows: dict[bytes, list[int]] = {}
        for row, block in enumerate(blocks):
            rows.setdefault(block, []).append(row)
        sizes = np.array([len(block) for block in rows])
        text = np.frombuffer(b"".join(rows), np.uint8)
        ends = np.cumsum(sizes)
        room = np.repeat(ends, sizes) - np.arange(len(text))
        matched = self._previous(text, room)

        found: list[list[tuple[int, int]]] = [[] for _ in blocks]
        for mask, block, same in zip(np.split(matched, ends[:-1]), rows, rows.values(), strict=True):
            own = runs_of(mask, self.window)
            whole = [(0, len(block))] if len(same) > 1 else own
            for row in same:
                found[row] = whole
            if self.keep_first:
                found[same[0]] = own
        return found

    def _previous(self, text: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Where the window at a place has an earlier match; without ``keep_first`` also a later one."""
        ranks = Ranks(text, room, self.window)
        starts = np.flatnonzero(room >= self.window)
        order = starts[np.lexsort((starts, ranks.of_windows()[starts]))]
        common = np.zeros(len(order), np.int64)
        common[1:] = ranks.common(order[1:], order[:-1])
        matched = np.zeros(len(text), bool)
        for places in (order, -order)[: 1 if self.keep_first else 2]:
            matched[order[previous_factors(places, common) == self.window]] = True
        return matched


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_bytes, n_removed, all_spans, kept = [], [], [], []
        for text, spans in zip(texts_of(batch), batch.column("spans").to_pylist(), strict=True):
            runs = merged(spans)
            edges = [0, *(place for run in runs for place in run), len(text)]
            n_bytes.append(len(text))
            n_removed.append(sum(end - start for start, end in runs))
            all_spans.append([{"start": start, "end": end} for start, end in runs])
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"),
                pa.array(n_bytes, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(all_spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(kept, pa.binary()),
            ],
            names=["_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def remove_repeated_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    keep_first: bool = False,
    **limits: int,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``spans`` (byte ranges removed) and ``kept`` (binary).

    Texts are taken as UTF-8. Every byte covered by a string of ``window`` bytes that also starts anywhere else, in the same
    document or another, is removed; with ``keep_first`` its first place, by id and then by position, stays (rows
    equal in id and text count as one place there). Other columns of ``docs`` are not read, whatever their names. A NULL
    text is empty; texts shorter than the window lose nothing; rows that repeat are copies of each other; a
    NULL id stays NULL and sorts first. No rows give no rows. ``limits``: see ``recurring_spans``.
    """
    texts = keyed(docs, id_column, text_column)
    limits.setdefault("chunk_bytes", TEXT_BYTES)
    locate = _Locate(window, keep_first)
    spans = recurring_spans(texts, Bytes, window, gram, locate, whole_blocks=True, keep_first=keep_first, **limits)
    kept = with_spans(texts, spans).mapInArrow(
        _kept, "_id long, n_bytes long, n_removed long, spans array<struct<start: int, end: int>>, kept binary"
    )
    return kept.withColumn("_id", F.nullif("_id", F.lit(NO_ID))).withColumnRenamed("_id", id_column)
