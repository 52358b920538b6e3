"""Substring deduplication by automata of repeated phrases.

Passages of at least ``window`` words that occur more than once are confirmed by counting their
windows; the confirmed passages of a shard are compiled into an Aho-Corasick automaton over words,
and every document's stretch of text that can hold one is streamed through the automaton of its shard, which
locates every occurrence. A passage and all stretches that can hold it share a leader (see
``rolling``), and shards are by leader, so one pass through one automaton finds all.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.recurring import NO_ID, Words, keyed, merged, recurring_spans, runs_of, texts_of, with_spans
from martwright.llm.rolling import Rolling, WordHashes

WINDOW = 35
GRAM = 8


class _Locate:
    """Spans of blocks covered by passages that the same blocks confirm."""

    def __init__(self, window: int):
        self.window = window

    def __call__(self, leaders: list[int], blocks: list[bytes]) -> list[list[tuple[int, int]]]:
        rows: dict[bytes, list[int]] = {}
        for row, block in enumerate(blocks):
            rows.setdefault(block, []).append(row)
        texts = [block.split() for block in rows]
        passages = self._confirmed(texts, [leaders[r[0]] for r in rows.values()], [len(r) for r in rows.values()])

        numbers: dict[bytes, int] = {}
        sequences = [tuple(numbers.setdefault(w, len(numbers)) for w in words) for words in texts]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for sequence, spans in zip(sequences, passages, strict=True):
            for start, end in spans:
                automaton.add_word(sequence[start:end], end - start)
        found: list[list[tuple[int, int]]] = [[] for _ in blocks]
        if len(automaton):
            automaton.make_automaton()
            for sequence, same in zip(sequences, rows.values(), strict=True):
                spans = merged([{"start": last + 1 - n, "end": last + 1} for last, n in automaton.iter(sequence)])
                for row in same:
                    found[row] = spans
        return found

    def _confirmed(self, texts: list[list[bytes]], leaders: list[int], times: list[int]) -> list[list[tuple[int, int]]]:
        """Maximal runs of windows that occur more than once, of each text."""
        word_hashes = WordHashes()
        windows = [Rolling(word_hashes.of(words)).every(self.window) for words in texts]
        counts = [len(w) for w in windows]
        hashes = np.concatenate(windows)
        leader = np.repeat(np.array(leaders, np.int64), counts)
        order = np.lexsort((hashes, leader))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (leader[order[1:]] != leader[order[:-1]])
        group = np.cumsum(new) - 1
        total = np.bincount(group, np.repeat(times, counts)[order])
        often = np.empty(len(order), bool)
        often[order] = total[group] > 1
        return [runs_of(mask, self.window) for mask in np.split(often, np.cumsum(counts)[:-1])]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, all_spans, kept = [], [], [], []
        for text, spans in zip(texts_of(batch), batch.column("spans").to_pylist(), strict=True):
            words = text.split()
            runs = merged(spans)
            n_words.append(len(words))
            n_removed.append(sum(end - start for start, end in runs))
            all_spans.append([{"start": start, "end": end} for start, end in runs])
            for start, end in reversed(runs):
                del words[start:end]
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(all_spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["_id", "n_words", "n_removed", "spans", "kept_text"],
        )


def remove_repeated_phrases(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM, **limits: int
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_removed``, ``spans`` (word ranges removed) and ``kept_text``.

    Words stand between ASCII white space. Every word covered by a run of ``window`` words that also starts anywhere else,
    in the same document or another, is removed; all occurrences go. Other columns of ``docs`` are not read,
    whatever their names. A NULL or blank text has no words and keeps an empty text; texts shorter
    than the window lose nothing; rows that repeat, with their id or under another, are copies of each
    other; a NULL id stays NULL. No rows give no rows. ``limits``: see ``recurring_spans``.
    """
    texts = keyed(docs, id_column, text_column)
    spans = recurring_spans(texts, Words, window, gram, _Locate(window), whole_blocks=False, **limits)
    kept = with_spans(texts, spans).mapInArrow(
        _kept, "_id long, n_words long, n_removed long, spans array<struct<start: int, end: int>>, kept_text string"
    )
    return kept.withColumn("_id", F.nullif("_id", F.lit(NO_ID))).withColumnRenamed("_id", id_column)
