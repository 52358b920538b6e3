"""Words that differ by one edit, grouped under their most frequent spelling.

Two words are near if one code point inserted, deleted or replaced makes one the other. With a longer length of ``m``, that is
so if and only if the lengths of their common prefix and common suffix add up to ``m - 1`` at least. One of the two then covers half of
the word, so near words of longer length ``m`` share their first or their last ``m // 2`` code points: words are dealt into
groups by either half. In a group, words are rows of dense matrices of code points, padded on the right for prefixes and on
the left for suffixes; a tile compares every word of one block with every word of another, column by column.

A group with more words than a block holds is cut into blocks, and each pair of its blocks is a tile of its own, wherever it
runs. So a task holds two blocks at a time, whatever the group; that is exact, and a word is copied once per block of its group.
A tile yields one row for each word with near words in it, not the pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.storage import small_batches, store

LEAST_LENGTH = 5
LEAST_COUNT = 3
# A word's form has at least this many times its occurrences.
RATIO = 2
# Words, and code points, of a block.
BLOCK_WORDS = 1024
BLOCK_POINTS = 1 << 20

# Latin-1 letters as they are, A-Z in lower case, all else a blank
_LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 0xC0 else 32 for i in range(256))
# Code points of a text that are taken apart at a time, and different words that a task counts before it passes the counts on.
_SLICE = 1 << 20
_MOST_WORDS = 200_000

_TILE = ["m", "side", "key", "i", "j"]
_FOUND = "word string, n_near long, best_n long, best string"


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in parts that end where no run does."""
    start = 0
    while len(text) - start > _SLICE:
        end = text.find(b" ", start + _SLICE)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def _digests(words: list[bytes], start: int) -> Iterator[int]:
    """CRC-32 of the words in UTF-8, each continued from ``start``."""
    utf8 = words if all(map(bytes.isascii, words)) else [w if w.isascii() else w.decode("latin-1").encode() for w in words]
    return map(crc32, utf8, repeat(start))


def misspelled(word: bytes, digest: int) -> bytes:
    """``word`` less its code point number ``digest % length``."""
    place = digest % len(word)
    return word[:place] + word[place + 1 :]


def _counted(typo_every: int | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            found = [(w, n) for w, n in counts.items() if n and w]
            counts.clear()
            words = pa.array([w.decode("latin-1") for w, _ in found], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array([n for _, n in found], pa.int64())], names=["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
                start = crc32(f"{name}:".encode())
                # words in Latin-1, where a byte is a code point
                for part in _slices(text.encode("latin-1", "replace").translate(_LETTERS)):
                    runs = part.split()
                    counts.update(runs)
                    if typo_every:
                        different = list(set(runs))
                        digests = zip(different, _digests(different, start), strict=True)
                        for word, digest in [x for x in digests if not x[1] % typo_every]:
                            n = runs.count(word)
                            counts[word] -= n
                            counts[misspelled(word, digest)] += n
                    if len(counts) > _MOST_WORDS:
                        yield out()
        yield out()

    return rows


def word_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", typo_every: int | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """``word, n``: the runs of letters (A-Z, a-z, U+00C0 to U+00FF) of all texts, A-Z in lower case, and their occurrences.

    Kept are words of ``least_length`` code points and ``least_count`` occurrences at least. With ``typo_every``, runs are misspelled first:
    where it divides h, the CRC-32 of ``<id>:<run>``, code point h % length is left out (NULL ids are empty there). NULL and
    empty texts have no words; rows that repeat count each; no rows give no words.
    """
    small_batches(docs.sparkSession)
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    counted = docs.select(name.alias("name"), text.alias("text")).mapInArrow(_counted(typo_every), "word string, n long")
    long_enough = counted.where(F.length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _padded(words: list[bytes], lengths: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points by column, flush left and flush right; 0 beyond a word."""
    points = np.frombuffer(b"".join(words), np.uint8)
    row = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left, right = (np.zeros((m, len(words)), np.uint8) for _ in range(2))
    left[place, row] = points
    right[place + np.repeat(m - lengths, lengths), row] = points
    return left, right


def _common(a: np.ndarray, b: np.ndarray, columns: range) -> np.ndarray:
    """Number of leading ``columns`` in which rows of ``a`` and of ``b`` agree, for all pairs."""
    shape = a.shape[1], b.shape[1]
    same, equal = np.ones(shape, bool), np.empty(shape, bool)
    total = np.zeros(shape, np.uint8 if len(columns) < 256 else np.int32)
    for c in columns:
        np.equal(a[c][:, None], b[c][None, :], out=equal)
        same &= equal
        total += same.view(np.uint8)
        # long words: most pairs have parted by here
        if c % 16 == 15 and not same.any():
            break
    return total


def near_pairs(words: list[bytes], m: int, side: str, block: np.ndarray, apart: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places of near words of longer length ``m`` in one tile, each pair once.

    ``words`` are in Latin-1, of ``m`` or ``m - 1`` code points, and share their first (``side`` "p") or last ("s") ``m // 2``, columns that need
    no look. Those of two blocks (``apart``) meet across blocks only. Pairs that share the first half are left to the group of prefixes.
    """
    lengths = np.array([len(w) for w in words])
    left, right = _padded(words, lengths, m)
    full, half = lengths == m, m // 2
    out = []
    for b in np.unique(block):
        rows = np.flatnonzero(full & (block == b))
        columns = np.flatnonzero(block != b) if apart else np.arange(len(words))
        if not (len(rows) and len(columns)):
            continue
        ahead, behind = (range(half, m), range(m - 1, half, -1)) if side == "p" else (range(half), range(m - 1 - half, -1, -1))
        prefix = _common(left[:, rows], left[:, columns], ahead)
        suffix = _common(right[:, rows], right[:, columns], behind)
        # the half that is shared, and at least one column of the rest less
        near = prefix >= (m - 1 - half) - np.minimum(suffix, m - 1 - half)
        if side == "s":
            near &= prefix < half
        # of two words of full length the first meets the second, not the other way round
        near &= ~full[columns][None, :] | (rows[:, None] < columns[None, :])
        i, j = np.nonzero(near)
        out.append((rows[i], columns[j]))
    empty = np.empty(0, np.int64)
    return tuple(np.concatenate([empty, *(x[k] for x in out)]) for k in (0, 1))


def _tile(words: list[str], n: np.ndarray, m: int, side: str, block: np.ndarray, apart: bool) -> list[tuple]:
    """Words of a tile, in code point order, that have near words in it: their number, and the most frequent (the first of equals)."""
    i, j = near_pairs([w.encode("latin-1") for w in words], m, side, block, apart)
    if not len(i):
        return []
    own, other = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((other, -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    counts = np.diff(np.append(first, len(own)))
    return [(words[w], int(k), int(n[b]), words[b]) for w, k, b in zip(own[first], counts, other[first], strict=True)]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in (*_TILE, "word", "n", "block")), strict=True)

    found: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [()] * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["word", "n_near", "best_n", "best"])

    for (m, side, _, one, other), own in groupby(rows(), key=lambda r: r[:5]):
        words, n, block = zip(*(r[5:] for r in own), strict=True)
        if len(words) > 1:
            found += _tile(words, np.array(n), m, side, np.array(block), one != other)
        if len(found) > 10_000:
            yield out()
            found.clear()
    yield out()


def _halves() -> F.Column:
    """The groups of a word: by its first and its last half, as the longer (or equal) and as the shorter word of a pair."""
    word, length = F.col("word"), F.length("word")
    groups = []
    for m in (length, length + 1):
        half = F.floor(m / 2).cast("int")
        for side, start in (("p", F.lit(1)), ("s", -half)):
            key = F.substring(word, start, half)
            groups.append(F.struct(m.alias("m"), F.lit(side).alias("side"), key.alias("key")))
    return F.array(*groups)


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS, block_points: int = BLOCK_POINTS) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have near words: how many, and the most frequent of them.

    ``words`` has ``word`` (unique; of the letters that ``word_counts`` takes, two at least) and ``n``. Of equally frequent words the first in
    code point order is taken.
    """
    small_batches(words.sparkSession)
    members = words.select(F.explode(_halves()).alias("g"), "word", "n").select("g.*", "word", "n")
    keys = ["m", "side", "key"]
    full = (F.length("word") == F.col("m")).cast("int")
    sizes = members.groupBy(*keys).agg(F.count("*").alias("size"), F.sum(F.length("word")).alias("points"), F.max(full).alias("full"))
    blocks = F.ceil(F.greatest(F.col("size") / block_words, F.col("points") / block_points)).cast("int")
    sizes = sizes.where("size > 1 AND full = 1").select(*keys, blocks.alias("blocks"))
    dealt = members.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(*keys, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "word", "n", "block")
    found = dealt.repartition(*_TILE).sortWithinPartitions(*_TILE, "word").mapInArrow(_tiles, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the last of the words that forms lead to.

    A form has twice the occurrences of its word, so chains have at most 63 links; each round doubles the links that are
    followed, and is written to the shared folder.
    """
    found = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = store(found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if found.where("moved").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", typo_every: int | None = None, ratio: int = RATIO, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per word of ``docs`` (see ``word_counts``): ``word, form, root, n, n_near, form_n``.

    ``form`` is the most frequent near word, if it occurs ``ratio`` times as often as the word at least (two times at least), else NULL; ``root`` is where
    forms lead in the end, the word itself if it has none. Only the two columns named are read; rows or texts without words, or an empty table, add none.
    """
    words = store(word_counts(docs, id_column, text_column, typo_every), "words")
    near = near_words(words, block_words)
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    formed = store(formed, "formed")
    out = formed.join(roots(formed.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
