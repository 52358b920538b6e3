"""Rolling hashes of word or byte sequences, and the blocks that their local minima cut.

A window of ``window`` units contains ``window - gram + 1`` grams. The smallest gram hash of
a window, its leader, depends on the content of the window alone, so equal windows have equal
leaders wherever they stand. Consecutive windows with one leader form a block; a document
of random text has one block for about ``(window - gram) / 2`` windows.
"""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15
_WORD = 2**64
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

BYTE_HASHES = np.array([xxhash.xxh3_64_intdigest(bytes([i])) for i in range(256)], np.uint64)


class WordHashes(dict):
    """Hash of a word; the words seen are kept up to ``most``, then forgotten."""

    most = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 4096)
        factors = np.full(size, _BASE, np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors)
        factors[1:] = pow(_BASE, -1, _WORD)
        _inverses = np.cumprod(factors)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes, so that their order is as good as random."""
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of all slices of one sequence of unit hashes."""

    def __init__(self, units: np.ndarray):
        powers, self._inverses = _tables(len(units) + 1)
        self._sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * powers[: len(units)], out=self._sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverses[starts])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all slices of one length, in order."""
        n = len(self._sums) - length
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self._sums[length:] - self._sums[:n]) * self._inverses[:n])


def _sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        values = best(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def blocks(units: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(leader, first, last, content, repeats)`` of each block of a sequence.

    ``first`` and ``last`` are the starts of its first and last window; ``content`` is a hash of
    all its units, ``units[first : last + window]``. A block with ``repeats`` holds its leader
    more than once, so a window can occur twice inside it; in any other block none can.
    """
    if len(units) < window:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(np.uint64), none.astype(bool)
    width = window - gram + 1
    rolling = Rolling(units)
    grams = rolling.every(gram)
    least = _sliding(np.minimum, grams, width)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.append(first[1:], len(least)) - 1
    leader = least[first]
    content = rolling.slices(first, last + window) + (last - first).astype(np.uint64) * np.uint64(_BASE)

    # a gram is a leader where it equals the largest of the minima of the windows that hold it
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    places = np.flatnonzero(grams == _sliding(np.maximum, around, width))
    values = grams[places]
    new = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    repeats = np.diff(np.append(new, len(values))) > 1
    return leader, first, last, content, repeats
