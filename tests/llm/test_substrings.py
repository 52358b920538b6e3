"""Repeated words and bytes against a count of every window."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martwright.llm.longest_previous_factor import Ranks, _Locate, _nearest_smaller, previous_factors, remove_repeated_bytes
from martwright.llm.phrase_automata import remove_repeated_phrases
from martwright.llm.rolling import blocks

WAYS = [{}, {"group_rows": 1}, {"chunk_bytes": 500}]


def expected(rows, units_of, window, joint):
    units = [units_of((text or "").encode()) for _, text in rows]
    counts = Counter(tuple(u[i : i + window]) for u in units for i in range(len(u) - window + 1))
    out = []
    for (doc_id, _), u in zip(rows, units, strict=True):
        gone = [False] * len(u)
        for i in range(len(u) - window + 1):
            if counts[tuple(u[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = joint.join(x if isinstance(x, bytes) else bytes([x]) for x, g in zip(u, gone, strict=True) if not g)
        out.append((doc_id, len(u), sum(gone), kept))
    return sorted(out, key=str)


def content(rows):
    return sorted(((r[0], r[1], r[2], bytes(r[3], "utf8") if isinstance(r[3], str) else bytes(r[3])) for r in rows), key=str)


@pytest.mark.parametrize("limits", WAYS)
def test_repeated_words(docs_of, edge_rows, limits):
    found = remove_repeated_phrases(docs_of(edge_rows), **limits).select("doc_id", "n_words", "n_removed", "kept_text")
    assert content(found.collect()) == expected(edge_rows, bytes.split, 35, b" ")


@pytest.mark.parametrize("limits", WAYS)
def test_repeated_bytes(docs_of, edge_rows, limits):
    found = remove_repeated_bytes(docs_of(edge_rows), **limits).select("doc_id", "n_bytes", "n_removed", "kept")
    assert content(found.collect()) == expected(edge_rows, lambda b: b, 200, b"")


@pytest.mark.parametrize("limits", WAYS)
def test_first_copy_can_stay(docs_of, limits):
    passage = "".join(random.Random(9).choices("abcdefgh", k=260))
    rows = [(1, "one " + passage), (2, passage + " two"), (3, passage + passage[:210])]
    found = {r.doc_id: (r.n_removed, bytes(r.kept).decode()) for r in remove_repeated_bytes(docs_of(rows), keep_first=True, **limits).collect()}
    assert found[1] == (0, "one " + passage)
    assert found[2] == (260, " two")
    assert found[3] == (470, "")


def test_no_rows(docs_of):
    assert remove_repeated_phrases(docs_of([])).count() == 0
    assert remove_repeated_bytes(docs_of([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=30, max_size=200))
def test_blocks_cover_all_windows_once(values):
    leader, first, last, _, repeats = blocks(np.array(values, np.uint64) + np.uint64(17), 12, 4)
    assert first[0] == 0 and last[-1] == len(values) - 12
    assert (first[1:] == last[:-1] + 1).all() and (leader[1:] != leader[:-1]).all()
    for a, b, again in zip(first, last, repeats, strict=True):
        windows = [tuple(values[i : i + 12]) for i in range(a, b + 1)]
        assert again or len(set(windows)) == len(windows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=60))
def test_nearest_smaller(values):
    common = np.arange(len(values)) % 7 + 1
    near, least = _nearest_smaller(np.array(values, np.int64), common)
    for i, v in enumerate(values):
        assert near[i] == next((j for j in range(i - 1, -1, -1) if values[j] <= v), -1)
        assert least[i] == (min(common[near[i] + 1 : i + 1]) if near[i] >= 0 else 0)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=26, max_size=90).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=5))
def test_window_ranks_order_as_the_windows_do(texts):
    text = np.frombuffer(b"".join(texts), np.uint8)
    sizes = [len(t) for t in texts]
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(text))
    ranks = Ranks(text, room, 26).of_windows()
    windows = {i: text[i : i + 26].tobytes() for i in np.flatnonzero(room >= 26)}
    places = list(windows)
    assert np.array_equal(np.unique([windows[i] for i in places], return_inverse=True)[1], ranks[places])
    assert (ranks[room < 26] == -1).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=30, max_size=120).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=5), st.sampled_from([24, 30, 80]))
def test_longest_previous_factors(texts, window):
    texts = [t for t in [*texts, texts[0][3:] + b"x" * 30, bytes(90)] if len(t) >= window]
    text = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    room = np.repeat(ends, [len(t) for t in texts]) - np.arange(len(text))
    ranks = Ranks(text, room, window)
    starts = np.flatnonzero(room >= window)
    order = starts[np.lexsort((starts, ranks.of_windows()[starts]))]
    between = np.concatenate(([0], ranks.common(order[1:], order[:-1]))) if len(order) else order
    own = {i: text[i : i + min(window, room[i])].tobytes() for i in starts}

    def common(a, b):
        return next((k for k in range(window) if own[a][k] != own[b][k]), window)

    for places, others in ((order, np.less), (-order, np.greater)):
        found = dict(zip(order.tolist(), previous_factors(places, between).tolist(), strict=True))
        assert found == {i: max((common(i, j) for j in starts[others(starts, i)]), default=0) for i in starts.tolist()}


def test_common_prefixes_end_with_their_blocks():
    text = np.frombuffer(b"ab" * 50, np.uint8)
    room = np.concatenate((np.arange(41, 0, -1), np.arange(59, 0, -1)))
    found = Ranks(text, room, 30).common(np.array([0, 0, 38, 39]), np.array([2, 1, 42, 43]))
    assert found.tolist() == [30, 0, 3, 2]


def test_locate_marks_both_copies():
    block = bytes(range(200)) + bytes(range(50))
    assert _Locate(200, False)([1, 1], [block, b"xx" + block]) == [[(0, 250)], [(2, 252)]]
    assert _Locate(200, True)([1, 1], [block, b"xx" + block]) == [[], [(2, 252)]]
