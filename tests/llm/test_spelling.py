"""Spelling variants against brute force: word counts, near words, forms and roots."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martwright.llm import spelling_variants as spelling
from martwright.llm.spelling_variants import near_pairs, near_words, roots, spelling_variants, word_counts

_UPPER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def counted(rows: list[tuple], every: int | None) -> dict[str, int]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(_UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def is_near(a: str, b: str) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def variants(counts: dict[str, int]) -> list[tuple]:
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


VOCABULARY = ["colour", "color", "colours", "cölour", "colouur", "abcde", "abcdf", "xbcde", "abcd", "Émail", "émail", "email", "emails", "aaaaa", "aaaaaa", "aaaaaaa", "zzzzz"]


@pytest.fixture(scope="module")
def rows(edge_rows) -> list[tuple]:
    import random

    random_ = random.Random(9)
    texts = [(5000 + i, " ".join(random_.choices(VOCABULARY, range(1, len(VOCABULARY) + 1), k=60)) + "—×÷ÿ ĀaaaaaĀ") for i in range(40)]
    texts += [(6000 + i, "chaib " + "chain " * 4 + "chainy " * 20) for i in range(6)]
    return edge_rows + texts + [(None, "colour " * 5), (7, ("ab" * 400 + " ") * 3), (8, ("ab" * 200 + "b" + "ab" * 199 + "a ") * 7)]


@pytest.mark.parametrize("every", [None, 2, 97])
def test_word_counts(docs_of, rows, every):
    found = {r.word: r.n for r in word_counts(docs_of(rows), typo_every=every).collect()}
    assert found == counted(rows, every)


def test_counts_of_slices_and_of_full_counters(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(spelling, "_SLICE", 50)
    monkeypatch.setattr(spelling, "_MOST_WORDS", 5)
    text = " ".join(VOCABULARY * 9) + " " + "long" * 40
    batch = pa.RecordBatch.from_arrays([pa.array(["1", "2"]), pa.array([text, ""])], names=["name", "text"])
    got: Counter = Counter()
    for out in spelling._counted(2)(iter([batch])):
        for w, n in zip(out.column("word").to_pylist(), out.column("n").to_pylist(), strict=True):
            got[w] += n
    assert {w: n for w, n in got.items() if len(w) >= 5 and n >= 3} == counted([(1, text), (2, "")], 2)


@pytest.mark.parametrize("block_words", [2, 1024])
def test_variants_equal_brute_force(docs_of, rows, block_words):
    want = variants(counted(rows, 7))
    assert rows_of(spelling_variants(docs_of(rows), typo_every=7, block_words=block_words)) == want
    assert any(r[1] and r[1] != r[2] for r in want)


def test_no_words(docs_of):
    assert spelling_variants(docs_of([])).count() == 0
    assert spelling_variants(docs_of([(1, None), (2, ""), (3, "a b 日本語")])).count() == 0


def test_a_hot_beginning_is_dealt_to_pairs_of_blocks(spark):
    words = [f"abcdef{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    table = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long")
    found = {r.word: (r.n_near, r.best_n, r.best) for r in near_words(table, block_words=40).collect()}
    n = {w: i + 3 for i, w in enumerate(words)}
    for w in words[::37]:
        own = [v for v in words if is_near(w, v)]
        best = min(own, key=lambda v: (-n[v], v))
        assert found[w] == (len(own), n[best], best)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text(alphabet="abÿ", min_size=3, max_size=9), min_size=2, max_size=12))
def test_tiles_hold_each_near_pair_once(words):
    found: Counter = Counter()
    for m in range(3, 11):
        for side in "ps":
            half = m // 2
            members = sorted(w for w in words if len(w) in (m - 1, m))
            for key in {w[:half] if side == "p" else w[-half:] for w in members}:
                own = [w for w in members if (w[:half] if side == "p" else w[-half:]) == key]
                for i, j in zip(*near_pairs([w.encode("latin-1") for w in own], m, side, np.zeros(len(own), int)), strict=True):
                    found[frozenset((own[i], own[j]))] += 1
    assert found == Counter(frozenset((a, b)) for a in words for b in words if a < b and is_near(a, b))


def test_long_chains_of_forms(spark):
    links = [(f"w{i:03}", f"w{i + 1:03}") for i in range(60)] + [("other", "w060")]
    found = {r.word: r.root for r in roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert found == {w: "w060" for w, _ in links}
