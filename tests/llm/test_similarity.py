"""Exact and near duplicates, and contamination, against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from martwright.llm.components import components
from martwright.llm.divide_skip import _blocks_of, _crowded_groups, _frequent_rows, divide_skip, near_duplicates
from martwright.llm.streaming_dedup import exact_duplicates, extend_state, read_state
from martwright.llm.storage import new_folder, store
from martwright.llm.winnowing import contamination

A_Z = {c: c + 32 for c in range(65, 91)}


def linked(x: frozenset, y: frozenset, percent: int) -> bool:
    both = len(x & y)
    return bool(x) and bool(y) and 100 * both >= percent * (len(x) + len(y) - both)


def brute_components(rows, size, percent):
    sets = []
    for _, text in rows:
        ws = (text or "").encode().lower().split()
        n = min(size, len(ws))
        sets.append(frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) if ws else frozenset())
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                root[find(i)] = find(j)
                links[i] += 1
                links[j] += 1
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        key = (doc_id is not None, doc_id or 0)
        smallest[find(i)] = min(smallest.get(find(i), key), key)
    return [(d, len(s), (lambda k: k[1] if k[0] else None)(smallest[find(i)]), links[i]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def variants(n: int, seed: int, first_id: int, edits: int = 7) -> list[tuple]:
    random_ = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(50)]
    base = [random_.choice(vocabulary) for _ in range(100)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(random_.randint(0, edits)):
            text[random_.randrange(100)] = random_.choice(vocabulary)
        rows.append((first_id + i, " ".join(text)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"shard_shingles": 800}, {"frequent": 0.9}, {"size": 5, "percent": 80}, {"shard_shingles": 300, "percent": 95}, {"group_rows": 10, "shard_shingles": 2000}])
def test_components(docs_of, edge_rows, limits):
    rows = edge_rows + variants(120, 1, 1000) + variants(40, 2, 2000, 20)
    found = near_duplicates(docs_of(rows), **limits)
    want = sorted(brute_components(rows, limits.get("size", 3), limits.get("percent", 90)), key=str)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found.collect()), key=str) == want
    found = near_duplicates(docs_of(rows), count_links=False, **limits)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)
    assert got == sorted((w[:3] for w in want), key=str)


def test_no_rows(docs_of, spark):
    none = docs_of([])
    items = spark.createDataFrame([("i", "a b c")], "item_id string, text string")
    assert near_duplicates(none).count() == exact_duplicates(none).count() == contamination(none, items).count() == 0


def test_divide_skip_finds_every_link():
    random_ = np.random.default_rng(3)
    for _ in range(60):
        base = random_.choice(500, 60, replace=False)
        sets = []
        for _ in range(12):
            own = base.copy()
            own[random_.integers(60, size=random_.integers(0, 9))] = random_.integers(500, 1000)
            sets.append(np.unique(own[: random_.integers(50, 61)]).astype(np.uint64))
        pairs = {(i, j) for i in range(12) for j in range(i) if linked(frozenset(sets[i]), frozenset(sets[j]), 90)}
        found, _ = divide_skip(sets, 90)
        copies = random_.integers(1, 4, size=12)
        connecting, numbers = divide_skip(sets, 90, copies=copies)
        assert {frozenset(e) for e in connecting} <= {frozenset(e) for e in pairs}
        assert numbers.tolist() == [sum(int(copies[a + b - i]) for a, b in pairs if i in (a, b)) for i in range(12)]
        assert all((max(a, b), min(a, b)) in pairs for a, b in found)
        # the links found connect what all links connect
        label = {i: i for i in range(12)}
        for edges in (found, connecting, pairs):
            before = dict(label)
            for a, b in edges:
                x, y = label[a], label[b]
                label = {k: x if v == y else v for k, v in label.items()}
            if edges is pairs:
                assert before == label


def test_divide_skip_between_sides():
    sets = [np.arange(20, dtype=np.uint64) + np.uint64(k // 2) for k in range(4)]
    assert {(min(x), max(x)) for x in divide_skip(sets, 90, np.array([0, 0, 1, 1]))[0]} <= {(0, 2), (0, 3), (1, 2), (1, 3)}
    assert divide_skip(sets, 90, np.array([0, 0, 1, 1]), np.ones(4, int))[1].tolist() == [2, 2, 2, 2]
    assert divide_skip(sets, 90, np.zeros(4))[0] == []


def test_tasks_hold_two_blocks_of_large_groups(spark):
    """Sets that don't link to the one are dealt too, and each pair that is to be compared meets once."""
    rows = [(0, 0, i, 0, 1, bytes(80), i % 4 == 0) for i in range(400)]
    compared = spark.createDataFrame(rows, "group_id long, group_h long, _id long, _h long, copies long, tokens binary, linked boolean")
    dealt: dict[tuple, list] = {}
    for r in _blocks_of(compared, 800, 10**6).collect():
        dealt.setdefault((r.low, r.high), []).append((r._id, r.block))
    assert max(map(len, dealt.values())) <= 160  # of 10 shingles each: 800 expected; 3,000 and more before
    met = [(a, b) for (low, high), own in dealt.items() for a, s in own for b, t in own if a < b and (low == high or s != t)]
    assert len(met) == len(set(met))
    assert set(met) == {(a, b) for a in range(400) for b in range(a + 1, 400) if a % 4 or b % 4}

    tokens = spark.createDataFrame([(t, i, 0) for t in (7, 8) for i in range(300)], "token long, _id long, _h long")
    pairs: dict[tuple, list] = {}
    for r in _crowded_groups(tokens, spark.createDataFrame([(7, 300)], "token long, count long"), 60).collect():
        pairs.setdefault((r.token, r.low, r.high), []).append(r._id)
    assert {t for t, _, _ in pairs} == {7} and max(map(len, pairs.values())) <= 120
    assert {(a, b) for own in pairs.values() for a in own for b in own} == {(a, b) for a in range(300) for b in range(300)}


def test_rare_shingles_of_a_batch_are_counted():
    batch = pa.RecordBatch.from_pydict({"text": ["a b c", "a b c", "x y z"]})
    found = next(_frequent_rows(3, 90)(iter([batch]))).to_pydict()
    assert found["token"][-1] is None and sorted(found["n"][:-1]) == [1, 2] and found["n"][-1] == 3


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (500, 400)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), 400: 400, 500: 400}


def test_rounds_of_components_shrink(spark, monkeypatch):
    """Paths, a star, a clique and random links against union-find; all rounds together hold a few times the rows of the links."""
    random_ = random.Random(11)
    ids = random_.sample(range(10**6), 3000)
    edges = [*zip(ids[:1000], ids[1:1000])] + [(2 * 10**6 + i, 2 * 10**6 + i + 1) for i in range(1000)]
    edges += [(ids[1500], x) for x in ids[1501:2500]] + [(a, b) for a in ids[2500:2540] for b in ids[2500:2540]]
    edges += [tuple(random_.choices(ids[2540:], k=2)) for _ in range(400)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    written = []

    def counted(df, name):
        out = store(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr("martwright.llm.components.store", counted)
    rows = [((0, a), (0, b)) for a, b in edges] + [(None, (0, 1))]
    links = spark.createDataFrame(rows, "a struct<x: int, y: long>, b struct<x: int, y: long>")
    found = {r.node.y: r.component.y for r in components(links, "a", "b").collect()}
    assert found == {x: find(x) for x in {x for a, b in edges if a != b for x in (a, b)}}
    assert sum(written) <= 6 * len(edges)


def test_exact_duplicates(docs_of, edge_rows):
    rows = edge_rows + [(60, "É"), (61, "é"), (62, "X É"), (63, "x É")]
    texts = [(text or "").translate(A_Z) for _, text in rows]
    found = exact_duplicates(docs_of(rows))
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found.collect()), key=str)
    least = -(2**63)
    want = []
    for (doc_id, _), text in zip(rows, texts, strict=True):
        ids = [d if d is not None else least for (d, _), t in zip(rows, texts, strict=True) if t == text]
        keep = None if max(ids) == least else max(ids)
        want.append((doc_id, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    kept = [r for r in found.collect() if r.kept]
    assert len(kept) == len(set(texts)) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_state_grows_with_later_documents(spark):
    digests, state = new_folder(spark, "digests"), new_folder(spark, "state")
    schema = "_id long, _h long, row long, digest binary"
    for rows in ([(1, 0, 0, b"a"), (2, 0, 1, b"b")], [(9, 0, 0, b"a"), (3, 0, 1, b"c")]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(digests)
        extend_state(spark, digests, state)
    found = {bytes(r.digest): (r.keep_id, r.group_size) for r in read_state(spark, state).collect()}
    assert found == {b"a": (9, 2), b"b": (2, 1), b"c": (3, 1)}


def brute_contamination(rows, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))

    windows = {}
    for item, text in items:
        ws = words(text)
        n = min(10, len(ws))
        for i in range(len(ws) - n + 1 if ws else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add(item if item is not None else "")
    out = []
    for doc_id, text in rows:
        ws = words(text)
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(ws[i : i + n])]
        out.append((doc_id, len(ws), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_contamination(docs_of, spark):
    filler = " ".join(f"f{i}" for i in range(40))
    item = " ".join(f"q{i}" for i in range(14))
    items = [("long", item), ("again", item), ("short", "Tiny item, here"), ("one", "Einzelwort"), ("none", None), ("blank", " .,"), (None, "null id item words"),
             ("ten", " ".join(f"t{i}" for i in range(10))), ("exact", "É" + " É" * 11)]
    rows = [
        (1, f"{filler} {item.upper()} {filler}"),
        (2, " ".join(item.split()[2:13])),
        (3, " ".join(item.split()[:9])),
        (4, "x tiny-ITEM (here) y tiny item"),
        (5, "einzelwort einzelWORT EINZELWORTE"),
        (6, None),
        (7, ""),
        (8, "null id item"),
        (9, "null ID item words"),
        (10, "-".join(f"t{i}" for i in range(10)) * 1),
        (11, f"{item} {item}"),
        (12, "é" + " é" * 11),
        (13, "É" + " É" * 11),
        (14, f"{filler} " * 300 + item),
        (15, f"{item}"),
        (15, f"{item}"),
        (None, "tiny item here"),
    ]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id string, text string, `hash` string")
    found = contamination(docs_of(rows), benchmark)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=str)
    assert got == brute_contamination(rows, items)
    clean = contamination(docs_of(rows), benchmark.limit(0)).collect()
    assert len(clean) == len(rows) and all(r.n_hit == 0 and r["items"] == [] for r in clean)
