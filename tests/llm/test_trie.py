"""The prefix trie of rebuilt conversations against a walk over a tree."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from martwright.llm import prefix_trie as trie
from martwright.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, a string, cell string, conv string"


def walked(rows: list[tuple]) -> list[tuple]:
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    rebuilt = {}
    for own in convs.values():
        own.sort()
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = convs.get(c - int(math.fmod(c, 5)), [])
        rebuilt[c] = tuple(turn[2:] for turn in base[:h] + own[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
        ends[seq].append(c)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below = [totals[k] for k in children[node]]
        totals[node] = (own + sum(s for s, _ in below), sum(n for _, n in below) or 1)
    out = []
    for node, own in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), len(children[node]), totals[node][1], totals[node][0], digest))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture
def trie_of(spark):
    def make(rows: list[tuple], partitions: int = 3, **options):
        return prefix_trie(spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(partitions), **options)

    return make


def rows_of(found) -> list[tuple]:
    assert found.nodes.columns == COLUMNS
    return sorted((tuple(r) for r in found.nodes.collect()), key=str)


def conversations(n: int, seed: int) -> list[tuple]:
    random_ = random.Random(seed)
    rows = []
    for c in range(-n // 4, n):
        for t in range(random_.randrange(1, 12)):
            rows.append((c * 3 if seed % 2 else c, t, random_.choice(["user", "assistant"]), random_.choice(["yes", "no é", "", "日本"])))
    return rows


EDGES = [
    (1, None, None, None),
    (1, 0, "user", "hello"),
    (2, 0, "", ""),
    (3, 5, "ab", "c"),
    (4, 5, "a", "bc"),
    (7, 1, "user", "tie b"),
    (7, 1, "user", "tie a"),
    (7, 1, "assistant", "tie c"),
    (8, 2, "user", "twice"),
    (8, 2, "user", "twice"),
    (None, 1, "user", "of no conversation"),
    (2**62, 0, "user", "hello"),
    (-7, 3, "user", "x" * 100_000),
    (-5, 3, "user", "minus five"),
]


@pytest.mark.parametrize("rows", [EDGES, conversations(60, 1), conversations(80, 2), EDGES + conversations(30, 4)], ids=["edges", "sparse", "dense", "both"])
def test_nodes_equal_a_walk(trie_of, rows):
    assert rows_of(trie_of(rows)) == walked(rows)


def test_no_conversations(trie_of):
    assert rows_of(trie_of([])) == []
    assert rows_of(trie_of([(None, 1, "user", "text")])) == []


def test_conversations_of_no_turns_end_at_the_root(trie_of):
    # without its original, and with fewer turns than it leaves out
    empty = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1]
    rows = [(c, 0, "user", "only") for c in empty]
    assert rows_of(trie_of(rows)) == walked(rows)
    assert len(rows_of(trie_of(rows))) == 1


def test_a_conversation_with_most_turns_and_one_that_most_share(spark, trie_of):
    long_ = [(1011, t, "user", f"t{t % 50}") for t in range(3000)] + [(1010, t, "user", f"t{t % 50}") for t in range(20)]
    shared = [(5000 + c, t, "user", f"same {t}") for c in range(600) for t in range(3)]
    rows = long_ + shared + conversations(20, 6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        turns = trie._turns(spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA), "conv_id", "turn", "role", "text")
        assert turns.where("conv = 1011").select("cell").distinct().count() > 2
        assert sorted(r["at"] for r in turns.where("conv = 1011").collect()) == list(range(3000))
        found = trie_of(rows, 8, part_bytes=64)  # the ids of the shared one are hashed in many parts
        assert rows_of(found) == walked(rows)
        assert found.ends.groupBy("a", "b", "length").count().where("count > 10").count() > 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
