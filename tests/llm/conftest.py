from __future__ import annotations

import random

import pytest

# Columns that operators name inside or return, with values that would show if they were read.
CLASHING = ["_id", "_h", "n", "token", "row", "digest", "size", "slot", "score", "label", "n_words", "keep_id", "spans", "piece"]

DOCS = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) rows, with clashing columns, dealt over some partitions."""

    def make(rows: list[tuple], partitions: int = 3):
        extra = ("x",) * len(CLASHING)
        return spark.createDataFrame([(*row, *extra) for row in rows], DOCS).repartition(partitions)

    return make


def words(n: int, seed: int, vocabulary: int = 400) -> list[str]:
    random_ = random.Random(seed)
    return [f"w{random_.randrange(vocabulary)}é" if random_.random() < 0.1 else f"w{random_.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def edge_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, copies, near copies, shared passages, periodic junk."""
    base, passage = words(150, 1), words(60, 2)
    changed = list(base)
    changed[70] = "changed"
    long_ = words(20_000, 3)
    rows: list[tuple] = [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "a"),
        (5, "A"),
        (6, "a b"),
        (7, "one two three"),
        (10, " ".join(base)),
        (11, " ".join(base)),
        (12, "\n".join(base).upper().replace("É", "é")),
        (13, " ".join(changed)),
        (14, " ".join(words(40, 4) + passage + words(40, 5))),
        (15, " ".join(words(10, 6) + passage)),
        (16, " ".join(passage[:36])),
        (17, "junk " * 300),
        (18, "ab" * 400),
        (19, " ".join(long_)),
        (20, " ".join(long_[5000:5100])),
        (21, "日本語 テキスト です " * 30),
        (22, "<|endoftext|> a <|endoftext|>"),
        (-5, "negative id"),
        (2**62, "large id"),
        (30, "repeated row with some words"),
        (30, "repeated row with some words"),
        (31, "one id"),
        (31, "two texts"),
        (None, "no id at all"),
        (None, "no id at all"),
    ]
    rows += [(100 + i, " ".join(words(30, 50 + i) + passage[:40] + words(5, 80 + i))) for i in range(8)]
    return rows
