"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages, of consecutive words each, and only the bag has a label. Every passage is encoded by a dense layer over what it
looks like: shapes of its words, repetition, hashed words and word shapes. A gated attention (a tanh branch times a sigmoid branch) learns from
the documents' labels how much each passage counts; the score is that of the mean encoding under those weights. So one bad stretch can
decide on a long document, wherever it stands.

The model is fitted on a bounded sample of the labelled rows (``sample_rows`` of each class, chosen by a hash of the id, up to
``sample_passages`` passages altogether). Scoring reads all passages of all texts, in Spark, some thousand at a time: attention weights are bounded, so
their sums can be carried on without a look at the whole document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.storage import small_batches, store
from martwright.llm.toxicity_fm import held_out

PASSAGE_WORDS = 64
# Places that words and word shapes are hashed to.
HASHED = 64
ENCODING = 24
ATTENTION = 12
# Labelled rows of each class, and passages of all of them, that the model is fitted on.
SAMPLE_ROWS = 2000
SAMPLE_PASSAGES = 100_000

_SHAPES = 8
FEATURES = _SHAPES + 3 + HASHED
# Code points that are looked at together, and those of a long text that are split at a time.
_CHUNK = 1 << 18
_SLICE = 1 << 19
_BLANK = re.compile(r"\s")

# kinds of characters
_SPACE, _UPPER, _LETTER, _DIGIT, _SYMBOL = range(5)
_PLANE = [chr(i) for i in range(1 << 16)]
_KINDS = np.array([_SPACE if c.isspace() else _UPPER if c.isupper() else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SYMBOL for c in _PLANE], np.uint8)
_FOLDED = np.array([ord(c.lower()[0]) for c in _PLANE], np.uint32)
_BY_PLACE = np.random.default_rng(17).integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _pieces(texts: list[str]) -> Iterator[tuple[int, str]]:
    """Number of a text and a part of it: whole passages, but for its last part."""
    for number, text in enumerate(texts):
        start, rest = 0, []
        while len(text) - start > _SLICE and (cut := _BLANK.search(text, start + _SLICE)):
            words = rest + text[start : cut.start()].split()
            whole = len(words) - len(words) % PASSAGE_WORDS
            yield number, " ".join(words[:whole])
            start, rest = cut.start(), words[whole:]
        yield number, " ".join([*rest, text[start:]])


def _hashes(codes: np.ndarray, place: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each word over the codes of its characters and their places; 0 is no character."""
    mixed = codes.astype(np.uint64) * _MULTIPLIER
    mixed ^= mixed >> np.uint64(31)
    mixed *= _BY_PLACE[place & 63]
    out = np.add.reduceat(mixed, starts)
    return (out ^ (out >> np.uint64(29))) * _MULTIPLIER


def _features(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the piece and features of every passage of the pieces."""
    points = np.frombuffer("\n".join(pieces).encode("utf-32-le", "replace"), np.uint32)
    kinds = np.where(points < len(_KINDS), _KINDS[np.minimum(points, len(_KINDS) - 1)], _SYMBOL)
    space = kinds == _SPACE
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    if not len(starts):
        return np.empty(0, np.int64), np.zeros((0, FEATURES), np.float32)
    sizes = np.diff(np.append(starts, len(points)))
    # what stands before the first word belongs to no word
    points, kinds, space, starts = points[starts[0] :], kinds[starts[0] :], space[starts[0] :], starts - starts[0]
    offset = np.cumsum([0, *(len(p) + 1 for p in pieces[:-1])]) - (np.cumsum([0, *(len(p) + 1 for p in pieces)])[-1] - 1 - len(points))
    piece = np.searchsorted(offset, starts, "right") - 1
    number = np.arange(len(starts)) - np.searchsorted(piece, piece)
    new = number % PASSAGE_WORDS == 0
    firsts, passage = np.flatnonzero(new), np.cumsum(new) - 1
    n, length = len(firsts), np.diff(np.append(firsts, len(starts)))

    place = np.arange(len(points)) - np.repeat(starts, sizes)
    counts = {k: np.add.reduceat(kinds == k, starts, dtype=np.int32) for k in (_SPACE, _UPPER, _LETTER, _DIGIT, _SYMBOL)}
    size = sizes - counts[_SPACE]
    last = points[starts + size - 1]
    # the shape of a word: kinds of letters and digits, each run once, and other characters, twice at most
    codes = np.where(kinds == _SYMBOL, points, kinds)
    same = np.append(False, codes[1:] == codes[:-1])
    kept = ~same | (kinds == _SYMBOL) & ~np.append(False, same[:-1])
    kept |= place == 0
    kept &= ~space
    so_far = np.cumsum(kept)
    shape_place = so_far - np.repeat(so_far[starts], sizes)
    shape = _hashes(np.where(kept, codes + 1, 0), shape_place, starts)
    folded = np.where(points < len(_FOLDED), _FOLDED[np.minimum(points, len(_FOLDED) - 1)], points)
    word = _hashes(np.where(space, 0, folded), place, starts)

    by_word = np.stack(
        [
            counts[_SYMBOL] == size,
            (counts[_UPPER] > 1) & (counts[_LETTER] == 0),
            (kinds[starts] == _UPPER) & (counts[_LETTER] > 0),
            counts[_DIGIT] > 0,
            (last == 33) | (last == 46) | (last == 63),
            counts[_SYMBOL] > 1,
            np.minimum(counts[_SYMBOL], 4) / 4,
            np.log1p(size) / 3,
        ],
        1,
    )
    features = np.zeros((n, FEATURES), np.float32)
    features[:, :_SHAPES] = np.add.reduceat(by_word, firsts, axis=0) / length[:, None]
    order = np.lexsort((word, passage))
    first = np.append(True, word[order][1:] != word[order][:-1])
    first[firsts] = True
    features[:, _SHAPES] = np.add.reduceat(first, firsts, dtype=np.int64) / length
    again = np.append(False, word[1:] == word[:-1])
    again[firsts] = False
    features[:, _SHAPES + 1] = np.add.reduceat(again, firsts, dtype=np.int64) / length
    features[:, _SHAPES + 2] = np.log1p(length) / 4
    sums = 0
    for term in (word, shape):
        where = passage * HASHED + (term >> np.uint64(20)).astype(np.int64) % HASHED
        sums = sums + np.bincount(where, np.where(term >> np.uint64(63), 1.0, -1.0), n * HASHED)
    features[:, _SHAPES + 3 :] = sums.reshape(n, HASHED) / np.sqrt(length)[:, None]
    return piece[firsts], features


def passages(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the text and features of every passage, some passages at a time. A text without words has none."""
    owners, pieces, size = [], [], 0
    for number, piece in _pieces(texts):
        owners.append(number)
        pieces.append(piece)
        size += len(piece)
        if size > _CHUNK:
            found, features = _features(pieces)
            yield np.array(owners)[found], features
            owners, pieces, size = [], [], 0
    if pieces:
        found, features = _features(pieces)
        yield np.array(owners)[found], features


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, values[:, k], n) for k in range(values.shape[1])], 1)


@dataclass
class Model:
    """``p``: ``encode`` and ``offset`` of the encoding, ``tanh``, ``gate`` and ``attend`` of the attention, ``out`` and ``bias`` of the score."""

    p: dict[str, np.ndarray]

    @staticmethod
    def new(seed: int = 5) -> Model:
        random = np.random.default_rng(seed)
        shapes = {"encode": (FEATURES, ENCODING), "tanh": (ENCODING, ATTENTION), "gate": (ENCODING, ATTENTION)}
        p = {k: random.normal(0, s[0] ** -0.5, s) for k, s in shapes.items()}
        return Model(p | {"offset": np.zeros(ENCODING), "attend": random.normal(0, 0.3, ATTENTION), "out": random.normal(0, 0.1, ENCODING), "bias": np.zeros(1)})

    def _read(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Encodings, branches of the attention and attention weights (not yet divided by their sums) of passages."""
        e = np.tanh(x @ self.p["encode"] + self.p["offset"])
        t, g = np.tanh(e @ self.p["tanh"]), _sigmoid(e @ self.p["gate"])
        return e, t, g, np.exp((t * g) @ self.p["attend"])

    def margins(self, texts: list[str]) -> np.ndarray:
        """Of every text; one without words is scored as a passage of nothing."""
        n = len(texts)
        weights, sums = np.zeros(n), np.zeros((n, ENCODING))
        for owner, x in passages(texts):
            e, _, _, w = self._read(x)
            weights += np.bincount(owner, w, n)
            sums += _sums(e * w[:, None], owner, n)
        none = weights == 0
        weights[none], sums[none] = 1, self._read(np.zeros((1, FEATURES)))[0][0]
        return (sums / weights[:, None]) @ self.p["out"] + self.p["bias"][0]

    def gradients(self, x: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over documents."""
        n, p = len(labels), self.p
        e, t, g, w = self._read(x)
        a = w / np.bincount(owner, w, n)[owner]
        z = _sums(e * a[:, None], owner, n)
        error = (_sigmoid(z @ p["out"] + p["bias"][0]) - labels) / n
        by_passage = error[owner][:, None] * p["out"]
        da = (by_passage * e).sum(1)
        dlogit = a * (da - np.bincount(owner, a * da, n)[owner])
        dt = dlogit[:, None] * p["attend"] * g * (1 - t**2)
        dg = dlogit[:, None] * p["attend"] * t * g * (1 - g)
        de = (by_passage * a[:, None] + dt @ p["tanh"].T + dg @ p["gate"].T) * (1 - e**2)
        return {
            "out": z.T @ error,
            "bias": error.sum(keepdims=True),
            "attend": (t * g).T @ dlogit,
            "tanh": e.T @ dt,
            "gate": e.T @ dg,
            "encode": x.T @ de,
            "offset": de.sum(0),
        }

    def to_bytes(self) -> bytes:
        return b"".join(self.p[k].astype("<f8").tobytes() for k in sorted(self.p))

    @staticmethod
    def from_bytes(data: bytes) -> Model:
        model, values, at = Model.new(), np.frombuffer(data, "<f8"), 0
        for k in sorted(model.p):
            size = model.p[k].size
            model.p[k] = values[at : at + size].reshape(model.p[k].shape).copy()
            at += size
        return model


def fit(bags: list[np.ndarray], labels: np.ndarray, steps: int = 500, size: int = 128, rate: float = 0.01, decay: float = 1e-4) -> Model:
    """Adam over drawn documents, as many of either class; the same bags in the same order give the same model."""
    model, random = Model.new(), np.random.default_rng(3)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    classes = [np.flatnonzero(labels == k) for k in (0, 1)]
    for step in range(1, steps + 1):
        drawn = np.concatenate([random.choice(c, size // 2) for c in classes])
        x = np.concatenate([bags[i] for i in drawn]).astype(float)
        owner = np.repeat(np.arange(len(drawn)), [len(bags[i]) for i in drawn])
        rate_now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, grad in model.gradients(x, owner, labels[drawn]).items():
            m, s = state[k]
            grad = grad + (decay * model.p[k] if k != "bias" else 0)
            m += 0.1 * (grad - m)
            s += 0.001 * (grad**2 - s)
            model.p[k] -= rate_now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return model


def _bags(most: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for identity, label, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "label", "text")), strict=True):
                parts, n = [np.zeros((0, FEATURES), np.float32)], 0
                for _, x in passages([text]):
                    n += len(x)
                    if n > most:
                        break
                    parts.append(x)
                if n <= most:
                    bag = np.concatenate(parts) if n else np.zeros((1, FEATURES), np.float32)
                    columns = (pa.array([identity]), pa.array([label], pa.int32()), pa.array([bag.tobytes()], pa.binary()))
                    yield pa.RecordBatch.from_arrays(list(columns), names=["_id", "label", "bag"])

    return rows


def _fitted(most: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, total = [], 0
        for batch in batches:
            for identity, label, bag in zip(*(batch.column(c).to_pylist() for c in ("_id", "label", "bag")), strict=True):
                x = np.frombuffer(bag, np.float32).reshape(-1, FEATURES)
                if total + len(x) <= most:
                    sample.append((identity, label, x))
                    total += len(x)
        sample.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
        labels = np.array([r[1] for r in sample], float)
        if 0 < labels.sum() < len(labels):
            model = fit([r[2] for r in sample], labels)
            yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], names=["model"])

    return rows


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_passages: int = SAMPLE_PASSAGES,
) -> Model:
    """Model of the labelled rows that are not held out; the texts are all that it reads of them.

    Ids or labels that are NULL are not used; where an id has several labels, the least one holds. The sample has its classes in equal shares, and
    the bias is set back to the shares of all training rows. Sampled rows enter in the order of a hash of the id, as long as their passages fit; a text
    with more passages than that altogether is not learned from (but scored). Without labelled rows, or with those of one class only, nothing can be
    learned: every text then has the score of the classes' smoothed shares, one half without labels.
    """
    spark = docs.sparkSession
    small_batches(spark)
    identity, label = F.col(id_column).cast("long"), F.col(label_column).cast("int")
    known = labels.select(identity.alias("_id"), label.alias("label")).where("_id IS NOT NULL AND label IS NOT NULL")
    known = known.where(~held_out("_id")).groupBy("_id").agg(F.min(F.least("label", F.lit(1))).alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, sample_rows / max(counts.get(1, 0), 1)).otherwise(sample_rows / max(counts.get(0, 0), 1))
    drawn = (F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) / 1_000_003) < share
    sample = store(known.where(drawn), "quality-sample")
    texts = docs.select(identity.alias("_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    bags = texts.join(sample, "_id").select("_id", "label", "text").mapInArrow(_bags(sample_passages), "_id long, label int, bag binary")
    # a bounded number of rows, written first so that the reading of all documents stays in many tasks
    bags = store(bags, "quality-bags")
    row = bags.coalesce(1).sortWithinPartitions(F.xxhash64(F.col("_id") + 1), "_id", "bag").mapInArrow(_fitted(sample_passages), "model binary").first()
    odds = math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))
    if row is None:
        model = Model.new()
        model.p["out"][:] = 0
        model.p["bias"][:] = odds
        return model
    model = Model.from_bytes(bytes(row[0]))
    model.p["bias"] += odds
    return model


def _scored(model: Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = model.margins(batch.column("text").to_pylist())
            scores = 1 / (1 + np.exp(-np.clip(margins, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(scores)], names=["_id", "score"])

    return rows


def quality(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``score``, 0 to 1, higher where label 1 is likelier.

    The score depends on the text alone; other columns of ``docs`` are not read. NULL texts are empty; empty texts, and texts of white space, have one
    score, that of a passage of nothing. Rows that repeat have equal scores; a NULL id stays NULL. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    kind = texts.schema["_id"].dataType.simpleString()
    return texts.mapInArrow(_scored(model), f"_id {kind}, score double").withColumnRenamed("_id", id_column)
