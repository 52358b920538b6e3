"""Toxicity scores of a factorization machine over hashed terms.

Terms are words and the beginnings of longer words, hashed. A factorization machine adds, to a weight per term, a weight
for every pair of terms: the product of their factors. So an insult beside the mention of a group can weigh more
than both alone, which additive weights miss. Those terms enter the model that tell the classes of the training
rows apart best, alone or as parts of a pair that says more than its parts do: two terms may mean nothing but together.

The model is fitted on a bounded sample of the labelled rows (``sample_rows`` of each class, chosen by a hash of the id); the
rows kept out of training, and every text, are scored with it in Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martwright.llm.recurring import KEY, NO_ID, keyed
from martwright.llm.storage import released, small_batches, store

SPACE = 2**20
TERMS = 6000
FACTORS = 4
# Labelled rows of each class that the model is fitted on, in expectation.
SAMPLE_ROWS = 6000
_BEGINNING = 4
# Gain in log likelihood that a term must bring: about that of a test at 1 in 70.
_LEAST_GAIN = 3.0
# Terms, the most frequent ones, whose pairs are looked at, and the gain that a pair must bring beyond that of its parts: less than one
# pair in a million does so by chance.
PAIRED = 800
_LEAST_PAIR_GAIN = 14.0
_WORD = re.compile(r"\w+")


# Bias at most of a model that can't tell texts apart.
_NOT_TOXIC = -0.1


def held_out(id_column: str = "doc_id", folds: int = 5) -> Column:
    """Rows whose labels no model sees: one fold of the ids."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == 0, F.lit(False))


def terms(token: str) -> list[int]:
    """Hashed terms of what stands between white space."""
    found = []
    for word in _WORD.findall(token):
        found.append(xxhash.xxh32_intdigest(word) % SPACE)
        if len(word) > _BEGINNING + 1:
            found.append(xxhash.xxh32_intdigest(f"{word[:_BEGINNING]}*") % SPACE)
    return found


class _TermsOf(dict):
    """Terms of a token, those in ``chosen`` only where given; tokens seen are kept up to a number."""

    most = 150_000

    def __init__(self, chosen: dict[int, int] | None = None):
        super().__init__()
        self._chosen = chosen

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        found = terms(token)
        if self._chosen is not None:
            found = [self._chosen[t] for t in found if t in self._chosen]
        value = self[token] = tuple(found)
        return value

    def text(self, text: str) -> list[int]:
        return sorted({t for token in set(text.lower().split()) for t in self[token]})


@dataclass
class Model:
    """``terms``: hashed term -> place; ``bias``, ``weights`` and ``factors`` by place."""

    terms: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, rows: list[list[int]]) -> np.ndarray:
        row, places = _flat(rows)
        return self.bias + _interactions(self.weights, self.factors, row, places, len(rows))[0]

    def to_bytes(self) -> bytes:
        hashed = np.array(sorted(self.terms, key=self.terms.get), np.int64)
        bias = np.array([self.bias])
        return b"".join(x.astype("<f8").tobytes() for x in (hashed, bias, self.weights, self.factors.ravel()))

    @staticmethod
    def from_bytes(data: bytes, factors: int) -> Model:
        values = np.frombuffer(data, "<f8")
        n = (len(values) - 1) // (2 + factors)
        hashed, bias, weights, rest = values[:n], values[n], values[n + 1 : 2 * n + 1], values[2 * n + 1 :]
        return Model({int(t): i for i, t in enumerate(hashed)}, float(bias), weights, rest.reshape(n, factors))


def _flat(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of each value in a list of lists or arrays."""
    values = np.concatenate([np.empty(0, np.int64), *(np.asarray(r, np.int64) for r in rows)])
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), values


def _sum_by(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(row, values[:, k], n) for k in range(values.shape[1])], 1)


def _interactions(weights, factors, row, places, n) -> tuple[np.ndarray, np.ndarray]:
    """Weights and pair weights of each row, and the sums of its factors: pairs are half of (square of sum - sum of squares)."""
    own = factors[places]
    sums = _sum_by(row, own, n)
    squares = np.bincount(row, (own**2).sum(1), n)
    return np.bincount(row, weights[places], n) + ((sums**2).sum(1) - squares) / 2, sums


def _gain(both: np.ndarray, hits: np.ndarray, total: float, positive: float) -> np.ndarray:
    """What it says about the label, in log likelihood, that a row has something: ``both`` rows have it, ``hits`` of them positive."""

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    with np.errstate(invalid="ignore"):
        rest, rest_hits = total - both, positive - hits
        share = positive / total
        gain = part(hits, both * share) + part(both - hits, both * (1 - share))
        return gain + part(rest_hits, rest * share) + part(rest - rest_hits, rest * (1 - share))


def _paired_terms(rows: list[list[int]], labels: np.ndarray, both: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Terms of pairs that say more than their two terms do, those of the best pairs first."""
    # a term that all rows have says as little beside another as alone
    counts = np.where(both < len(rows), both, 0)
    often = np.argsort(-counts, kind="stable")[:PAIRED]
    often = often[counts[often] > 0]
    place = np.full(SPACE, -1)
    place[often] = np.arange(len(often))
    row, found = _flat(rows)
    found = place[found]
    has = np.zeros((len(rows), len(often)), np.float32)
    has[row[found >= 0], found[found >= 0]] = 1
    pairs, hits = has.T @ has, has[labels > 0].T @ has[labels > 0]
    more = _gain(pairs.astype(float), hits.astype(float), len(rows), labels.sum()) - gain[often][:, None] - gain[often][None, :]
    a, b = np.nonzero(np.triu(more > _LEAST_PAIR_GAIN, 1))
    order = np.argsort(-more[a, b], kind="stable")
    return often[np.stack([a[order], b[order]], 1).ravel()]


def choose_terms(rows: list[list[int]], labels: np.ndarray, most: int) -> dict[int, int]:
    """The terms whose presence says most about the label, by likelihood ratio, alone or in pairs; the others are left to chance."""
    both, hits = np.zeros(SPACE), np.zeros(SPACE)
    for own, label in zip(rows, labels, strict=True):
        both[own] += 1  # a row has each term once
        hits[own] += label
    gain = _gain(both, hits, len(rows), labels.sum())
    usable = np.flatnonzero(gain > _LEAST_GAIN)
    best = usable[np.lexsort((usable, -gain[usable]))]
    paired = _paired_terms(rows, labels, both, gain)
    # half of the room at most for terms that enter by a pair only
    paired = list(dict.fromkeys(paired.tolist()))[: most // 2]
    chosen = list(dict.fromkeys([*paired, *best.tolist()]))[:most]
    return {int(t): i for i, t in enumerate(chosen)}


def fit(rows: list[list[int]], labels: np.ndarray, most: int = TERMS, factors: int = FACTORS, rounds: int = 150, decay: float = 2e-4) -> Model:
    """Minimise the logistic loss by Adam over all rows; the same rows in the same order give the same model."""
    chosen = choose_terms(rows, labels, most) if len(rows) else {}
    n = len(rows)
    place = np.full(SPACE, -1)
    place[np.fromiter(chosen, np.int64, len(chosen))] = np.arange(len(chosen))
    kept = [place[np.asarray(r, np.int64)] for r in rows]
    row, places = _flat([k[k >= 0] for k in kept])
    random = np.random.default_rng(7)
    bias, weights = np.zeros(1), np.zeros(len(chosen))
    v = random.normal(0, 0.05, (len(chosen), factors))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (bias, weights, v)]
    for step in range(1, rounds + 1 if n else 1):
        margins, sums = _interactions(weights, v, row, places, n)
        error = (1 / (1 + np.exp(-np.clip(margins + bias[0], -30, 30))) - labels) / n
        own = error[row]
        by_weight = np.bincount(places, own, len(weights)) + decay * weights
        by_factor = _sum_by(places, own[:, None] * (sums[row] - v[places]), len(weights)) + decay * v
        for p, grad, (m, s) in zip((bias, weights, v), (error.sum(keepdims=True), by_weight, by_factor), state, strict=True):
            m += 0.1 * (grad - m)
            s += 0.001 * (grad**2 - s)
            p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Model(chosen, float(bias[0]), weights, v)


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms_of = _TermsOf()
    for batch in batches:
        found = [terms_of.text(text) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("label"), pa.array(found, pa.list_(pa.int32()))], names=["_id", "label", "terms"]
        )


def _trained(most: int, factors: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = []
        for batch in batches:
            # copies, so that no batch is held as a whole
            rows = [np.array(r.values.to_numpy()) for r in batch.column("terms")]
            sample += zip(batch.column("_id").to_pylist(), batch.column("label").to_pylist(), rows, strict=True)
        sample.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
        model = fit([r[2] for r in sample], np.array([r[1] for r in sample], float), most, factors)
        yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], names=["model"])

    return rows


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    most_terms: int = TERMS,
    factors: int = FACTORS,
) -> Model:
    """Model of the labelled rows that are not held out.

    Ids or labels that are NULL are not used; where an id has several labels, one that says toxic holds. The bias is that of the classes'
    shares among all training rows, not those of the sample, which has up to ``sample_rows`` of each class. A model without terms (no
    labelled rows, those of one class only, or too few) can't tell texts apart: it scores every text alike, by the smoothed shares of
    the classes, one third without labels, and always below one half, which is not ``toxic``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    identity, label = F.col(id_column).cast("long"), F.col(label_column).cast("int")
    known = labels.select(identity.alias("_id"), label.alias("label")).where("_id IS NOT NULL AND label IS NOT NULL")
    known = known.where(~held_out("_id")).groupBy("_id").agg(F.max(F.least("label", F.lit(1))).alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, sample_rows / max(counts.get(1, 0), 1)).otherwise(sample_rows / max(counts.get(0, 0), 1))
    drawn = (F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) / 1_000_003) < share
    sample = store(known.where(drawn), "label-sample")
    sample = keyed(docs, id_column, text_column).join(sample, "_id").select("_id", "label", "text")
    # a bounded number of rows, written first so that the reading of all documents stays in many tasks
    sample = store(sample.mapInArrow(released(_term_rows), "_id long, label int, terms array<int>"), "sample-terms")
    row = sample.coalesce(1).mapInArrow(released(_trained(most_terms, factors)), "model binary").first()
    model = Model.from_bytes(bytes(row[0]), factors) if row else fit([], np.empty(0), most_terms, factors)
    if model.terms and counts.get(0) and counts.get(1):
        drawn_of = {k: min(n, sample_rows) for k, n in counts.items()}
        model.bias += float(np.log(counts[1] / counts[0] / (drawn_of[1] / drawn_of[0])))
    if not model.terms:
        model.bias = min(float(np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 2))), _NOT_TOXIC)
    return model


def toxic(score: str = "score") -> Column:
    """Whether a score says toxic: one half or more."""
    return F.col(score) >= 0.5


def _scores(model: Model, kept: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of = _TermsOf(model.terms)
        for batch in batches:
            margins = model.margins([terms_of.text(text) for text in batch.column("text").to_pylist()])
            scores = 1 / (1 + np.exp(-np.clip(margins, -500, 500)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(scores, pa.float64())], names=[*kept, "score"])

    return rows


def toxicity(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keys: bool = False, whole_rows: bool = False
) -> DataFrame:
    """One row per row of ``docs``: id and ``score``, 0 to 1, higher where toxic is likelier; with ``keys`` the columns of ``keyed`` too.

    With ``whole_rows``, a struct ``row`` holds the columns of ``docs`` as they are, so that rows can be chosen by score without a join.

    The score depends on the text alone; other columns of ``docs`` are not read. NULL and empty texts, and texts with no term of
    the model, have the score of its bias. Rows that repeat have equal scores; a NULL id stays NULL. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    kept = [*KEY, *(["row"] if whole_rows else [])]
    texts = keyed(docs, id_column, text_column, *([F.struct("*").alias("row")] if whole_rows else []))
    schema = StructType([texts.schema[k] for k in kept]).add("score", "double")
    scores = texts.mapInArrow(released(_scores(model, kept)), schema)
    return scores.select(F.nullif("_id", F.lit(NO_ID)).alias(id_column), "score", *(KEY if keys else []), *kept[len(KEY) :])
