"""Quality by attention over passages: features, gradients, held-out accuracy, odd labels and texts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from martwright.llm import quality_mil as mil
from martwright.llm.quality_mil import FEATURES, PASSAGE_WORDS, Model, fit, passages, quality, train

LABELS = "doc_id long, quality int, toxic int"


def features_of(text: str) -> np.ndarray:
    return np.concatenate([np.zeros((0, FEATURES)), *(x for _, x in passages([text]))])


def test_features_of_passages():
    owners, features = zip(*passages(["AB!! ab\n x9 ab ab", "", " \t", " ".join(f"w{i % 7}" for i in range(130))]), strict=True)
    assert np.concatenate(owners).tolist() == [0, 3, 3, 3]
    first, *rest = np.concatenate(features)
    # symbols only, capitals, begins with a capital, digits, ends a sentence, several symbols, symbols, length; distinct, repeated at once
    assert first[:8].round(2).tolist() == pytest.approx([0, 0.2, 0, 0.2, 0.2, 0.2, 0.1, 0.4], abs=0.03)
    assert first[8:10] == pytest.approx([3 / 5, 1 / 5])
    assert [x[8] for x in rest] == pytest.approx([7 / 64, 7 / 64, 1])


def test_long_texts_have_the_passages_of_their_words(monkeypatch):
    text = " ".join(f"W{i % 977}! x" for i in range(5000)) + "y" * 9000
    whole = features_of(text)
    monkeypatch.setattr(mil, "_SLICE", 3000)
    monkeypatch.setattr(mil, "_CHUNK", 5000)
    assert len(whole) == -(-len(text.split()) // PASSAGE_WORDS)
    np.testing.assert_array_equal(whole, features_of(text))


def test_gradients_are_those_of_the_loss():
    random_ = np.random.default_rng(1)
    x, owner, labels = random_.normal(size=(7, FEATURES)), np.array([0, 0, 0, 1, 2, 2, 2]), np.array([0.0, 1, 1])
    model = Model.new()
    model.p["bias"][:] = 0.3

    def loss() -> float:
        e, _, _, w = model._read(x)
        z = np.stack([(e * w[:, None])[owner == k].sum(0) / w[owner == k].sum() for k in range(3)])
        margins = z @ model.p["out"] + model.p["bias"][0]
        return float(np.mean(np.log1p(np.exp(margins)) - labels * margins))

    for name, grad in model.gradients(x, owner, labels).items():
        flat, at = model.p[name].reshape(-1), int(np.argmax(np.abs(grad)))
        before = flat[at]
        flat[at] = before + 1e-6
        up = loss()
        flat[at] = before - 1e-6
        down = loss()
        flat[at] = before
        assert grad.reshape(-1)[at] == pytest.approx((up - down) / 2e-6, rel=1e-3), name


def document(seed: int, bad: bool) -> str:
    """Clean passages; a bad document has one bad stretch at a random place among them."""
    random_ = random.Random(seed)
    parts = [" ".join(f"word{random_.randrange(900)}" for _ in range(random_.randrange(20, 200))) + "." for _ in range(random_.randrange(3, 7))]
    if bad:
        kind = random_.randrange(3)
        junk = ["BUY NOW!! " * 40, "ab### cd*** " * 40, f"spam{seed % 7} " * 90][kind]
        parts.insert(random_.randrange(len(parts) + 1), junk)
    return "\n".join(parts)


def test_one_bad_stretch_is_found(docs_of, spark):
    rows = [(i, document(i, i % 3 == 0)) for i in range(900)]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)], LABELS)
    scores = {r.doc_id: r.score for r in quality(docs, train(docs, labels)).collect()}
    held = range(600, 900)
    assert np.mean([(scores[i] >= 0.3) == (i % 3 > 0) for i in held]) > 0.97


def test_odd_texts_and_ids(docs_of, edge_rows, spark):
    docs = docs_of(edge_rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0), (4, 7, 0)], LABELS)
    model = train(docs, labels)
    found = quality(docs, model).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in edge_rows)
    assert all(0 <= r.score <= 1 for r in found)
    scores = {(r.doc_id, r.score) for r in found}
    assert len({s for d, s in scores if d in (1, 2, 3)}) == 1  # NULL, empty and white space
    assert len({s for d, s in scores if d == 30}) == 1
    assert quality(docs_of([]), model).count() == 0
    again = train(docs, labels)
    assert all(np.array_equal(model.p[k], again.p[k]) for k in model.p)


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(i, None, 0) for i in range(9)], 0.5), ([(i, 1, 0) for i in range(60)], None)])
def test_without_both_classes_all_texts_score_alike(docs_of, spark, labels, score):
    docs = docs_of([(i, f"text {i} of words") for i in range(60)])
    scores = {r.score for r in quality(docs, train(docs, spark.createDataFrame(labels, LABELS))).collect()}
    assert len(scores) == 1 and (score is None or scores == {score}) and min(scores) >= 0.3


def test_a_text_that_does_not_fit_the_sample_is_scored(docs_of, spark):
    rows = [(i, document(i, i % 3 == 0)) for i in range(90)] + [(1000, "long text " * 20_000)]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i, _ in rows], LABELS)
    model = train(docs, labels, sample_passages=300)
    assert quality(docs, model).count() == len(rows)


def test_stored_models_are_equal():
    bags, labels = [np.full((2, FEATURES), k / 10) for k in range(10)], np.array([0.0, 1] * 5)
    model = fit(bags, labels, steps=3, size=4)
    stored = Model.from_bytes(model.to_bytes())
    assert all(np.array_equal(model.p[k], stored.p[k]) for k in model.p)
