"""Token counts, packing, shards, toxicity and page texts: round trips, laws and held-out accuracy."""

from __future__ import annotations

import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martwright.llm import virtual_slots as slots
from martwright.llm.bilstm import BiLstm
from martwright.llm.bin_slack import fullest, pack, pack_documents
from martwright.llm.encoding import Encoder
from martwright.llm.html_blocks import Block, leaf_blocks
from martwright.llm.html_labeller import PATH_SIZE, WORD_SIZE, Vectors, fit, main_text, train as train_labeller
from martwright.llm.storage import new_folder
from martwright.llm.token_counts import token_counts
from martwright.llm.toxicity_fm import Model, toxicity, train

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text() | st.text(alphabet="aé'ſß \n\t\x1c\x85\xa0 1²½.<|endoftx>​日"))
def test_encoder_gives_the_ids_of_the_tokenizer_file(text):
    assert _ENCODER.ids(text).tolist() == ids_of(text)


_ENCODER = Encoder()


def test_token_counts_and_their_cache(docs_of, edge_rows, spark):
    cache = new_folder(spark, "cache")
    want = sorted(((d, len((t or "").encode()), len(ids_of(t))) for d, t in edge_rows), key=str)
    for _ in range(2):
        found = token_counts(docs_of(edge_rows), cache)
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in found.collect()), key=str) == want
    stored = spark.read.parquet(cache)
    # the second run found every text in the cache
    assert stored.count() == len({t or "" for _, t in edge_rows})
    token_counts(docs_of([(1, "new"), (2, "a")]), cache).collect()
    assert spark.read.parquet(cache).count() == stored.count() + 1
    assert token_counts(docs_of([]), cache).count() == 0


def test_stored_counts_are_used(docs_of, spark):
    cache = new_folder(spark, "cache")
    token_counts(docs_of([(1, "known")]), cache).collect()
    row = spark.read.parquet(cache).first()
    spark.createDataFrame([(row.tokenizer, row.digest, 77)], "tokenizer string, digest string, n_tokens long").write.mode("append").parquet(cache)
    assert [r.n_tokens for r in token_counts(docs_of([(9, "known"), (8, "known")]), cache).collect()] == [77, 77]


def test_packing_round_trip(docs_of, edge_rows):
    capacity = 128
    pieces = pack_documents(docs_of(edge_rows), capacity=capacity, part_rows=1).collect()
    sequences: dict[int, list] = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    total = sum(p.length for p in pieces)
    assert len(sequences) <= -(-total // capacity) + 2

    got = Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces)
    want: Counter = Counter()
    for doc_id, text in edge_rows:
        ids = [*ids_of(text), 0]
        first = len(ids) % capacity or capacity
        starts = [0] if len(ids) <= capacity else [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert got == want
    assert pack_documents(docs_of([])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=8), st.integers(0, 60))
def test_fullest_is_the_best_subset_sum(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    chosen = fullest(counts, room)
    assert all(n <= counts[length] for length, n in chosen.items())
    assert sum(length * n for length, n in chosen.items()) == max(s for s in sums if s <= room)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_every_piece_is_in_a_run_and_no_bin_overflows(histogram):
    runs, bins = pack(histogram, 64)
    loads, placed = Counter(), Counter()
    by_length: dict[int, list] = {}
    for run in sorted(runs):
        by_length.setdefault(run[0], []).append(run)
    for length, own in by_length.items():
        for run, after in zip(own, [*own[1:], (length, histogram[length], 0, 0, 0)], strict=True):
            for rank in range(run[1], after[1]):
                loads[run[2] + (rank - run[1]) // run[3]] += length
                placed[length] += 1
    assert placed == Counter(histogram) and len(loads) == bins and all(load <= 64 for load in loads.values())


def test_shards(docs_of, edge_rows, spark):
    rows = edge_rows + [(10_000 + i, "x" * random.Random(i).randrange(2000)) for i in range(3000)]
    path = new_folder(spark, "map")
    placed = slots.shard_documents(docs_of(rows), path).collect()
    got = sorted(((r.doc_id, r.size, r.text_crc32) for r in placed), key=str)
    assert got == sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    for shard in range(24):
        own = sorted(r.slot for r in placed if r.shard == shard)
        assert own == list(range(len(own)))
    # one long text is larger than a shard's share; the others are near equal
    loads = sorted(sum(r.size for r in placed if r.shard == k) for k in range(24))
    assert loads[-2] - loads[0] <= 0.01 * loads[0]
    assert slots.shard_documents(docs_of([]), new_folder(spark, "map")).count() == 0

    old = slots.load_map(spark, path)
    sizes = slots.slot_sizes(slots.records(docs_of(rows)))
    edited = slots.rebalanced(old, sizes, 25)
    moved = [s for s in old if old[s] != edited[s]]
    # few slots move, and the new shard gets its share
    after = [sum(sizes.get(s, (0, 0))[1] for s in old if edited[s] == k) for k in range(25)]
    assert 24 in {edited[s] for s in moved} and len(moved) < len(old) / 12
    assert sorted(after)[-2] - min(after) <= 0.02 * max(after)
    slots.save_map(spark, path, 1, edited)
    assert slots.load_map(spark, path) == edited and slots.load_map(spark, path, 0) == old
    again = {(r.doc_id, r.text_crc32): (r.virtual_slot, r.shard) for r in slots.shard_documents(docs_of(rows), path, version=1).collect()}
    assert all(again[r.doc_id, r.text_crc32] == (r.virtual_slot, edited[r.virtual_slot]) for r in placed)
    fewer = slots.rebalanced(edited, sizes, 10)
    assert set(fewer.values()) <= set(range(10))


@pytest.mark.parametrize("kind", ["no id", "one id", "one row"])
def test_shards_are_near_equal_whatever_the_ids(spark, kind):
    """A third of the rows have no id, or one id, or are one row."""
    random_ = random.Random(3)
    rows = []
    for i in range(30_000):
        text = "x" * random_.randrange(20, 400) + str(i)
        rows.append({"no id": (None, text), "one id": (7, text), "one row": (None, "same " * 40)}[kind] if i % 3 == 0 else (i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    placed = slots.shard_documents(docs, new_folder(spark, "map")).collect()
    loads = sorted(sum(r.size for r in placed if r.shard == k) for k in range(24))
    assert loads[-1] <= 1.01 * loads[0]
    for shard in range(24):
        own = sorted(r.slot for r in placed if r.shard == shard)
        assert own == list(range(len(own)))
    # no task has more than a few slots' rows
    assert max(Counter(r.virtual_slot for r in placed).values()) < 600
    assert Counter((r.doc_id, r.text_crc32) for r in placed) == Counter((d, zlib.crc32(t.encode())) for d, t in rows)


def toxic_rows(n: int):
    """Insult and group are each harmless; together they are toxic. A slur alone is toxic."""
    random_ = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        insult, group, slur = random_.random() < 0.4, random_.random() < 0.4, random_.random() < 0.05
        text = [f"n{random_.randrange(3000)}" for _ in range(30)] + ["insult"] * insult + ["group"] * group + ["slur"] * slur
        random_.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(insult and group or slur)))
    return rows, labels


def test_toxicity_learns_pairs(docs_of, spark):
    rows, labels = toxic_rows(3000)
    table = spark.createDataFrame([*labels, (None, 1, 1), (5, 0, None), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    docs = docs_of([*rows, (None, None), (-1, ""), (-2, "slur"), (-2, "slur")])
    model = train(docs, table)
    scores = {}
    for r in toxicity(docs, model).collect():
        assert 0 <= r.score <= 1
        scores[r.doc_id] = r.score
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((scores[i] >= 0.5) == (y == 1) for i, y in held)
    assert len(held) > 500 and right / len(held) > 0.97
    assert scores[None] == scores[-1] and scores[-2] > 0.5
    assert train(docs, table).to_bytes() == model.to_bytes()
    assert toxicity(docs_of([]), model).count() == 0
    # without labelled rows all texts score alike, and are not toxic
    alike = train(docs_of([]), table.limit(0))
    (score,) = {r.score for r in toxicity(docs_of(rows[:5]), alike).collect()}
    assert score == pytest.approx(1 / 3)


def test_toxicity_learns_terms_that_mean_nothing_alone(docs_of, spark):
    random_ = random.Random(8)
    rows, labels = [], []
    for i in range(4000):
        insult, group = random_.random() < 0.5, random_.random() < 0.5
        text = [f"n{random_.randrange(3000)}" for _ in range(30)] + ["insult"] * insult + ["group"] * group
        random_.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(insult != group)))
    docs = docs_of(rows)
    model = train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scores = {r.doc_id: r.score for r in toxicity(docs, model).collect()}
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((scores[i] >= 0.5) == (y == 1) for i, y in held) / len(held) > 0.95


def test_model_bytes():
    model = Model({7: 0, 3: 1}, 0.5, np.array([1.0, 2.0]), np.arange(8.0).reshape(2, 4))
    same = Model.from_bytes(model.to_bytes(), 4)
    assert same.terms == model.terms and same.margins([[0, 1], []]).tolist() == model.margins([[0, 1], []]).tolist()
    # 0.5 + 1 + 2 + <v0, v1>
    assert model.margins([[0, 1]])[0] == 3.5 + np.dot(np.arange(4), np.arange(4, 8))


def test_network_gradients():
    random_ = np.random.default_rng(0)
    net = BiLstm(5, 3)
    net.p = {k: p.astype(np.float64) + random_.normal(0, 0.3, p.shape) for k, p in net.p.items()}
    x, mask = random_.normal(size=(3, 4, 5)), np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], float)
    labels = (random_.random((3, 4)) < 0.5).astype(float)

    def loss():
        logits = net.logits(x, mask)
        return float(((np.logaddexp(0, logits) - logits * labels) * mask).sum() / mask.sum())

    for name, grad in net.gradients(x, mask, labels).items():
        p = net.p[name]
        for _ in range(3):
            at = tuple(random_.integers(n) for n in p.shape)
            kept = p[at]
            p[at] = kept + 1e-5
            above = loss()
            p[at] = kept - 1e-5
            assert abs((above - loss()) / 2e-5 - grad[at]) < 1e-4
            p[at] = kept


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("", []),
        ("plain &amp; <b>bold</b>  text\n here", ["plain & bold text here"]),
        ("<p>a<p>b<ul><li>c<li>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<script>var t='</p><p>no'</script><p>yes<style>p{}</style></p>", ["yes"]),
        ("<!-- <p>no --><p title='a > b'>yes<br>line</p><script>open", ["yes line"]),
        ("1 < 2 and 3 > 2 <p", ["1 < 2 and 3 > 2 <p"]),
        ("<p>&lt;b&gt; &#233;&nbsp;&eacute;</p>", ["<b> é é"]),
        ("</div></p>stray", ["stray"]),
    ],
)
def test_leaf_blocks(page, texts):
    assert [b.text for b in leaf_blocks(page)] == texts


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<article><p>one <svg-icon name=x></svg-icon> two</p><p>three</p></article>", ["one", "two", "three"]),
        ("<template-part><p>a</p></template-part><object-viewer>b</object-viewer><p>c", ["a", "b", "c"]),
        ("<p>one</p><svg class=i /><p>two</p><svg><title>no</title></svg><p>three", ["one", "two", "three"]),
        ("<p>a<svg/>b</p><p>c<SVG a='>' b=\"/>\"><text>no</text></SVG>d", ["a", "b", "c", "d"]),
        ("<p>where <math><msup><mi>x</mi><mn>2</mn></msup><mo>=</mo><mn>4</mn></math> holds<math/> too</p>", ["where x2=4 holds too"]),
        ("<math><mtr><mtd>1</mtd><mtd>2</mtd></mtr><annotation>\\frac</annotation></math> end", ["1 2 \\frac end"]),
        ("<script>no</scripts> no</script x><p>yes<style/>no</style>", ["yes"]),
    ],
)
def test_leaf_blocks_lose_no_text_beside_raw_elements(page, texts):
    assert [b.text for b in leaf_blocks(page)] == texts


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<article><p title=it's>Don't panic</p><p>second can't go</p>", ["Don't panic", "second can't go"]),
        ("<p a='x>y' b = \"'>\">one</p><p a=b'c>two</p>", ["one", "two"]),
        ("<p a='never closed>one</p><p>two</p>", ["one", "two"]),
        ("<p <b>one</b>", ["<p one"]),
    ],
)
def test_quotes_open_a_value_after_an_equals_sign_only(page, texts):
    assert [b.text for b in leaf_blocks(page)] == texts


@pytest.mark.parametrize("piece", ["<a", "<a ", "<a x=", "<a x='", "<a x=\">\" ", "<!", "<script", "<svg/", "</", "<a b='\"", "=\"'<a", "<!-", "<svg x=/", "</script"])
def test_hostile_pages_take_time_in_proportion(piece):
    start = time.perf_counter()
    leaf_blocks(piece * (1_000_000 // len(piece)))
    leaf_blocks("<script>" + piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 4


RICH = (
    "<html><body><nav><a href=/>home</a><a href=/b>news</a></nav><article><h1>{0}</h1><p>{1}</p><h2>{2}</h2><ul><li>{3}</li><li>{4}</li></ul>"
    "<table><tr><th>{5}</th><td>{6}</td></tr></table><blockquote>{7}</blockquote><pre>{8}</pre><figure><figcaption>{9}</figcaption></figure></article>"
    "<footer>about us</footer></body></html>"
)


def test_lists_tables_and_quotations_of_an_article_are_kept():
    net = fit([leaf_blocks(page(i)[0]) for i in range(150)])
    random_ = random.Random(77)
    kept = seen = wrong = 0
    for _ in range(40):
        parts = [" ".join(f"w{random_.randrange(300)}" for _ in range(n)) for n in (5, 30, 4, 3, 8, 2, 2, 20, 9, 6)]
        blocks = leaf_blocks(RICH.format(*parts))
        logits = net.logits(Vectors().of(blocks)[None], np.ones((1, len(blocks)), np.float32))[0]
        for block, logit in zip(blocks, logits, strict=True):
            main = "article" in block.path
            seen, kept = seen + main, kept + (main and logit >= 0)
            wrong += not main and logit >= 0
    assert kept / seen > 0.97 and wrong <= 4


def test_pages_without_marks_are_not_learned_as_boilerplate():
    unmarked = [leaf_blocks(page(i)[0].replace("article", "div").replace("nav", "div")) for i in range(30)]
    net = fit(unmarked)
    assert (net.logits(Vectors().of(unmarked[0])[None], np.ones((1, len(unmarked[0])), np.float32)) >= 0).all()


def test_paths_and_links():
    blocks = leaf_blocks('<body><div id="main" class="Post-Body x"><h1>t</h1><a href=y>abcd</a>efgh</div></body>')
    assert blocks[0].path == ("body", "div", ".main", ".post", ".body", ".x", "h1")
    assert blocks[1].text == "abcdefgh" and blocks[1].linked == 0.5


def test_every_word_enters_a_block_vector():
    opening = " ".join(f"w{i}" for i in range(25))
    texts = [f"{opening} {a} {b} end" for a, b in (("reply", "login"), ("story", "river"))]
    one, two = Vectors().of([Block(text, ("p",), 0.0) for text in texts])[:, PATH_SIZE : PATH_SIZE + WORD_SIZE]
    assert (one != two).any()
    again, long_, same = Vectors().of([Block(t, (), 0.0) for t in (texts[0], f"{texts[0]} " * 1000, "junk " * 100_000)])[:, PATH_SIZE : PATH_SIZE + WORD_SIZE]
    assert np.allclose(one, again) and np.allclose(one, long_, atol=1e-5)
    assert max(np.linalg.norm(v) for v in (one, long_, same)) <= 1.0001


def page(i: int) -> tuple[str, str]:
    random_ = random.Random(i)

    def text(n):
        return " ".join(f"w{random_.randrange(300)}" for _ in range(n)) + "."

    title, parts = text(4), [text(random_.randrange(8, 40)) for _ in range(random_.randrange(2, 8))]
    body = "".join(f"<p>{p}</p>" for p in parts)
    menu = "".join(f"<li><a href=/{k}>{text(1)}</a></li>" for k in range(4))
    html = (
        f"<html><head><title>{title}</title><script>var a='{text(3)}'</script></head><body><nav><ul>{menu}</ul></nav>"
        f"<div class='ad'>{text(9)}</div><article><h1>{title}</h1>{body}</article><footer>&copy; {text(5)}</footer></body></html>"
    )
    return html, " ".join([title, *parts])


def test_main_text(spark):
    made = [page(i) for i in range(60)]
    rows = [(i, f"u{i}", html, "x") for i, (html, _) in enumerate(made)]
    rows += [(100, None, None, "x"), (101, "u", "", "x"), (None, "u", "<nav>menu</nav>", "x"), (3, "u3", made[3][0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    model = train_labeller(pages)
    found = main_text(pages, model).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    right = sum(r.text == made[r.page_id][1] for r in found if r.page_id is not None and r.page_id < 60)
    assert right >= 60
    assert all(r.text == "" for r in found if r.page_id in (100, 101))
    assert main_text(pages.limit(0), model).count() == 0
    assert main_text(pages.limit(1), train_labeller(pages.limit(0))).count() == 1


def test_network_is_the_same_each_time():
    pages = [leaf_blocks(page(i)[0]) for i in range(6)]
    assert fit(pages, steps=3).to_bytes() == fit(pages, steps=3).to_bytes()
