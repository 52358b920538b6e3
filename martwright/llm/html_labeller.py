"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. A bidirectional LSTM reads, for each, hashed vectors of its tag path and all its words, and
some measures of its text, and labels it as main text or not, with what comes before and after in the page as context.

No table says which blocks are main text, so the network learns from pages that mark it themselves: blocks inside article
or main elements are main text, unless something in their path says otherwise. Each page of the bounded sample is
learned as it is and in variants, where the wrapper of the article gets another name or none, and boilerplate
of other kinds (made of texts of the same sample) stands around and inside it. The variants teach kinds that a page's own marks
would leave to chance.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm.bilstm import Adam, BiLstm
from martwright.llm.html_blocks import Block, leaf_blocks
from martwright.llm.storage import small_batches, store

# Pages the network learns from, in expectation.
SAMPLE_PAGES = 600
HIDDEN = 16
PATH_SIZE, WORD_SIZE, MEASURES = 96, 32, 5
_INPUTS = PATH_SIZE + WORD_SIZE + MEASURES
# Steps (sequences times padded length) read at a time.
_CELLS = 12_000

MAIN = frozenset("article main .article .main .content .post .entry .story .body .text".split())
BOILERPLATE = frozenset(
    "head title nav header footer aside form button select textarea fieldset menu dialog "
    ".ad .ads .advert .advertisement .sponsored .promo .banner .sidebar .aside .menu .nav .navigation .navbar .breadcrumb .breadcrumbs "
    ".header .masthead .footer .comment .comments .reply .replies .disqus .cookie .cookies .consent .notice .alert .popup .modal "
    ".share .social .related .recommended .newsletter .subscribe .widget .tags .pagination .copyright .login .search .form".split()
)


def marked_main(path: tuple[str, ...]) -> bool:
    """Whether the marks of a page itself say that a block is main text."""
    return not MAIN.isdisjoint(path) and BOILERPLATE.isdisjoint(path)


class _Hashes(dict):
    """Place and sign of a name in a vector, as one number: negative names come ``size`` later. Names seen are kept up to a number."""

    most = 200_000

    def __init__(self, size: int):
        super().__init__()
        self._size = size

    def __missing__(self, name: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = xxhash.xxh32_intdigest(name)
        found = self[name] = value % self._size + (0 if value >> 31 else self._size)
        return found

    def sum(self, names: Iterable[str]) -> np.ndarray:
        """Sum of the signs of all names, by place."""
        counts = np.bincount([self[name] for name in names], minlength=2 * self._size)
        return counts[: self._size] - counts[self._size :]


class Vectors:
    """Input vectors of blocks."""

    def __init__(self):
        self._names, self._words = _Hashes(PATH_SIZE), _Hashes(WORD_SIZE)

    def of(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), _INPUTS), np.float32)
        for row, (text, path, linked) in zip(out, blocks, strict=True):
            if path:
                row[:PATH_SIZE] = self._names.sum(path)
            words = text.lower().split()
            signs = self._words.sum(words)
            # as long for a long block as for a short one
            row[PATH_SIZE : PATH_SIZE + WORD_SIZE] = signs / max(1.0, math.sqrt(signs @ signs))
            ends = text[-1] in ".!?…\"”»"
            row[PATH_SIZE + WORD_SIZE :] = (math.log1p(len(text)) / 5, math.log1p(len(words)) / 4, linked, ends, text.count(",") / (len(words) + 1))
        return out


def _variant(blocks: list[Block], pool: list[str], random: np.random.Generator) -> list[tuple[Block, float]]:
    """A page's blocks with the article's wrapper renamed and other boilerplate added."""

    def text(most: int) -> str:
        words = pool[random.integers(len(pool))].split()
        return " ".join(words[: int(random.integers(1, most + 1))])

    def some(*kinds: tuple[str, ...], many: int, most: int, linked: float = 0.0) -> list[tuple[Block, float]]:
        kind = kinds[random.integers(len(kinds))]
        return [(Block(text(most), ("html", "body", *kind), linked), 0.0) for _ in range(int(random.integers(1, many + 1)))]

    wrappers = (("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post"), ("div", ".main", ".content"),
                ("div", ".entry", ".content"), ("section", ".story"), ("div", ".article", ".body"), ("div",), ())
    wrapper = wrappers[random.integers(len(wrappers))]
    # an article is more than paragraphs: lists, tables, quotations, code, captions and headings below the first
    insides = (("ul", "li"), ("ol", "li"), ("table", "tr", "td"), ("table", "tbody", "tr", "td"), ("table", "tr", "th"), ("blockquote",), ("blockquote", "p"),
               ("pre",), ("figure", "figcaption"), ("h2",), ("h3",), ("h4",), ("dl", "dt"), ("dl", "dd"), ("div",), ("section", "p"), ("div", "p"))
    rich = random.random() < 0.6
    out: list[tuple[Block, float]] = []
    for block in blocks:
        main = marked_main(block.path)
        inside = tuple(n for n in block.path if n not in MAIN and n not in ("html", "body"))
        if main and rich and random.random() < 0.4:
            kind = insides[random.integers(len(insides))]
            # items, cells and headings are short, and several stand in a row
            short = kind[-1] in ("li", "td", "th", "dt", "h2", "h3", "h4", "figcaption")
            for _ in range(int(random.integers(1, 5)) if kind[-1] in ("li", "td", "th") else 1):
                own = text(12).rstrip(".!?…") if short and random.random() < 0.7 else block.text
                out.append((Block(own or block.text, ("html", "body", *wrapper, *kind), 0.0), 1.0))
        if main:
            block = block._replace(path=("html", "body", *wrapper, *inside))
        out.append((block, float(main)))
    places = [i for i, (_, main) in enumerate(out) if main]
    first, last = (places[0], places[-1] + 1) if places else (len(out), len(out))
    middle = int(random.integers(first, last + 1)) if places else last
    before = (
        (0.5, lambda: some(("header",), ("div", ".header"), ("header", "div", ".masthead"), many=2, most=12)),
        (0.4, lambda: some(("div", ".cookie", ".notice"), ("div", ".alert"), ("dialog",), ("div", ".consent", ".banner"), many=2, most=20)),
        (0.4, lambda: some(("nav", "ul", "li"), ("ul", ".menu", "li"), ("div", ".breadcrumb"), ("table", "tr", "td"), ("ul", "li"), ("div",), many=8, most=3, linked=1.0)),
        (0.3, lambda: some(("aside",), ("div", ".sidebar"), ("aside", "ul", "li"), many=5, most=25, linked=float(random.random() < 0.5))),
    )
    within = (
        (0.3, lambda: some((*wrapper, "div", ".ad"), (*wrapper, "aside"), (*wrapper, "div", ".advert"), (*wrapper, "div", ".promo"), many=2, most=30)),
        (0.2, lambda: some((*wrapper, "ul", ".share", "li"), (*wrapper, "div", ".social"), (*wrapper, "form"), (*wrapper, "p"), (*wrapper, "ul", "li"), many=3, most=6, linked=1.0)),
    )
    after = (
        (0.5, lambda: some(("section", ".comments", "div", ".comment", "p"), ("div", ".comments", "p"), ("ul", ".comments", "li"),
                           (*wrapper, "section", ".comments", "p"), ("aside", ".comments", "p"), ("ol", ".comment", "li", "div", "p"), many=6, most=60)),
        (0.4, lambda: some(("aside",), ("div", ".sidebar"), ("aside", "p"), ("div", ".related", "ul", "li"), ("div", ".sidebar", "p"), many=6, most=40)),
        (0.3, lambda: some(("form",), ("form", "label"), ("div", ".newsletter", "form", "p"), ("form", "p"), ("div", ".subscribe"), many=4, most=15)),
        (0.5, lambda: some(("footer",), ("div", ".footer"), ("footer", "p"), ("div", ".copyright"), many=3, most=25)),
        (0.3, lambda: some(("div", ".ad"), ("div", ".advert"), ("div", ".banner"), ("div", ".sponsored", "p"), many=2, most=30)),
    )
    parts: list[list[tuple[Block, float]]] = []
    for chances in (before, within, after):
        chosen = [make() for chance, make in chances if random.random() < chance]
        random.shuffle(chosen)
        parts.append([b for group in chosen for b in group])
    return out[:first] + parts[0] + out[first:middle] + parts[1] + out[middle:last] + parts[2] + out[last:]


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, sequences))
    x, mask = np.zeros((len(sequences), steps, _INPUTS), np.float32), np.zeros((len(sequences), steps), np.float32)
    for i, sequence in enumerate(sequences):
        x[i, : len(sequence)], mask[i, : len(sequence)] = sequence, 1
    return x, mask


def fit(pages: list[list[Block]], steps: int = 250, hidden: int = HIDDEN) -> BiLstm:
    """Network that learned the pages and their variants, in at least so many steps; the same pages in the same order give the same one.

    A page that marks no main text says nothing about what is, and is left out. Without any other the network takes every block.
    """
    random = np.random.default_rng(5)
    net, vectors = BiLstm(_INPUTS, hidden), Vectors()
    pages = [p for p in pages if any(marked_main(b.path) for b in p)]
    pool = [b.text for p in pages for b in p]
    adam = Adam(net)
    per_round = -(-2 * len(pages) // 32)
    for _ in range(-(-steps // per_round) if pages else 0):
        examples = []
        for blocks in pages:
            plain = [(b, float(marked_main(b.path))) for b in blocks]
            for labelled in (plain, _variant(blocks, pool, random)):
                examples.append((vectors.of([b for b, _ in labelled]), np.array([y for _, y in labelled], np.float32)))
        order = sorted(range(len(examples)), key=lambda i: len(examples[i][0]))
        batches = [order[i : i + 32] for i in range(0, len(order), 32)]
        random.shuffle(batches)
        for batch in batches:
            x, mask = _padded([examples[i][0] for i in batch])
            labels = np.zeros_like(mask)
            for row, i in enumerate(batch):
                labels[row, : len(examples[i][1])] = examples[i][1]
            adam.step(net.gradients(x, mask, labels))
    return net


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        rows += zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True)
    net = fit([leaf_blocks(page) for _, page in sorted(rows)])
    yield pa.RecordBatch.from_arrays([pa.array([net.to_bytes()], pa.binary())], names=["model"])


def train(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", sample_pages: int = SAMPLE_PAGES) -> bytes:
    """The network, as bytes, fitted on about ``sample_pages`` pages chosen by a hash of the id. NULLs count as 0 and empty."""
    spark: SparkSession = pages.sparkSession
    small_batches(spark)
    identity = F.coalesce(F.col(id_column).cast("long"), F.lit(0))
    rows = pages.select(identity.alias("page_id")).count()
    drawn = F.pmod(F.xxhash64(identity), F.lit(1_000_003)) / 1_000_003 < sample_pages / max(rows, 1)
    sample = pages.where(drawn).select(identity.alias("page_id"), F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"))
    # a bounded number of pages, written first so that the reading of all pages stays in many tasks
    row = store(sample, "page-sample").coalesce(1).mapInArrow(_fitted, "model binary").first()
    return bytes(row[0]) if row else fit([]).to_bytes()


def _texts(model: bytes):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, vectors = BiLstm.from_bytes(model), Vectors()
        for batch in batches:
            pages = [leaf_blocks(page or "") for page in batch.column("html").to_pylist()]
            texts = [""] * len(pages)
            order = sorted((i for i, blocks in enumerate(pages) if blocks), key=lambda i: len(pages[i]))
            while order:
                longest = len(pages[order[-1]])
                cut = max(1, _CELLS // longest)
                chosen, order = order[-cut:], order[:-cut]
                x, mask = _padded([vectors.of(pages[i]) for i in chosen])
                for i, logits in zip(chosen, net.logits(x, mask), strict=True):
                    texts[i] = " ".join(block.text for block, logit in zip(pages[i], logits, strict=False) if logit >= 0)
            n_chars = [len(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(n_chars, pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows


def main_text(
    pages: DataFrame, model: bytes, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` (blocks in page order, joined by one space) and ``n_chars``.

    The whole page is read and no block is cut. NULL, empty and text-free pages, and pages without main text, have an empty text;
    NULL ids and urls stay NULL; rows that repeat have equal texts; other columns of ``pages`` are not read. No rows give
    no rows. Markup that is never closed ends with the page.
    """
    small_batches(pages.sparkSession)
    renamed = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))
    kind = renamed.schema["page_id"].dataType.simpleString()
    out = renamed.mapInArrow(_texts(model), f"page_id {kind}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": id_column, "url": url_column})
