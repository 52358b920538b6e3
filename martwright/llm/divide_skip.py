"""Similarity join of documents as sets of word n-grams, by T-occurrence search.

Two documents link when the Jaccard similarity of their shingle sets reaches ``percent``. Links are wanted as
connected components. In steps that lose no link:

1. Documents with equal sets form a class, and one of them stands for it.
2. Prefix filter: in one order of all shingles (those in many documents last, otherwise by hash), linked sets share one of
   their first ``n - ceil(t n) + 1`` shingles. Classes are brought together by those.
3. Of each such group, sets can link only if their sizes and the counts of their shingles in a few buckets are close enough
   (the buckets' differences are a lower bound of the sets' difference). A spanning forest of these candidates, and so
   a number of rows linear in the group, gives candidate components.
4. T-occurrence search in each candidate component, over whole sets: an inverted index of its shingles; each set
   is a query whose short lists are merged and whose long lists are probed by binary search, where only sets found often enough in
   the short lists are probed (DivideSkip). Overlaps are exact, and so are the links. Each document's links are counted, the sets'
   copies with them, without a row per link.

Groups with too many classes for a task are cut into blocks, and a task tests a pair of blocks. Candidate components with too
many shingles or sets for a task are cut into blocks too, all pairs of which are searched. Where links needn't be counted, they are
first compared with one of their sets: what links to that one is connected already, and only the others are paired, with each other and with
those connected already. A task holds two blocks, about ``shard_shingles`` and ``group_rows`` at most; the number of pairs grows with
the square of the blocks, as the links of a group do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.components import components
from martwright.llm.recurring import KEY, NO_ID, keyed, texts_of
from martwright.llm.rolling import Rolling, WordHashes, mix
from martwright.llm.storage import released, small_batches, store

SHINGLE = 3
PERCENT = 90
# Share of the documents from which a shingle counts as frequent. It decides the order of shingles only; there are at most
# (mean prefix length / share) such shingles, whatever the data.
FREQUENT = 0.001
# Shingles of the sets that one task indexes at a time, in expectation.
SHARD_SHINGLES = 2_000_000
# Classes with one shingle in their prefixes that one task compares, and sets that it indexes; in expectation beyond one block.
GROUP_ROWS = 50_000
# Cost of a probe against that of a merged entry, as in the rule that chooses how many lists count as long.
_MU = 0.01
# Cost of a probe against that of a merged entry, as measured; it decides how, not what, is counted.
_PROBE = 10


def shingles(text: bytes, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of all words as one where there are fewer."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(Rolling(hashes.of(words)).every(min(size, len(words))))


def _overlap(total: np.ndarray | int, percent: int):
    """Least overlap of two linked sets with ``total`` shingles together."""
    return -(-percent * total // (100 + percent))


def _prefix_length(n: int, percent: int) -> int:
    return n + percent * -n // 100 + 1


def _buckets(tokens: np.ndarray) -> np.ndarray:
    """How many shingles are in each of some buckets, at least one for 8 shingles and a power of two."""
    n = 8
    while n < len(tokens) / 8:
        n *= 2
    counts = np.bincount((tokens & np.uint64(n - 1)).astype(np.int64), minlength=n)
    return np.minimum(counts, 255).astype(np.uint8)


def _frequent_rows(size: int, percent: int):
    """Shingles in the prefixes of a batch, with how many; and the rows of the batch, at a NULL shingle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            prefixes = [np.empty(0, np.uint64)]
            for text in texts_of(batch):
                tokens = shingles(text, hashes, size)
                prefixes.append(tokens[: _prefix_length(len(tokens), percent)])
            values, counts = np.unique(np.concatenate(prefixes), return_counts=True)
            none = np.arange(len(values) + 1) == len(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(values.view(np.int64), 0), pa.int64(), mask=none), pa.array(np.append(counts, batch.num_rows), pa.int64())],
                names=["token", "n"],
            )

    return rows


def _among(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), bool)
    return frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens


def _set_rows(size: int, percent: int, frequent: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, sums, folds, prefixes, buckets = [], [], [], [], []
            for text in texts_of(batch):
                tokens = shingles(text, hashes, size)
                mixed = mix(tokens)
                last = _among(tokens, frequent)
                ordered = np.concatenate((tokens[~last], tokens[last]))
                sizes.append(len(tokens))
                sums.append(int(mixed.sum().view(np.int64)) if len(tokens) else 0)
                folds.append(int(np.bitwise_xor.reduce(mix(mixed)).view(np.int64)) if len(tokens) else 0)
                prefixes.append(ordered[: _prefix_length(len(tokens), percent)].view(np.int64) if len(tokens) else [])
                buckets.append(_buckets(tokens).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in KEY),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(folds, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(buckets, pa.binary()),
                ],
                names=[*KEY, "n", "sum", "fold", "prefix", "buckets"],
            )

    return rows


def _may_link(n: int, own: np.ndarray, sizes: np.ndarray, table: np.ndarray, percent: int) -> np.ndarray:
    """Which sets may link to one of ``n`` shingles: sizes and, row by row of ``table``, buckets close enough."""
    mine = own.astype(np.int32)
    if table.shape[1] > len(mine):
        table = table.reshape(len(table), -1, len(mine)).sum(1)
    elif table.shape[1] < len(mine):
        mine = mine.reshape(-1, table.shape[1]).sum(0)
    total = sizes + n
    return np.abs(table - mine).sum(1) <= total - 2 * _overlap(total, percent)


def _forest(sizes: np.ndarray, buckets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the sets that may link."""
    if len(sizes) == 2:  # most groups, without the tables
        small, large = sorted(sizes.tolist())
        if 100 * small >= percent * large and _may_link(int(sizes[0]), buckets[0], sizes[1:], buckets[1][None].astype(np.int32), percent)[0]:
            yield 0, 1
        return
    widths = np.array([len(b) for b in buckets])
    kinds = [(where, np.array([buckets[i] for i in where], np.int32)) for where in (np.flatnonzero(widths == w) for w in np.unique(widths))]
    left = np.ones(len(sizes), bool)
    for root in range(len(sizes)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            n = int(sizes[at])
            for where, table in kinds:
                own = sizes[where]
                close = np.flatnonzero(left[where] & (100 * np.minimum(own, n) >= percent * np.maximum(own, n)))
                if len(close):
                    near = where[close[_may_link(n, buckets[at], own[close], table[close], percent)]]
                    left[near] = False
                    for i in near:
                        yield at, i
                    queue += near.tolist()


_ENDS = ["a_id", "a_h", "b_id", "b_h"]
_EDGES = "a_id long, a_h long, b_id long, b_h long"
# A link that connects, with 0 linked documents; or a set, at both ends, with a number of documents that it links to.
_LINKS = f"{_EDGES}, linked long"


def _batch(rows: list[tuple[int, ...]], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], columns: list[str]) -> Iterator[list[tuple]]:
    """Rows of each group of a partition that is sorted by ``keys``."""
    held: list[tuple] = []
    current = None
    for batch in batches:
        names = zip(*(batch.column(k).to_pylist() for k in keys), strict=True)
        for name, row in zip(names, zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
            if name != current and held:
                yield held
                held = []
            current = name
            held.append(row)
    if held:
        yield held


def _candidates(percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int, int, int]] = []
        for group in _groups(batches, ["token", "low", "high"], [*KEY, "n", "buckets"]):
            if len(group) > 1:
                sizes = np.array([r[2] for r in group])
                buckets = [np.frombuffer(r[3], np.uint8) for r in group]
                edges += [(*group[a][:2], *group[b][:2]) for a, b in _forest(sizes, buckets, percent)]
            if len(edges) > 10_000:
                yield _batch(edges, _ENDS)
                edges = []
        yield _batch(edges, _ENDS)

    return rows


class _Index:
    """Inverted lists of some sets, which are numbered by size, so that each set meets every pair's larger one in the rest of its lists."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = tokens[order[1:]] != tokens[order[:-1]]
        numbers = np.cumsum(new) - 1
        ends = np.append(np.flatnonzero(new)[1:], len(order))
        self.lists = owners[order]
        # places in all lists, sorted by list and set, for probes
        self._places = numbers * len(sets) + self.lists
        self._number, self._start = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        self._number[order], self._start[order] = numbers, np.arange(len(order)) + 1
        self._end = ends[self._number]
        self._own = np.concatenate(([0], np.cumsum(self.sizes)))

    def rests(self, x: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, start and length of what follows the set ``x`` in its lists, short ones first."""
        own = slice(self._own[x], self._own[x + 1])
        length = self._end[own] - self._start[own]
        order = np.argsort(length, kind="stable")
        order = order[np.searchsorted(length[order], 1) :]
        return self._number[own][order], self._start[own][order], length[order]

    def merged(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """How often each set is in some stretches of the lists."""
        places = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
        return np.bincount(self.lists[places], minlength=len(self.sizes))

    def probed(self, numbers: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """In how many of some lists each of the wanted sets is, by binary search."""
        probes = numbers[:, None] * len(self.sizes) + wanted
        found = np.minimum(np.searchsorted(self._places, probes), len(self._places) - 1)
        return (self._places[found] == probes).sum(0)


def divide_skip(
    sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None, copies: np.ndarray | None = None
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect the sets of each connected component; and how many linked documents each set has.

    With ``copies``, the documents of each set, every pair is searched for, and each linked set counts with its copies. Without, pairs
    that other links connect already aren't searched for, and the numbers are 0. With ``sides``, only pairs of sets of different sides are.
    """
    by_size = np.argsort([len(s) for s in sets], kind="stable")
    index = _Index([sets[i] for i in by_size])
    sizes = index.sizes
    sides = None if sides is None else sides[by_size]
    weights = None if copies is None else copies[by_size]
    linked_to = np.zeros(len(sets), np.int64)
    component = np.arange(len(sets))
    links = []
    for x in range(len(sets) - 1):
        n = int(sizes[x])
        if not n:
            continue
        last = int(np.searchsorted(sizes, 100 * n // percent, "right"))
        open_ = np.ones(last - x - 1, bool) if weights is not None else component[x + 1 : last] != component[x]
        if sides is not None:
            open_ &= sides[x + 1 : last] != sides[x]
        if not open_.any():
            continue
        least = int(_overlap(n + int(sizes[x + 1]), percent))
        number, start, length = index.rests(x)
        if len(number) < least:
            continue
        n_long = min(least - 1, int(least / (_MU * np.log2(length[-1] + 1) + 1)))
        n_short = len(number) - n_long
        found = index.merged(start[:n_short], length[:n_short])[x + 1 : last]
        often = np.flatnonzero(open_ & (found >= least - n_long))
        overlap, often = found[often], often + x + 1
        if len(often) * n_long * _PROBE < length[n_short:].sum():
            overlap = overlap + index.probed(number[n_short:], often)
        else:  # so many that merging the long lists too is cheaper
            overlap = overlap + index.merged(start[n_short:], length[n_short:])[often]
        linked = often[100 * overlap >= percent * (sizes[often] + n - overlap)]
        if weights is not None:
            linked_to[x] += weights[linked].sum()
            linked_to[linked] += weights[x]
        for y in linked[component[linked] != component[x]]:
            if component[y] != component[x]:
                links.append((int(by_size[x]), int(by_size[y])))
                component[component == component[y]] = component[x]
    numbers = np.empty(len(sets), np.int64)
    numbers[by_size] = linked_to
    return links, numbers


def _links(percent: int, count: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [*KEY, "tokens", "block", "low", "high", "copies"]
        for group in _groups(batches, ["group_id", "group_h", "low", "high"], columns):
            # rows that repeat follow each other
            group = [r for i, r in enumerate(group) if not i or r[:2] != group[i - 1][:2]]
            # pairs within a block are searched for where it is paired with itself
            sides = None if group[0][4] == group[0][5] else np.array([r[3] for r in group])
            copies = np.array([r[6] for r in group]) if count else None
            found, numbers = divide_skip([np.frombuffer(r[2], np.uint64) for r in group], percent, sides, copies)
            counted = np.flatnonzero(numbers).tolist()
            if found or counted:
                ends = [(*group[a][:2], *group[b][:2], 0) for a, b in found] + [(*group[i][:2], *group[i][:2], int(numbers[i])) for i in counted]
                yield _batch(ends, [*_ENDS, "linked"])

    return rows


def _to_one(percent: int):
    """Whether a set links to the one it is joined with."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("tokens").to_pylist(), batch.column("one").to_pylist(), strict=True)
            linked = []
            for own, one in pairs:
                x, y = np.frombuffer(own, np.uint64), np.frombuffer(one, np.uint64)
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * overlap >= percent * (len(x) + len(y) - overlap))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("group_id", "group_h", *KEY, "copies", "tokens")), pa.array(linked, pa.bool_())],
                names=["group_id", "group_h", *KEY, "copies", "tokens", "linked"],
            )

    return rows


def _whole_sets(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        keep = ["group_id", "group_h", *KEY, "copies"]
        for batch in batches:
            tokens = [shingles(text, hashes, size).tobytes() for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(tokens, pa.binary())], names=[*keep, "tokens"])

    return rows


def _searched(sets: DataFrame, percent: int, count: bool) -> DataFrame:
    keys = ["group_id", "group_h", "low", "high"]
    return sets.repartition(*keys).sortWithinPartitions(*keys, *KEY).mapInArrow(released(_links(percent, count)), _LINKS)


def _in_pairs(rows: DataFrame) -> DataFrame:
    """Each row once for each pair of blocks, ``low`` and ``high``, that its ``block`` is in.

    The first ``firsts`` of the ``blocks`` are paired with all blocks, the others with the first only.
    """
    last = F.when(F.col("block") < F.col("firsts"), F.col("blocks")).otherwise(F.col("firsts")) - 1
    pairs = rows.where("firsts > 0").withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return pairs.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.greatest(blocks, F.lit(1))).cast("int")


def _crowded_groups(tokens: DataFrame, crowded: DataFrame, group_rows: int) -> DataFrame:
    """Members of groups that are too large for a task, in pairs of blocks."""
    blocks = F.ceil(2 * F.col("count") / group_rows).cast("int")
    dealt = tokens.join(crowded.select("token", blocks.alias("blocks"), blocks.alias("firsts")), "token")
    return _in_pairs(dealt.withColumn("block", _block(F.col("blocks")))).select("token", "low", "high", *KEY)


def _blocks_of(compared: DataFrame, shard: int, group_rows: int) -> DataFrame:
    """Sets of large groups in pairs of blocks; none for two sets that link to the one of their group."""
    group = ["group_id", "group_h"]

    def blocks(which: str) -> Column:
        chosen = F.expr(which)
        shingles = F.sum(F.when(chosen, F.octet_length("tokens") / 8).otherwise(0))
        return F.ceil(F.greatest(2 * shingles / shard, 2 * F.count_if(chosen) / group_rows)).cast("int")

    counts = store(compared.groupBy(*group).agg(blocks("NOT linked").alias("firsts"), blocks("linked").alias("lasts")), "blocks")
    dealt = compared.join(counts.withColumn("blocks", F.col("firsts") + F.col("lasts")), group)
    block = F.when(F.col("linked"), F.col("firsts") + _block(F.col("lasts"))).otherwise(_block(F.col("firsts")))
    return _in_pairs(dealt.withColumn("block", block)).select(*group, "block", "low", "high", *KEY, "copies", "tokens")


def _large_groups(sets: DataFrame, percent: int, shard: int, group_rows: int, count: bool) -> DataFrame:
    """Links in groups that are too large for a task; all their pairs are compared where links are counted."""
    group = ["group_id", "group_h"]
    if count:
        compared = store(sets.dropDuplicates([*group, *KEY]).withColumn("linked", F.lit(False)), "compared")
        return _searched(_blocks_of(compared, shard, group_rows), percent, count)
    ones = sets.where("_id = group_id AND _h = group_h").select(*group, F.col("tokens").alias("one")).dropDuplicates(group)
    schema = "group_id long, group_h long, _id long, _h long, copies long, tokens binary, linked boolean"
    compared = store(sets.join(ones, group).mapInArrow(released(_to_one(percent)), schema).dropDuplicates([*group, *KEY]), "compared")
    star = compared.where("linked").select(F.col("group_id").alias("a_id"), F.col("group_h").alias("a_h"), F.col("_id").alias("b_id"), F.col("_h").alias("b_h"))
    star = star.withColumn("linked", F.lit(0).cast("long"))
    return star.unionByName(_searched(_blocks_of(compared, shard, group_rows), percent, count))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    frequent: float = FREQUENT,
    group_rows: int = GROUP_ROWS,
    shard_shingles: int = SHARD_SHINGLES,
    count_links: bool = True,
    keys: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, the smallest id reachable by links, and ``n_links``.

    ``n_links`` is the number of other rows that a row links with, its copies among them. Without ``count_links`` there is no such
    column, and pairs that other links connect aren't compared, which spares the most in groups of many near copies. With ``keys``, there
    are the columns of ``keyed`` too, and ``stands``, whether the row, of rows with one id too, is the one of its component.
    Words stand between ASCII white space and are compared after lower-casing A-Z. A text of fewer than ``size`` words has
    them all as one shingle; a NULL or blank one has none, links with nothing and is a component of its own, whatever repeats.
    Other columns of ``docs`` are not read. Rows that repeat are copies of each other. A NULL id stays NULL, and sorts
    first in a component. No rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = keyed(docs, id_column, text_column)
    counted = texts.select("text").mapInArrow(released(_frequent_rows(size, percent)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counted = store(counted.where("token IS NULL OR n > 100"), "shingle-counts")
    rows = counted.where("token IS NULL").agg(F.sum("n")).first()[0] or 0
    often = [r["token"] for r in counted.where(F.col("token").isNotNull() & (F.col("n") > max(100, frequent * rows))).collect()]
    last = np.sort(np.array(often, np.int64).view(np.uint64))

    schema = "_id long, _h long, n long, sum long, fold long, prefix array<long>, buckets binary"
    sets = store(texts.mapInArrow(released(_set_rows(size, percent, last)), schema), "sets")
    same = ["n", "sum", "fold"]
    # written, so that the join is one of two plain exchanges, of which Spark can split the one with many copies
    classes = store(sets.groupBy(*same).agg(F.min(F.struct(*KEY)).alias("stands"), F.count("*").alias("copies")), "stands")
    members = sets.select(*KEY, *same).join(classes, same).select(*KEY, "n", "stands", "copies")
    members = store(members, "members")
    stand = members.where((F.col("stands._id") == F.col("_id")) & (F.col("stands._h") == F.col("_h")) & (F.col("n") > 0)).select(*KEY, "copies").distinct()
    ones = store(sets.join(stand, KEY).select(*KEY, "n", "copies", "prefix", "buckets").dropDuplicates(KEY), "classes")

    tokens = ones.select(F.explode("prefix").alias("token"), *KEY)
    shared = store(tokens.groupBy("token").count().where("count > 1"), "shared-shingles")
    members_of = tokens.join(shared.where(F.col("count") <= group_rows).select("token"), "token")
    members_of = members_of.select("token", F.lit(0).alias("low"), F.lit(0).alias("high"), *KEY)
    crowded = shared.where(F.col("count") > group_rows)
    if not crowded.isEmpty():
        members_of = members_of.unionByName(_crowded_groups(tokens, crowded, group_rows))
    gathered = members_of.join(ones.select(*KEY, "n", "buckets"), KEY)
    place = ["token", "low", "high"]
    near = gathered.repartition(*place).sortWithinPartitions(*place, *KEY).mapInArrow(released(_candidates(percent)), _EDGES).distinct()

    def nodes(edges: DataFrame) -> DataFrame:
        a, b = (F.struct(F.col(f"{x}_id").alias("_id"), F.col(f"{x}_h").alias("_h")).alias(x) for x in "ab")
        return components(edges.select(a, b), "a", "b")

    groups = nodes(near).select("node.*", F.col("component._id").alias("group_id"), F.col("component._h").alias("group_h"))
    # the candidates grow with the documents, so they are not to be broadcast, however few they are
    whole = texts.join(groups.join(ones.select(*KEY, "copies"), KEY).hint("merge"), KEY)
    schema = "group_id long, group_h long, _id long, _h long, copies long, tokens binary"
    whole = store(whole.mapInArrow(released(_whole_sets(size)), schema), "whole-sets")
    group = ["group_id", "group_h"]
    weights = whole.groupBy(*group).agg((F.sum(F.octet_length("tokens")) / 8).alias("shingles"), F.count("*").alias("sets"))
    large = store(weights.where((F.col("shingles") > shard_shingles) | (F.col("sets") > group_rows)), "large-groups")
    small = whole.join(large, group, "left_anti").withColumns({c: F.lit(0) for c in ("block", "low", "high")})
    links = _searched(small, percent, count_links)
    if not large.isEmpty():
        in_large = whole.join(large.select(*group), group, "left_semi")
        links = links.unionByName(_large_groups(in_large, percent, shard_shingles, group_rows, count_links))
    links = store(links, "found")

    found = nodes(links).withColumnRenamed("node", "stands")
    if count_links:
        linked = links.where("linked > 0").groupBy(F.struct(F.col("a_id").alias("_id"), F.col("a_h").alias("_h")).alias("stands"))
        found = found.join(linked.agg(F.sum("linked").alias("linked")), "stands")
    own = F.struct(*KEY)
    component = F.when(F.col("n") == 0, own).otherwise(F.coalesce("component", "stands"))
    n_links = F.when(F.col("n") == 0, F.lit(0)).otherwise(F.col("copies") - 1 + F.coalesce("linked", F.lit(0)))
    return members.join(found, "stands", "left").select(
        F.nullif("_id", F.lit(NO_ID)).alias(id_column),
        F.col("n").alias("n_shingles"),
        F.nullif(component["_id"], F.lit(NO_ID)).alias("component_id"),
        *([n_links.cast("long").alias("n_links")] if count_links else []),
        *([*KEY, (component == own).alias("stands")] if keys else []),
    )
