"""Benchmark decontamination by winnowing.

Training texts and benchmark items are fingerprinted alike: of every window of ``window`` words, the smallest hash of
its ``GRAM``-word grams is kept. Equal windows have equal fingerprints, so a join of the fingerprints
misses no shared window. Documents with a fingerprint in common are extended: their windows are compared with
the item's, by hash and then word for word, and the words of all windows that occur are hit. An item of
fewer words than a window is one window of its own length, compared by the hash of the whole.
Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.normal import ascii_lower
from martwright.llm.recurring import KEY, NO_ID, keyed
from martwright.llm.storage import store

WINDOW = 10
GRAM = 4
# What stands between words, before lower-casing: every ASCII character but digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Fingerprint that every document and the benchmark have, so that the join keeps a row of each document.
_EVERY = -1


def words_of(text: Column) -> Column:
    """Words as they are, and the same in all letter cases when hashed; see ``_word_hashes``."""
    return F.array_remove(F.split(text, _BETWEEN), "")


def _word_hashes(words: Column) -> Column:
    # lower-casing more than A-Z can only add candidates; every hit is compared exactly later
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _shifted(column: str, by: int) -> Column:
    return F.slice(column, by + 1, 1 << 30)


def _with_grams(df: DataFrame, hashes: str, length: int, out: str) -> DataFrame:
    """``df`` with hashes of all runs of ``length`` of the array ``hashes``; those near its end are of fewer.

    Each step is a column of its own: steps are used twice, and inlined they would double the work each time.
    """
    if length == 1:
        return df.withColumn(out, F.col(hashes))
    head = 1 << ((length - 1).bit_length() - 1)
    df = _with_grams(df, hashes, head, f"{out}_{head}")
    if length - head != head:
        df = _with_grams(df, hashes, length - head, f"{out}_{length - head}")
    return df.withColumn(out, F.zip_with(f"{out}_{head}", _shifted(f"{out}_{length - head}", head), lambda a, b: F.xxhash64(a, b)))


def _with_minima(df: DataFrame, values: str, width: int, out: str) -> DataFrame:
    done, held = 1, values
    while done < width:
        step = min(done, width - done)
        done += step
        df = df.withColumn(f"{out}_{done}", F.zip_with(held, _shifted(held, step), lambda a, b: F.least(a, b)))
        held = f"{out}_{done}"
    return df.withColumn(out, F.col(held))


def _whole(df: DataFrame, hashes: str, length: int, out: str) -> DataFrame:
    """Distinct hashes of all runs of ``length`` words, marked with the length."""
    n = F.greatest(F.size(hashes) - (length - 1), F.lit(0))
    marked = F.transform(F.slice(f"{out}_grams", 1, n), lambda g: F.xxhash64(F.lit(length), g))
    return _with_grams(df, hashes, length, f"{out}_grams").withColumn(out, F.array_distinct(marked))


def with_fingerprints(df: DataFrame, words: str, window: int, gram: int, short: list[int], out: str) -> DataFrame:
    """``df`` with the distinct smallest gram hashes of all windows of ``words``, and all whole runs of the ``short`` sizes."""
    df = df.withColumn(f"{out}_h", _word_hashes(F.col(words)))
    df = _with_minima(_with_grams(df, f"{out}_h", gram, f"{out}_g"), f"{out}_g", window - gram + 1, f"{out}_m")
    windows = F.greatest(F.size(words) - (window - 1), F.lit(0))
    parts = [F.array_distinct(F.slice(f"{out}_m", 1, windows))]
    for n in short:
        df = _whole(df, f"{out}_h", n, f"{out}_w{n}")
        parts.append(F.col(f"{out}_w{n}"))
    return df.withColumn(out, F.concat(*parts))


def _items(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """``item, size, windows``: words in lower case of each window of each item that has words."""
    text = ascii_lower(F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    items = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), words_of(text).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(window)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)
    return items.select("item", "size", "words", F.transform(starts, lambda i: F.slice("words", i, F.col("size"))).alias("windows"))


def _covered(hits: Column) -> Column:
    """Number of places in a list of (start, size)."""
    places = F.flatten(F.transform(hits, lambda x: F.sequence(x["start"], x["start"] + x["size"] - 1)))
    return F.size(F.array_distinct(places)).cast("long")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    keys: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_hit`` and ``items``, the sorted ids, as text, of items with an occurring window.

    With ``keys``, the columns of ``keyed`` too.

    Words are compared after lower-casing A-Z. Other columns of either table are not read, whatever their names. NULL and blank
    texts have no words: such documents are clean and such items match nothing. Items that repeat count once per id; a NULL
    item id is the empty text. Rows that repeat get equal results; a NULL id stays NULL. No documents give no
    rows, and no items leave all documents clean. Neither table needs to be small: Spark broadcasts the
    fingerprints of the benchmark only where their stored size allows it.
    """
    spark = docs.sparkSession
    items = store(_items(benchmark, item_column, item_text_column, window), "items")
    # fewer values than a window has words
    short = sorted(r["size"] for r in items.where(F.col("size") < window).select("size").distinct().collect())

    # an item of fewer words than a window has no fingerprint but that of its own size
    of_items = with_fingerprints(items, "words", window, gram, short, "prints")
    for n in short:
        own_size = F.when(F.col("size") == n, F.col(f"prints_w{n}")).otherwise(F.col("prints"))
        of_items = of_items.withColumn("prints", own_size)
    every = spark.range(1).select(F.lit(_EVERY).cast("long").alias("print"))
    wanted = store(of_items.select(F.explode("prints").alias("print")).distinct().unionByName(every), "prints")

    texts = keyed(docs, id_column, text_column)
    split = texts.select(*KEY, words_of(F.col("text")).alias("words"))
    exploded = with_fingerprints(split, "words", window, gram, short, "prints").select(
        *KEY,
        F.size("words").cast("long").alias("n_words"),
        F.explode(F.concat(F.array(F.lit(_EVERY).cast("long")), F.col("prints"))).alias("print"),
    )
    found = exploded.join(wanted, "print").groupBy(*KEY, "n_words").agg(F.max(F.col("print") != _EVERY).alias("candidate"))
    found = store(found, "candidates")

    # extension: the windows of documents with a fingerprint in common, by hash and then word for word
    candidates = store(found.where("candidate").select(*KEY), "candidate_ids")
    own = texts.join(candidates, KEY).select(*KEY, words_of(ascii_lower(F.col("text"))).alias("words")).dropDuplicates(KEY)

    sizes = sorted({*short, window})
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    own = own.withColumn("hashes", hashes)

    def places(size: int) -> DataFrame:
        n = F.greatest(F.size("words") - (size - 1), F.lit(0))
        found = _with_grams(own, "hashes", size, "grams")
        return found.select(*KEY, F.lit(size).alias("size"), F.posexplode(F.slice("grams", 1, n)).alias("start", "hash"))

    item_windows = items.select("item", "size", F.explode("windows").alias("words")).withColumn("hashes", hashes)
    for n in sizes:
        item_windows = _with_grams(item_windows, "hashes", n, f"grams{n}")
    hashed = F.coalesce(*(F.when(F.col("size") == n, F.get(f"grams{n}", F.lit(0))) for n in sizes))
    item_windows = item_windows.select("item", "size", F.col("words").alias("window_words"), hashed.alias("hash")).distinct()
    item_windows = store(item_windows, "windows")
    all_places = places(sizes[0])
    for n in sizes[1:]:
        all_places = all_places.unionByName(places(n))
    matches = all_places.join(item_windows.select("size", "hash").distinct(), ["size", "hash"]).groupBy(*KEY)
    matches = matches.agg(F.collect_list(F.struct("start", "size", "hash")).alias("matches"))
    extended = own.join(matches, KEY).select(*KEY, "words", F.explode("matches").alias("match"))
    extended = extended.select(*KEY, "match.*", F.slice("words", F.col("match.start") + 1, F.col("match.size")).alias("window_words"))
    hits = extended.join(item_windows, ["size", "hash", "window_words"]).groupBy(*KEY).agg(
        _covered(F.collect_set(F.struct("start", "size"))).alias("n_hit"), F.array_sort(F.collect_set("item")).alias("items")
    )

    no_items = F.array().cast("array<string>")
    return (
        texts.select(*KEY)
        .join(found.select(*KEY, "n_words"), KEY)
        .join(store(hits, "hits"), KEY, "left")
        .select(
            F.nullif("_id", F.lit(NO_ID)).alias(id_column),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", no_items).alias("items"),
            *(KEY if keys else []),
        )
    )
