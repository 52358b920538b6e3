"""Registered training-data queries and the pipeline, on the smallest tables."""

from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
import martwright.llm.queries as llm
from checks import compare

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id n_words n_removed kept_sha256",
    "op2": "doc_id n_shingles component_id n_links",
    "op3": "doc_id size text_crc32 law shard slot grown_shard",
    "op4": "doc_id held_out score predicted",
    "op5": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op6": "doc_id keep_id group_size kept text_sha256",
    "op7": "doc_id piece start length ids_crc32 sequence_id offset",
    "op8": "page_id url text n_chars",
    "op9": "doc_id n_bytes n_tokens over_limit",
    "op10": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op11": "doc_id held_out score predicted",
    "op12": "word form root n n_near form_n",
    "op13": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query_equals_duckdb(spark, duck, name, monkeypatch):
    monkeypatch.setattr(compare, "queries", llm.queries)
    monkeypatch.setattr(compare, "oracle_sql", llm.oracle_sql)
    rows, lines = compare.difference(spark, duck, DATA, name)
    assert rows > 0 and lines == []


@pytest.mark.parametrize("name", [n for n in llm.queries() if n != "pipeline"])
def test_columns_and_rows(spark, name):
    found = llm.queries()[name](spark, DATA)
    wanted = COLUMNS[name.split("_")[0]].split()
    assert found.columns[: len(wanted)] == wanted
    rows = found.count()
    if name.startswith(("op12", "op13")):  # one row per word and per node
        assert rows > 0
        return
    source = spark.read.parquet(f"{DATA}/{'pages' if name.startswith('op8') else 'documents'}.parquet").count()
    assert rows >= source if name.startswith("op7") else rows == source


def test_native_plans_run_no_python(spark, plan_of):
    for name in ("op5_winnowing", "op6_streaming_dedup"):
        assert "Python" not in plan_of(llm.queries()[name](spark, DATA))


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_nulls_repeats_and_no_rows(spark, stage, tmp_path):
    function = dict(corpus_pipeline.STAGES)[stage]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `_id` string, score string"
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    copy = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, copy), (4, copy), (5, copy + " end"), (6, item), (7, "clean text of some words"), (7, "clean text of some words"), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, None, None, None, "x", "y") for i, t in rows], schema)
    spark.createDataFrame([(i, 1, 0) for i in range(8)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    os.symlink(f"{DATA}/benchmark.parquet", tmp_path / "benchmark.parquet")
    kept = function(spark, docs, str(tmp_path))
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    gone = {"toxicity": [], "exact_dedup": [1, 3, 7, None], "near_dedup": [4, 5], "decontamination": [6], "packing": []}[stage]
    want = [i for i, _ in rows]
    for i in gone:
        want.remove(i)
    assert ids == sorted(want, key=str)
    if stage != "packing":
        assert kept.columns == corpus_pipeline.COLUMNS
    assert function(spark, docs.limit(0), str(tmp_path)).count() == 0


LABELS = {
    "empty": [],
    "NULL": [(i, 1, None) for i in range(40)],
    "held out": [(i, 1, i % 2) for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0],
    "of other documents": [(i, 1, int(i > 1100)) for i in range(1000, 8000)],
    "toxic": [(i, 1, 1) for i in range(40)],
}


@pytest.mark.parametrize("labels", list(LABELS))
def test_no_documents_are_toxic_without_labels_to_learn_from(spark, labels, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} of some words", None, None, 1) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(LABELS[labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))
    found = llm.queries()["op4_toxicity_fm"](spark, str(tmp_path)).collect()
    assert len(found) == 40 and {r.predicted for r in found} == {0}


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df) -> Counter:
    return Counter((r.doc_id, r.text) for r in df.collect())


def by_rule(stage: str, rows: Counter, items: list[str]) -> Counter:
    """What a stage keeps of rows of (id, text), decided row by row in plain Python."""
    first = {row: (row[0] is not None, row[0] or 0) for row in rows}

    def words(text, pattern):
        return re.findall(pattern, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    if stage == "exact_dedup":
        groups = {}
        for row in rows:
            groups.setdefault("".join(words(row[1], r"(?s).")), []).append(row)
        return Counter([max(group, key=first.get) for group in groups.values()])
    if stage == "near_dedup":
        sets = {}
        for row in rows:
            own = words(row[1], r"[^ \t-\r]+")
            n = min(5, len(own))
            sets[row] = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        kept, seen = Counter(), set()
        for row in sorted(rows, key=first.get):
            kept.update({row: rows[row]} if row not in seen else {})
            queue = [row]
            while queue:
                a = sets[queue.pop()]
                near = [r for r in rows if r not in seen and a and 100 * len(a & sets[r]) >= 80 * len(a | sets[r])]
                seen.update(near)
                queue += near
        return kept
    pattern = "[^\x00-/:-`{-\x7f]+"
    windows = set()
    for own in (words(item, pattern) for item in items):
        n = min(10, len(own))
        windows |= {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
    sizes = {len(w) for w in windows}
    return Counter({row: n for row, n in rows.items() if not any(tuple(own[i : i + k]) in windows for own in [words(row[1], pattern)] for k in sizes for i in range(len(own) - k + 1))})


@pytest.mark.parametrize("stage", ["exact_dedup", "near_dedup", "decontamination"])
def test_stages_decide_row_by_row(spark, stage):
    """Rows without an id and rows that share one are judged by their own text."""
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    text = [f"w{i}" for i in range(80)]
    near, other = " ".join([*text, "end"]), " ".join(reversed(text))
    rows = [(None, item), (None, "clean without id"), (8, item), (8, "clean with a dirty id"), (9, " ".join(text)), (9, near), (None, other), (None, other + " x"), (3, other + " y")]
    if stage == "exact_dedup":
        rows += [(None, "CLEAN without id"), (None, "clean without id"), (3, "clean WITH a dirty id"), (9, near), (4, ""), (5, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCUMENTS).repartition(3)
    kept = rows_of(dict(corpus_pipeline.STAGES)[stage](spark, docs, DATA))
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = by_rule(stage, Counter(rows), items)
    if stage == "exact_dedup":  # of rows without an id, any
        kept, want = (Counter((i, (t or "").lower()) for i, t in c.elements()) for c in (kept, want))
    elif stage == "near_dedup":  # of rows with one id, either
        kept, want = (Counter(i for i, _ in c.elements()) for c in (kept, want))
    assert kept == want and kept != Counter(rows)


def test_toxic_rows_go_and_no_others(spark, tmp_path):
    random_ = random.Random(5)
    plain = [f"p{i}" for i in range(60)]
    texts = [" ".join(random_.choices(plain, k=20)) for _ in range(400)]
    rows = [(i, f"{t} vile scum {t}" if i % 4 == 0 else t) for i, t in enumerate(texts)]
    rows += [(None, "p1 vile scum p2"), (None, "p3 p4 p5"), (1, "p6 vile scum p7"), (1, "p8 p9")]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCUMENTS)
    kept = rows_of(dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, str(tmp_path)))
    assert kept == Counter(r for r in rows if "vile" not in r[1])


def test_rows_are_chosen_by_toxicity_without_a_shuffle(spark, tmp_path, plan_of):
    rows = [(i, f"p{i % 7} p{i % 11}" + " vile scum" * (i % 4 == 0)) for i in range(300)] + [(5000, None), (5000, None), (1, "p2 vile scum"), (None, "p3")]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(*r, "en", None, 1) for r in rows], DOCUMENTS)
    found = dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, str(tmp_path))
    assert found.dtypes == docs.dtypes
    assert rows_of(found) == Counter(r for r in rows if "vile" not in (r[1] or ""))
    assert {(r.lang, r.source, r.n_chars) for r in found.collect()} == {("en", None, 1)}
    assert not re.search("Join|Exchange", plan_of(found))


def test_pipeline_equals_plain_rules(spark):
    """Each filter after the model's is decided by a plain rule over the rows that the stage before kept."""
    packed = corpus_pipeline.run(spark, DATA)
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    rows = rows_of(stages["toxicity"](spark, spark.read.parquet(f"{DATA}/documents.parquet"), DATA))
    for stage in list(stages)[1:-1]:
        rows = by_rule(stage, rows, items)
        assert rows
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {i for i, _ in rows}
