"""Registered queries of the training-data operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from martwright.llm.bin_slack import pack_documents
from martwright.llm.divide_skip import near_duplicates
from martwright.llm.html_labeller import main_text
from martwright.llm.html_labeller import train as train_labeller
from martwright.llm.longest_previous_factor import remove_repeated_bytes
from martwright.llm.oracles import ORACLES
from martwright.llm.phrase_automata import remove_repeated_phrases
from martwright.llm.prefix_trie import prefix_trie
from martwright.llm.quality_mil import quality
from martwright.llm.quality_mil import train as train_quality
from martwright.llm.spelling_variants import spelling_variants
from martwright.llm.storage import new_folder
from martwright.llm.streaming_dedup import exact_duplicates
from martwright.llm.token_counts import token_counts
from martwright.llm.toxicity_fm import held_out, toxic, toxicity, train
from martwright.llm.virtual_slots import shard_documents
from martwright.llm.winnowing import contamination

TOKEN_LIMIT = 512
QUALITY_LIMIT = 0.3
# One run in so many is misspelled, so that there are variants to find.
TYPO_EVERY = 97


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_phrases(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_divide_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(_table(spark, sf_dir, "documents"), new_folder(spark, "slot-map"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, "virtual_slot")


def op4_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scores = toxicity(docs, train(docs, _table(spark, sf_dir, "labels")))
    predicted = toxic().cast("int").alias("predicted")
    return scores.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted)


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_streaming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op7_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op8_html_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return main_text(pages, train_labeller(pages))


def op9_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own for each run, so that every run encodes its table
    counts = token_counts(_table(spark, sf_dir, "documents"), new_folder(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_longest_previous_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(_table(spark, sf_dir, "documents"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def op11_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scores = quality(docs, train_quality(docs, _table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= QUALITY_LIMIT).cast("int").alias("predicted")
    return scores.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted)


def op12_prefix_suffix_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"), typo_every=TYPO_EVERY)


def op13_sequence_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations")).nodes


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


QUERIES = (
    op1_phrase_automata,
    op2_divide_skip,
    op3_virtual_slots,
    op4_toxicity_fm,
    op5_winnowing,
    op6_streaming_dedup,
    op7_bin_slack,
    op8_html_labeller,
    op9_token_cache,
    op10_longest_previous_factor,
    op11_attention_mil,
    op12_prefix_suffix_tiles,
    op13_sequence_collapse,
    pipeline,
)


def oracle_sql() -> dict[str, str]:
    return ORACLES
