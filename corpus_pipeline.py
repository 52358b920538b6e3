"""A corpus pipeline of the training-data operators: each stage reads what the one before it kept.

Stages take and return the columns of ``documents``, but for the last, which returns packed pieces.
What is decided of a row holds for it alone, and for rows equal to it in ``doc_id`` and text: rows that share an id, or have none, are told apart
by the hash of their text. NULL texts are empty texts; no rows give no rows. Without labels to learn from (none, NULL or held out ones only, those of other documents, or of one class), the first stage keeps all documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm.bin_slack import pack_documents
from martwright.llm.divide_skip import near_duplicates
from martwright.llm.recurring import KEY, NO_ID, with_key
from martwright.llm.storage import new_folder, store
from martwright.llm.streaming_dedup import exact_duplicates
from martwright.llm.toxicity_fm import toxic, toxicity, train
from martwright.llm.winnowing import contamination

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Words of a shingle and similarity, in percent, of near duplicates.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` less the rows whose keys are in ``rejected``.

    The keys are written first, so that Spark knows their size when it chooses how to join.
    """
    keys = store(rejected.select(*KEY).distinct(), "rejected")
    return with_key(docs.select(*COLUMNS)).join(keys, KEY, "left_anti").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half; the model learns from the labels of these documents."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity(docs.select(*COLUMNS), model, whole_rows=True).where(~toxic()).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id. Of rows that repeat, id and text, one stays."""
    found = store(exact_duplicates(docs, keys=True).select(*KEY, "kept", "keep_id", "keep_h"), "exact-copies")
    same = F.col("keep_id").eqNullSafe(F.nullif("_id", F.lit(NO_ID))) & (F.col("keep_h") == F.col("_h"))
    kept = _without(docs, found.where(~same))
    # rows that repeat one that stays
    repeated = store(found.where(same & ~F.col("kept")).select(*KEY).distinct(), "repeated")
    if repeated.isEmpty():
        return kept
    kept = with_key(kept)
    once = kept.join(repeated, KEY, "left_semi").dropDuplicates(KEY)
    return kept.join(repeated, KEY, "left_anti").unionByName(once).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; one without an id comes first."""
    found = near_duplicates(docs, size=NEAR_WORDS, percent=NEAR_PERCENT, count_links=False, keys=True)
    return _without(docs, found.where("NOT stands"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keys=True)
    return _without(docs, found.where("n_hit > 0"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 tokens."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# The model of the first stage has no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
