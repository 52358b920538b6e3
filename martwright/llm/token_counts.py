"""Token counts through a cache keyed by digests.

Counts are stored under (digest of the tokenizer's version, digest of the content). Documents join the
stored counts; of the digests that miss, one document each is encoded, and its count is appended to the cache.
Content is normalised only in that NULL is the empty text, since anything else could change a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.encoding import TOKENIZER, Encoder, version
from martwright.llm.recurring import KEY, NO_ID, keyed
from martwright.llm.storage import small_batches, store

_CACHE = "tokenizer string, digest string, n_tokens long"


def _counts(tokenizer: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            counts = [len(encoder.ids(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return rows


def token_counts(
    docs: DataFrame, cache_path: str, tokenizer: str = TOKENIZER, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens``.

    ``cache_path`` is a Parquet table in a folder that all executors share, made when missing; each run
    appends what it encoded. A run that dies while appending leaves the cache as it was. Two runs at once may both
    append a digest; its rows are equal then, and one is used. Other columns of ``docs`` are not read. A NULL text
    is empty and has no tokens; equal texts, repeated rows among them, are encoded once; a NULL id stays
    NULL. No rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = keyed(docs, id_column, text_column)
    rows = store(texts.select(*KEY, F.sha2("text", 256).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")), "digests")

    own_version = version(tokenizer)
    # the folder may not exist yet; writing no rows makes it
    spark.createDataFrame([], _CACHE).write.mode("append").parquet(cache_path)
    cached = spark.read.schema(_CACHE).parquet(cache_path).where(F.col("tokenizer") == own_version)
    missing = rows.join(cached, "digest", "left_anti")
    chosen = missing.groupBy("digest").agg(F.min(F.struct(*KEY)).alias("first"))
    chosen = chosen.select("digest", *(F.coalesce(F.col("first")[k], F.lit(0)).alias(k) for k in KEY))
    # rows that repeat have one key
    encoded = texts.join(chosen, KEY).dropDuplicates(KEY).mapInArrow(_counts(tokenizer), "digest string, n_tokens long")
    encoded.select(F.lit(own_version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache_path)

    stored = spark.read.schema(_CACHE).parquet(cache_path).where(F.col("tokenizer") == own_version)
    # written, so that the join is one of two plain exchanges, of which Spark can split the one with a hot text
    counts = store(stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    out = rows.join(counts, "digest", "left").select("_id", "n_bytes", "n_tokens")
    return out.withColumn("_id", F.nullif("_id", F.lit(NO_ID))).withColumnRenamed("_id", id_column)
