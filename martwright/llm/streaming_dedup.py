"""Exact deduplication with a stateful stream.

A stream reads digests of the documents and keeps, per digest and without expiry, the stable identifier of the
row that stays, where its content is, and how many rows there are. The state is on disk (RocksDB) and in a
checkpoint in the shared folder, so it outlives executors and runs, and later documents extend it. Batch queries
read it through the state data source. Rows that hit a digest have all their bytes checked against the
row that stays. Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm.normal import ascii_lower
from martwright.llm.recurring import KEY, NO_ID, keyed
from martwright.llm.storage import new_folder

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# All stores of an executor share one bounded cache and write buffer.
_STATE = {
    _PROVIDER: _ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
    # a store takes an eighth of this at its first write, and an executor can hold many small stores
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    # preallocated logs would take more disk than many small stores hold
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def digests(texts: DataFrame) -> DataFrame:
    """``_id, _h, row, digest`` of each row of ``keyed`` texts; ``row`` tells rows apart that share an id."""
    return texts.select(
        *KEY,
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(ascii_lower(F.col("text")), 256)).alias("digest"),
    )


def extend_state(spark: SparkSession, digest_folder: str, state_folder: str) -> None:
    """Stream the files of ``digest_folder`` that the state has not seen into it."""
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        stays = F.max(F.struct("_id", "row", "_h"))
        (
            spark.readStream.schema("_id long, _h long, row long, digest binary")
            .parquet(digest_folder)
            .groupBy("digest")
            .agg(stays.alias("stays"), F.count("*").alias("rows"))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state_folder)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def read_state(spark: SparkSession, state_folder: str) -> DataFrame:
    """``digest, keep_id, keep_row, keep_h, group_size``: one row per digest seen so far."""
    state = spark.read.format("statestore").load(state_folder)
    stays, rows = (F.col("value")[f.name] for f in state.schema["value"].dataType.fields)
    return state.select(
        F.col("key.digest").alias("digest"),
        stays["_id"].alias("keep_id"),
        stays["row"].alias("keep_row"),
        stays["_h"].alias("keep_h"),
        rows.alias("group_size"),
    )


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keys: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    With ``keys``, the columns of ``keyed`` too, and ``keep_h``, that of the row that stays.

    Texts are equal when identical after lower-casing A-Z only; of equal texts the row with the largest id stays. Rows
    that share that id too are told apart by their place, and one of them stays. A NULL text is the empty text; a
    NULL id counts as smaller than any other and stays NULL. Other columns of ``docs`` are not read. No rows give no
    rows. Two texts with one digest fail the query, as soon as their bytes have been compared.
    """
    spark = docs.sparkSession
    texts = keyed(docs, id_column, text_column)
    digest_folder, state_folder = new_folder(spark, "digests"), new_folder(spark, "state")
    digests(texts).write.parquet(digest_folder)
    extend_state(spark, digest_folder, state_folder)

    rows = spark.read.schema("_id long, _h long, row long, digest binary").parquet(digest_folder)
    grouped_folder = new_folder(spark, "groups")
    rows.join(read_state(spark, state_folder), "digest").write.parquet(grouped_folder)
    schema = "digest binary, _id long, _h long, row long, keep_id long, keep_row long, keep_h long, group_size long"
    grouped = spark.read.schema(schema).parquet(grouped_folder)

    # rows with the key of the one that stays are its equals already
    hits = grouped.where("group_size > 1 AND NOT (_id = keep_id AND _h = keep_h)").select(*KEY, "keep_id", "keep_h").distinct()
    found = texts.join(hits, KEY).select(*KEY, "keep_id", "keep_h", ascii_lower(F.col("text")).alias("own"))
    keepers = hits.select(F.col("keep_id").alias("_id"), F.col("keep_h").alias("_h")).distinct()
    kept_texts = texts.join(keepers, KEY).dropDuplicates(KEY)
    kept_texts = kept_texts.select(F.col("_id").alias("keep_id"), F.col("_h").alias("keep_h"), ascii_lower(F.col("text")).alias("theirs"))
    checked = found.join(kept_texts, ["keep_id", "keep_h"]).select(*KEY, (F.col("own") == F.col("theirs")).alias("same")).groupBy(*KEY)
    checked = checked.agg(F.min("same").alias("same"))

    collision = F.raise_error(F.concat(F.lit("texts with one digest differ: id "), F.col("_id")))
    size = F.when(F.col("same") == F.lit(False), collision.cast("long")).otherwise(F.col("group_size"))
    return grouped.join(checked, KEY, "left").select(
        F.nullif("_id", F.lit(NO_ID)).alias(id_column),
        F.nullif("keep_id", F.lit(NO_ID)).alias("keep_id"),
        size.alias("group_size"),
        ((F.col("_id") == F.col("keep_id")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *([*KEY, "keep_h"] if keys else []),
    )
