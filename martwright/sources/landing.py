"""CSV landings: one table per file name, everything read as text.

The listing is a table of its own, of which the driver gets the names of tables and their files, not paths; reading, load
metadata and writing are one Spark job per table. What a load wrote is kept in an audit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martwright.sources.logs import Log
from martwright.sources.quoted_csv import CSV_OPTIONS, REJECTED, CsvFiles, Files, csv_schema, has_quoted_breaks, header_columns, located, read_quoted_csv
from martwright.sources.tables import quoted

CSV_GLOB = "*.[cC][sS][vV]"
TABLE_PREFIX = "RAW_"
REJECTS_SUFFIX = "_REJECTS"
AUDIT_SCHEMA = (
    "run_id string, table_name string, loaded_at timestamp_ntz, files long, bytes long, rows_loaded long, rows_rejected long, rows_total long"
)


@dataclass(frozen=True)
class LoadResult:
    """Audit of one load: rows written, rows now in the table, and records kept apart for their number of fields."""

    table: str
    files: int
    rows_loaded: int
    rows_total: int
    rows_rejected: int = 0

    def message(self) -> str:
        return f"{self.table}: {self.rows_loaded} rows loaded, {self.rows_total} in table, {self.rows_rejected} rejected"


def raw_table_name(file_name: str, prefix: str = TABLE_PREFIX) -> str:
    """Table of a landing file: prefix and upper-cased stem."""
    return prefix + PurePosixPath(file_name).stem.upper()


def manifest(spark: SparkSession, directory: str, prefix: str = TABLE_PREFIX) -> DataFrame:
    """``path, name, table, size`` of every CSV file below ``directory``, whatever the case of the suffix.

    Only the listing is read, never file contents. Files of the same name in different folders belong to one table.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", "true")
    path = _decoded(F.col("path"))
    name = F.substring_index(path, "/", -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    return listing.load(directory).select(path.alias("path"), name.alias("name"), F.concat(F.lit(prefix), F.upper(stem)).alias("table"), F.col("length").alias("size"))


def landing_files(spark: SparkSession, directory: str) -> dict[str, list[str]]:
    """Table name -> paths of its CSV files, for a look at a small folder: ``ingest`` does without the paths."""
    tables: dict[str, list[str]] = {}
    for row in manifest(spark, directory).orderBy("path").collect():
        tables.setdefault(row["table"], []).append(row["path"])
    return tables


@dataclass(frozen=True)
class LandingTable:
    """A landing table: its files, how many they are and their bytes."""

    table: str
    files: CsvFiles
    n_files: int
    size: int


def landing_tables(spark: SparkSession, directory: str) -> list[LandingTable]:
    """The tables below ``directory``: of all the files there, the driver gets the different names of each table's."""
    names = F.array_sort(F.collect_set("name")).alias("names")
    found = manifest(spark, directory).groupBy("table").agg(names, F.count("*").alias("n"), F.sum("size").alias("size")).orderBy("table")
    return [LandingTable(r["table"], CsvFiles(directory, tuple(r["names"])), r["n"], r["size"]) for r in found.collect()]


def _decoded(path: Column) -> Column:
    """Spark gives paths percent-encoded, with a plus sign left as it is."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def standardize_columns(df: DataFrame) -> DataFrame:
    """Column names trimmed, upper-cased, with ``_`` for spaces and hyphens."""
    return df.toDF(*[c.strip().upper().replace(" ", "_").replace("-", "_") for c in df.columns])


def read_landing(
    spark: SparkSession, files: Files, loaded_at: dt.datetime, multi_line: bool | None = None
) -> DataFrame:
    """Rows of CSV files with a header, all columns text, plus ``_REJECTED``, ``_LOADED_AT`` and ``_SOURCE_FILE``.

    Quoted fields may hold commas, doubled quotes and line breaks. Line breaks need another reading (``multi_line``), which costs
    a shuffle; unless told, the files are looked through for them. ``_REJECTED`` is the text of a record that has
    more or fewer fields than the header, and NULL for all others.
    """
    if multi_line is None:
        multi_line = has_quoted_breaks(spark, files)
    if multi_line:
        read, path = read_quoted_csv(spark, files), F.col("_SOURCE_PATH")
    else:
        schema = csv_schema(header_columns(spark, files))
        # headers that disagree between the files of a table are an error, not shifted columns
        reader = spark.read.options(**CSV_OPTIONS).option("header", True).option("enforceSchema", False)
        reader, where = located(reader.option("columnNameOfCorruptRecord", REJECTED).schema(schema), files)
        read = reader.csv(where)
        path = F.col("_metadata.file_path")
    file_name = _decoded(F.substring_index(path, "/", -1))
    loaded = {"_LOADED_AT": F.lit(loaded_at).cast("timestamp_ntz"), "_SOURCE_FILE": file_name}
    return standardize_columns(read).withColumns(loaded).drop("_SOURCE_PATH")


def append_audited(df: DataFrame, table: str, files: int = 1, rows_before: int | None = None) -> LoadResult:
    """Append to ``table`` (created if missing); what is written is counted as it is written.

    Rejected records, if there are any, are appended to a table of their own, with the load metadata. The table's rows are counted only where
    their number before the load is not given.
    """
    if rows_before is None:
        spark = df.sparkSession
        rows_before = spark.table(table).count() if spark.catalog.tableExists(table) else 0
    counted = Observation()
    rejected = F.col(REJECTED).isNotNull()
    seen = df.observe(counted, F.count_if(~rejected).alias("rows"), F.count_if(rejected).alias("rejected"))
    seen.where(~rejected).drop(REJECTED).write.mode("append").saveAsTable(table)
    if counted.get["rejected"]:
        beside = quoted(table, REJECTS_SUFFIX)
        fields = [c for c in df.columns if c not in (REJECTED, "_LOADED_AT", "_SOURCE_FILE")]
        # Spark reads the text of a record only together with its fields
        parsed = F.to_json(F.struct(*(F.col(f"`{c}`") for c in fields))).alias("parsed")
        kept_apart = df.where(rejected).select(F.col(REJECTED).alias("record"), parsed, "_LOADED_AT", "_SOURCE_FILE")
        kept_apart.write.mode("append").saveAsTable(beside)
    return LoadResult(table, files, counted.get["rows"], rows_before + counted.get["rows"], counted.get["rejected"])


def load_audit(spark: SparkSession, name: str) -> Log:
    """The log of loads: a row for each load of each table, those of repeated loads too."""
    return Log(spark, name, AUDIT_SCHEMA, "loaded_at")


def _audited_rows(audit: Log | None, table: str) -> int | None:
    """Rows in ``table`` by its audit; ``None`` if it has none."""
    return audit.read().where(F.col("table_name") == table).agg(F.max("rows_total")).first()[0] if audit else None


def load(spark: SparkSession, found: LandingTable, table: str, loaded_at: dt.datetime | None = None, audit: Log | None = None, run_id: str | None = None) -> LoadResult:
    """Append the files of one landing table to ``table``, and a row on it to the audit."""
    moment = loaded_at or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    rows = read_landing(spark, found.files, moment)
    result = append_audited(rows, table, found.n_files, _audited_rows(audit, table))
    if audit:
        audit.append([(run_id, table, moment, result.files, found.size, result.rows_loaded, result.rows_rejected, result.rows_total)])
    return result


def ingest(
    spark: SparkSession,
    directory: str,
    qualify: Callable[[str], str] = lambda table: table,
    loaded_at: dt.datetime | None = None,
    audit: Log | None = None,
) -> list[LoadResult]:
    """Append every landing file to its table.

    Nothing keeps a load from being repeated: a second run appends the same rows again, which the deduplication of the silver tables absorbs. The audit, if
    given, shows both.
    """
    return [load(spark, found, qualify(found.table), loaded_at, audit) for found in landing_tables(spark, directory)]
