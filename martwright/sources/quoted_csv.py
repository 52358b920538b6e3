"""CSV files whose quoted fields hold line breaks, read in parallel within a file.

Spark's ``multiLine`` option reads such a file in one task. Here the file is split at line breaks like plain text. A line takes
the reader from outside or inside a quoted field to one of the two; a quote opens a field only where the field starts. What a line
does is a function of two values, so the lines of a split, and then the splits of a file, can be composed; only one row
per split is ordered per file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

CSV_OPTIONS = {"escape": '"'}
# Column that holds the text of a record whose number of fields is not that of the header.
REJECTED = "_REJECTED"

@dataclass(frozen=True)
class CsvFiles:
    """All files of some names in any folder below a directory. Spark lists them; their paths are in no list here."""

    directory: str
    names: tuple[str, ...]

    @property
    def glob(self) -> str:
        escaped = ("".join(f"\\{c}" if c in "*?[]{},\\" else c for c in name) for name in self.names)
        return "{" + ",".join(escaped) + "}"


Files = CsvFiles | list[str]


def located(reader: DataFrameReader, files: Files) -> tuple[DataFrameReader, str | list[str]]:
    """``reader`` and what it is to load, for files of some names or for paths."""
    if isinstance(files, CsvFiles):
        return reader.option("recursiveFileLookup", True).option("pathGlobFilter", files.glob), files.directory
    return reader, files


def header_columns(spark: SparkSession, files: Files) -> list[str]:
    """The column names of one of the files."""
    reader, where = located(spark.read.options(**CSV_OPTIONS).option("header", True), files if isinstance(files, CsvFiles) else files[:1])
    return reader.csv(where).columns


# States between two quotes of a line.
_OUTSIDE, _INSIDE, _CLOSED = 0, 1, 2


def _after(segments: Column, start: int) -> Column:
    """State after a line, given as the texts between its quotes, that starts in a state: 1 inside a quoted field, else 0."""

    def quote(state: Column, before: Column) -> Column:
        opens = F.when(F.endswith(before, F.lit(",")), _INSIDE).otherwise(_OUTSIDE)
        doubled = F.when(before == "", _INSIDE).otherwise(opens)
        return F.when(state == _INSIDE, _CLOSED).when(state == _CLOSED, doubled).otherwise(opens)

    before_quotes = F.slice(segments, 1, F.size(segments) - 1)
    return (F.aggregate(before_quotes, F.lit(start), quote) == _INSIDE).cast("int")


def _states(line: str = "value") -> tuple[Column, Column]:
    """State after a line that starts outside, and after one that starts inside a quoted field."""
    # a comma in front makes the start of a line the start of a field
    outside = F.split(F.concat(F.lit(","), F.col(line)), '"')
    quoted = F.contains(line, F.lit('"'))
    return (
        F.when(quoted, _after(outside, _OUTSIDE)).otherwise(0),
        F.when(quoted, _after(F.split(line, '"'), _INSIDE)).otherwise(1),
    )


def _text(spark: SparkSession, files: Files) -> DataFrame:
    reader, where = located(spark.read.option("lineSep", "\n"), files)
    return reader.text(where)


def has_quoted_breaks(spark: SparkSession, files: Files) -> bool:
    """Whether any line ends inside a quoted field that it opened. One scan without a shuffle, up to the first such line."""
    from_outside, _ = _states()
    return not _text(spark, files).where(from_outside == 1).isEmpty()


def _lines(spark: SparkSession, files: Files) -> DataFrame:
    """Lines with their place (``file``, ``split``, ``line``) and the states after them."""
    from_outside, from_inside = _states()
    return _text(spark, files).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        # increases along the lines of a split
        F.monotonically_increasing_id().alias("line"),
        "value",
        from_outside.alias("from_outside"),
        from_inside.alias("from_inside"),
    )


def _composed(rows: Window, so_far: Window) -> tuple[Column, Column]:
    """States after all rows of a window that starts outside, or inside: that of the last row that decides, flipped since."""
    decides = F.col("from_outside") == F.col("from_inside")
    flips = F.sum((F.col("from_outside") > F.col("from_inside")).cast("int"))
    decided = F.last(F.when(decides, F.struct(F.col("from_outside").alias("state"), "flips")), True).over(rows)
    flips_now = F.coalesce(flips.over(rows), F.lit(0))
    return tuple(
        F.when(decided.isNull(), (start + flips_now) % 2).otherwise((decided["state"] + flips_now - decided["flips"]) % 2)
        for start in (0, 1)
    )


def _before(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """``rows`` with the state before each, where its group starts outside or inside, in ``before_outside`` and ``before_inside``."""
    ordered = Window.partitionBy(*by).orderBy(order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    flip = (F.col("from_outside") > F.col("from_inside")).cast("int")
    flipped = rows.withColumn("flips", F.sum(flip).over(so_far))
    outside, inside = _composed(earlier, so_far)
    return flipped.withColumns({"before_outside": outside, "before_inside": inside}).drop("flips")


def quoted_records(spark: SparkSession, files: Files) -> DataFrame:
    """``file, is_header, record``: one row per CSV record, line breaks inside quotes kept.

    A file that ends inside a quoted field is an error, found before any of its lines are put together.
    """
    lines = _before(_lines(spark, files), ["file", "split"], "line")

    def after(state: str) -> Column:
        return F.when(F.col(state) == 0, F.col("from_outside")).otherwise(F.col("from_inside"))

    whole = F.struct("line", after("before_outside").alias("o"), after("before_inside").alias("i"))
    splits = lines.groupBy("file", "split").agg(
        F.max(whole).alias("last"),
        F.count_if(F.col("before_outside") == 0).alias("starts_outside"),
        F.count_if(F.col("before_inside") == 0).alias("starts_inside"),
    )
    splits = splits.withColumns({"from_outside": F.col("last.o"), "from_inside": F.col("last.i")})
    splits = _before(splits, ["file"], "split").withColumn("inside", F.col("before_outside"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    is_last = F.lead("split").over(Window.partitionBy("file").orderBy("split")).isNull()
    unclosed = is_last & (F.when(F.col("inside") == 0, F.col("from_outside")).otherwise(F.col("from_inside")) == 1)
    error = F.raise_error(F.concat(F.lit("ends inside a quoted field: "), F.col("file"))).cast("int")
    splits = (
        splits.withColumn("starts", F.when(F.col("inside") == 0, F.col("starts_outside")).otherwise(F.col("starts_inside")))
        # the record that reaches into this split: the last one started before it
        .withColumn("open", F.last(F.when(F.col("starts") > 0, F.struct("split", "starts")), True).over(earlier))
        .select("file", "split", F.when(unclosed, error).otherwise(F.col("inside")).alias("inside"), "open")
    )

    # a record starts on a line that does not start inside a quoted field, and is whole if the line ends outside too
    state = F.when(F.col("inside") == 0, F.col("before_outside")).otherwise(F.col("before_inside"))
    so_far = Window.partitionBy("file", "split").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        lines.join(splits, ["file", "split"])
        .withColumn("start", (state == 0).cast("int"))
        .withColumn("number", F.sum("start").over(so_far))
        .select(
            "file",
            "split",
            "line",
            "value",
            ((F.col("start") == 1) & (F.col("from_outside") == 0)).alias("complete"),
            F.when(F.col("number") > 0, F.struct("split", F.col("number").alias("starts"))).otherwise(F.col("open")).alias("key"),
        )
    )
    is_header = (F.col("key.split") == 0) & (F.col("key.starts") == 1)
    complete = placed.where("complete").select("file", is_header.alias("is_header"), F.col("value").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("split", "line", "value")))
    broken = (
        placed.where("NOT complete")
        .groupBy("file", "key")
        .agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("record"))
        .select("file", is_header.alias("is_header"), "record")
    )
    # a carriage return before the final line break belongs to the break
    return complete.unionByName(broken).withColumn("record", F.regexp_replace("record", "\r$", ""))


def csv_schema(columns: list[str]) -> str:
    """All columns text, and the text of records with too few or too many fields in ``REJECTED``."""
    return ", ".join("`{}` STRING".format(c.replace("`", "``")) for c in [*columns, REJECTED])


def read_quoted_csv(spark: SparkSession, files: Files) -> DataFrame:
    """Rows of CSV files with one and the same header line, all columns text, with ``REJECTED`` and ``_SOURCE_PATH``."""
    columns = header_columns(spark, files)
    one = files if isinstance(files, CsvFiles) else files[:1]
    header = _text(spark, one).where("_metadata.file_block_start = 0").first()[0].rstrip("\r")
    other_header = F.raise_error(F.concat(F.lit("other header line in "), F.col("file"))).cast("boolean")
    is_row = F.when(F.col("is_header") & (F.col("record") != header), other_header).otherwise(~F.col("is_header"))
    options = {**CSV_OPTIONS, "columnNameOfCorruptRecord": REJECTED, "mode": "PERMISSIVE"}
    rows = (
        quoted_records(spark, files)
        .where((F.col("record") != "") & is_row)
        .select(F.from_csv("record", csv_schema(columns), options).alias("row"), F.col("file").alias("_SOURCE_PATH"))
    )
    return rows.select("row.*", "_SOURCE_PATH")
