"""Logs that are appended to a few rows at a time, and read by time.

A log is a name over two stored tables: an archive, partitioned by day, and the recent appends. Once there are ``APPENDS`` of these, their rows
go to the archive, one file per day, and a new recent table begins. The rows that are on their way are marked with the recent table they come from, and
the name shows archived rows of other marks only, so the one change of the name's text moves them from one table to the other: whenever
the work stops, each row is seen once. A day has a file per ``APPENDS`` appends, and a filter on ``day`` reads the days asked for alone.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.sources.tables import quoted

# Appends after which the recent rows are archived.
APPENDS = 20
DAY = "day"
_BATCH = "batch"
# The day of rows without a time.
_NO_TIME = dt.date(1970, 1, 1)


class Log:
    """A log of rows with the columns ``schema`` and the day of their ``time`` column; one program at a time writes to it."""

    def __init__(self, spark: SparkSession, name: str, schema: str, time: str, appends: int = APPENDS):
        self.spark, self.name, self.schema, self.time, self.appends = spark, name, schema, time, appends
        self._archive = quoted(name, "__archive")

    def _recent(self, batch: str) -> str:
        return quoted(self.name, f"__recent_{batch}")

    def _text(self, batch: str) -> str:
        """What the name stands for: the archive less the rows of ``batch``, and those as they were appended."""
        columns = ", ".join(f"`{c}`" for c in [*self._columns(), DAY])
        return f"SELECT {columns} FROM {self._archive} WHERE {_BATCH} <> '{batch}' UNION ALL SELECT {columns} FROM {self._recent(batch)}"

    def _day(self) -> Column:
        return F.coalesce(F.col(self.time).cast("date"), F.lit(_NO_TIME)).alias(DAY)

    def _columns(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def batch(self) -> str | None:
        """Mark of the present recent table; ``None`` before the first append."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'View Text'").first()
        return re.search(rf"{_BATCH} <> '(\w+)'", described["data_type"])[1]

    def _plain(self, batch: str) -> str:
        return self._recent(batch).rpartition(".")[2].strip("`").lower()

    def _recent_tables(self) -> set[str]:
        schema = self.name.rpartition(".")[0]
        tables = self.spark.sql(f"SHOW TABLES IN {schema}" if schema else "SHOW TABLES").select("tableName").collect()
        return {t.lower() for (t,) in tables if t.lower().startswith(self._plain(""))}

    def _begin(self) -> str:
        """A new, empty recent table."""
        batch = uuid.uuid4().hex
        empty = self.spark.createDataFrame([], self.schema).select("*", self._day())
        empty.write.saveAsTable(self._recent(batch))
        if not self.spark.catalog.tableExists(self._archive):
            empty.withColumn(_BATCH, F.lit("")).write.partitionBy(DAY, _BATCH).saveAsTable(self._archive)
        return batch

    def append(self, rows: Sequence[tuple] | DataFrame) -> None:
        """Add rows, as one file, and archive the recent ones when there are enough."""
        df = rows if isinstance(rows, DataFrame) else self.spark.createDataFrame(rows, self.schema)
        batch = self.batch()
        if batch is None:
            batch = self._begin()
            self.spark.sql(f"CREATE VIEW {self.name} AS {self._text(batch)}")
        df.select(*self._columns()).coalesce(1).select("*", self._day()).write.mode("append").saveAsTable(self._recent(batch))
        if len(self.spark.table(self._recent(batch)).inputFiles()) > self.appends:
            self.compact()

    def compact(self) -> None:
        """Archive the recent rows."""
        batch = self.batch()
        if batch is None:
            return
        # what an earlier attempt that stopped has left; nobody has seen it
        for (place,) in self.spark.sql(f"SHOW PARTITIONS {self._archive}").collect():
            day, _, mark = place.removeprefix(f"{DAY}=").partition(f"/{_BATCH}=")
            if mark == batch:
                self.spark.sql(f"ALTER TABLE {self._archive} DROP IF EXISTS PARTITION ({DAY} = DATE'{day}', {_BATCH} = '{batch}')")
        recent = self.spark.table(self._recent(batch)).withColumn(_BATCH, F.lit(batch))
        recent.repartition(DAY).sortWithinPartitions(DAY, self.time).write.mode("append").insertInto(self._archive)
        after = self._begin()
        self.spark.sql(f"ALTER VIEW {self.name} AS {self._text(after)}")
        # the one just archived stays for queries that have begun on it
        for old in self._recent_tables() - {self._plain(batch), self._plain(after)}:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name.rpartition('.')[0]}{'.' * ('.' in self.name)}`{old}`")

    def read(self) -> DataFrame:
        """All rows; of a log without any, none."""
        if self.spark.catalog.tableExists(self.name):
            return self.spark.table(self.name)
        return self.spark.createDataFrame([], self.schema).select("*", self._day())
