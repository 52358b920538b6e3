"""Compare registered queries with their DuckDB statements.

``python -m checks.compare DIRECTORY [NAME ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import oracle_sql
from checks.registry import queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> tuple[int, list[str]]:
    """Number of rows and what differs, as text lines (none if both sides are the same bag)."""
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(tuple(row) for row in df.select(*columns).collect())
    cursor = con.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return sum(ours.values()), [f"columns {columns} against {sorted(names)}"]
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    extra, missing = ours - theirs, theirs - ours
    lines = []
    if extra or missing:
        lines.append(f"{sum(extra.values())} rows only in Spark, {sum(missing.values())} only in DuckDB")
        lines += [f"  spark  {row}" for row in list(extra)[:2]] + [f"  duckdb {row}" for row in list(missing)[:2]]
    return sum(ours.values()), lines


def main(sf_dir: str, names: list[str]) -> int:
    from martwright.session import build_session

    conf = {"spark.master": "local[8]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    spark = build_session("compare", {**conf, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names or queries():
        start, con = time.time(), connect(sf_dir)  # a failed statement can make a connection useless
        try:
            rows, lines = difference(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            rows, lines = 0, [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'DIFF' if lines else 'same'} {name}: {rows} rows, {time.time() - start:.1f} s", flush=True)
        for line in lines:
            print(line[:1500])
        bad += bool(lines)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
