"""Catalog tables and views: names, full rebuilds and load timestamps."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared sources: logical name -> landing table. Replace entries whose files are named differently.
SOURCES = {
    "customers": "RAW_CUSTOMERS",
    "geolocation": "RAW_GEOLOCATION",
    "orders": "RAW_ORDERS",
    "items": "RAW_ORDER_ITEMS",
    "payments": "RAW_ORDER_PAYMENTS",
    "reviews": "RAW_ORDER_REVIEWS",
    "products": "RAW_PRODUCTS",
    "sellers": "RAW_SELLERS",
    "translation": "RAW_CATEGORY_TRANSLATION",
}


# Between a table's name and its version, and the text of a name that points to one.
_VERSION = "__v"
_POINTER = "SELECT * FROM "


def route_schema(custom: str | None, default: str) -> str:
    """Schema of a table: the custom name as given (trimmed), else the default."""
    return default if custom is None else custom.strip()


@dataclass(frozen=True)
class Layout:
    """Where each layer lives. A schema of ``None`` falls back to ``default``."""

    default: str = "default"
    bronze: str | None = "BRONZELAYER"
    silver: str | None = "SILVERLAYER"
    gold: str | None = "GOLDLAYER"
    semantic: str | None = "analytics"
    log: str | None = "INTEGRATIONS"
    sources: Mapping[str, str] = field(default_factory=lambda: dict(SOURCES))

    def schema(self, layer: str) -> str:
        return route_schema(getattr(self, layer), self.default)

    def name(self, layer: str, table: str) -> str:
        return f"`{self.schema(layer)}`.`{table}`"

    def source(self, spark: SparkSession, logical: str) -> DataFrame:
        """A declared source table."""
        return spark.table(self.name("bronze", self.sources[logical]))

    def create_schemas(self, spark: SparkSession) -> None:
        for layer in ("bronze", "silver", "gold", "semantic", "log"):
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{self.schema(layer)}`")


def stamped(df: DataFrame, with_zone: bool = False) -> DataFrame:
    """``df`` with the time of its build in ``loaded_at``."""
    return df.withColumn("loaded_at", F.current_timestamp() if with_zone else F.localtimestamp())


def quoted(name: str, suffix: str = "") -> str:
    """A table's name with ``suffix`` added to its last part, inside the backquotes if it has them."""
    return f"{name[:-1]}{suffix}`" if name.endswith("`") else f"{name}{suffix}"


def current_version(spark: SparkSession, name: str) -> str | None:
    """The stored table that ``name`` points to; ``None`` if there is no pointer of that name."""
    if not spark.catalog.tableExists(name):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()
    return described["data_type"].removeprefix(_POINTER) if described else None


def versions(spark: SparkSession, name: str) -> list[str]:
    """The stored versions of ``name``, oldest first, those of rebuilds that failed among them."""
    schema, _, table = name.rpartition(".")
    stem = f"{table.strip('`')}{_VERSION}"
    tables = spark.sql(f"SHOW TABLES IN {schema}" if schema else "SHOW TABLES").select("tableName").collect()
    found = sorted(t for (t,) in tables if t.lower().startswith(stem.lower()))
    return [f"{schema}.`{t}`" if schema else f"`{t}`" for t in found]


def store_version(df: DataFrame, name: str, sort_by: Sequence[str] = ()) -> str:
    """``df`` as a new stored version of ``name``, which nothing points to yet."""
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    moment = dt.datetime.now(dt.UTC).strftime("%Y%m%d%H%M%S%f")
    version = quoted(name, f"{_VERSION}{moment}_{uuid.uuid4().hex[:8]}")
    df.write.saveAsTable(version)
    return version


def point_to(spark: SparkSession, name: str, version: str) -> None:
    """Let ``name`` be ``version`` from now on: one change of one entry of the catalog.

    ``ALTER VIEW`` replaces the text of the entry, where ``CREATE OR REPLACE VIEW`` drops it first. A plain table of that name, from before there
    were versions, becomes the oldest version; only that once there is a moment without the name.
    """
    if spark.catalog.tableExists(name):
        if current_version(spark, name) is not None:
            spark.sql(f"ALTER VIEW {name} AS {_POINTER}{version}")
            return
        spark.sql(f"ALTER TABLE {name} RENAME TO {quoted(name, f'{_VERSION}0')}")
    spark.sql(f"CREATE VIEW {name} AS {_POINTER}{version}")


def rebuild_table(df: DataFrame, name: str, sort_by: Sequence[str] = ()) -> str:
    """Full rebuild of a stored table: a new version beside the present one, then the name is pointed to it.

    Readers find the old rows or the new ones, whenever they look and wherever a rebuild stops. The version before stays until the next rebuild, for queries
    that have begun on it; older ones, and those of rebuilds that failed since, are dropped. With ``sort_by`` the rows are dealt by ranges of those
    columns and sorted in the files, whose statistics then let a filter on them skip files.
    """
    spark = df.sparkSession
    version = store_version(df, name, sort_by)
    before = current_version(spark, name)
    point_to(spark, name, version)
    # versions are named by time: one that another rebuild is writing now is not older
    last = [v for v in versions(spark, name) if v < version]
    kept = before if before is not None else last[-1] if last else None
    for old in last:
        if kept is None or old.replace("`", "").lower() != kept.replace("`", "").lower():
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    return version


def replace_view(spark: SparkSession, name: str, sql: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS\n{sql}")
