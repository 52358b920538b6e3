"""Layered refresh: landings, then silver tables, then gold tables and semantic views.

Every layer reads the stored tables of the layer before, so each table is computed once,
and a lost executor costs at most the stages of one table. Each layer leaves a row in the
run log and lines in the event log, which ``martwright.plans.monitoring`` reads. Each table leaves a row in the log of tables, from which
a run that was cut off can be gone on with.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators.calendar import date_dimension
from martwright.plans import gold, semantic, silver
from martwright.plans.monitoring import with_record
from martwright.sources.landing import LandingTable, LoadResult, landing_tables, load, load_audit
from martwright.sources.logs import Log
from martwright.sources.tables import Layout, rebuild_table, replace_view, stamped

LAYERS = ("bronze", "silver", "gold")
RUN_LOG = "run_log"
EVENT_LOG = "pipeline_events"
TABLE_LOG = "table_runs"
LOAD_AUDIT = "load_audit"
SCHEMAS = {
    RUN_LOG: "name string, state string, scheduled_time timestamp_ntz, completed_time timestamp_ntz, error_message string",
    EVENT_LOG: "timestamp timestamp_ntz, record variant, value string",
    TABLE_LOG: "run_id string, layer string, table_name string, state string, started_time timestamp_ntz, completed_time timestamp_ntz",
}
# Layer and table of the row that ends a run.
RUN_END = ("run", "end")

Read = Callable[[str], DataFrame]

# Silver table -> its query over the declared sources.
SILVER: dict[str, Callable[[Read], DataFrame]] = {
    "customers": lambda source: silver.silver_customers(source("customers")),
    "geolocation": lambda source: silver.silver_geolocation(source("geolocation")),
    "order_items": lambda source: silver.silver_order_items(source("items")),
    "order_payments": lambda source: silver.silver_payments(source("payments")),
    "order_reviews": lambda source: silver.silver_reviews(source("reviews")),
    "orders": lambda source: silver.silver_orders(source("orders")),
    "products": lambda source: silver.silver_products(source("products"), source("translation")),
    "sellers": lambda source: silver.silver_sellers(source("sellers")),
}

# Gold dimension -> its query over the silver tables.
DIMENSIONS: dict[str, Callable[[Read], DataFrame]] = {
    "dim_customers": lambda table: gold.dim_customers(table("customers"), table("geolocation")),
    "dim_products": lambda table: gold.dim_products(table("products")),
    "dim_sellers": lambda table: gold.dim_sellers(table("sellers"), table("geolocation")),
}


Step = Callable[[], object]


def silver_steps(spark: SparkSession, layout: Layout) -> dict[str, Step]:
    def step(name: str, query: Callable[[Read], DataFrame]) -> Step:
        return lambda: rebuild_table(stamped(query(lambda logical: layout.source(spark, logical))), layout.name("silver", name))

    return {name: step(name, query) for name, query in SILVER.items()}


def gold_steps(spark: SparkSession, layout: Layout, as_of: dt.date | None = None) -> dict[str, Step]:
    """Dimensions, fact table and semantic views; ``as_of`` ends the calendar (today by default)."""

    def table(name: str) -> DataFrame:
        return spark.table(layout.name("silver", name)).drop("loaded_at")

    def dimension(name: str, query: Callable[[], DataFrame]) -> Step:
        return lambda: rebuild_table(stamped(query(), with_zone=True), layout.name("gold", name))

    def fact() -> str:
        rows = gold.fact_orders(table("orders"), table("order_items"), table("order_payments"), table("order_reviews"), bloom=True)
        # by purchase date, so that a query of some days or months skips most files; the order splits a busy day
        return rebuild_table(stamped(rows), layout.name("gold", "fact_orders"), sort_by=("purchase_date", "order_id"))

    steps = {name: dimension(name, lambda query=query: query(table)) for name, query in DIMENSIONS.items()}
    steps["dim_dates"] = dimension("dim_dates", lambda: date_dimension(spark, as_of=as_of))
    steps["fact_orders"] = fact
    return steps | {view: lambda view=view: build_view(spark, layout, view) for view in semantic.VIEWS}


def build_view(spark: SparkSession, layout: Layout, view: str) -> None:
    dimensions = {d.table: layout.name("gold", d.table) for d in semantic.DIMENSIONS}
    sql = semantic.view_sql(view, layout.name("gold", "fact_orders"), dimensions)
    replace_view(spark, layout.name("semantic", view), sql)


def bronze_steps(spark: SparkSession, layout: Layout, landing: str, run_id: str) -> dict[str, Step]:
    """One load per landing table; each leaves a row in the audit."""
    audit = load_audit(spark, layout.name("log", LOAD_AUDIT))

    def step(found: LandingTable) -> Step:
        return lambda: load(spark, found, layout.name("bronze", found.table), audit=audit, run_id=run_id)

    return {found.table: step(found) for found in landing_tables(spark, landing)}


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def logs(spark: SparkSession, layout: Layout) -> dict[str, Log]:
    """The logs of a layout: runs, events, and the tables of each run. They are stored by day."""
    times = {RUN_LOG: "scheduled_time", EVENT_LOG: "timestamp", TABLE_LOG: "started_time"}
    return {name: Log(spark, layout.name("log", name), SCHEMAS[name], time) for name, time in times.items()}


def _log_event(log: Log, severity: str, message: str) -> None:
    row = (_now(), json.dumps({"severity_text": severity}), message)
    rows = log.spark.createDataFrame([row], "timestamp timestamp_ntz, record string, value string")
    log.append(with_record(rows))


def unfinished(table_log: Log) -> tuple[str, set[tuple[str, str]]] | None:
    """The newest run, if it has not ended, and the (layer, table) pairs that it has built."""
    rows = table_log.read()
    newest = rows.agg(F.max_by("run_id", F.struct("started_time", "run_id"))).first()[0]
    if newest is None:
        return None
    built = rows.where((F.col("run_id") == newest) & (F.col("state") == "SUCCEEDED")).select("layer", "table_name").collect()
    done = {tuple(r) for r in built}
    return None if RUN_END in done else (newest, done)


def refresh(
    spark: SparkSession,
    landing: str | None = None,
    layers: Sequence[str] = LAYERS,
    layout: Layout | None = None,
    as_of: dt.date | None = None,
    resume: bool = False,
) -> None:
    """Run the given layers in order; a layer starts only when the one before has succeeded.

    ``landing`` is the directory of CSV files, needed for the bronze layer only. With ``resume``, a newest run that has failed or was cut off is gone on with:
    the tables it has built are left as they are, loads that it made aren't made again. If the newest run has ended, a new one begins.
    """
    layout = layout or Layout()
    layout.create_schemas(spark)
    log = logs(spark, layout)
    found = unfinished(log[TABLE_LOG]) if resume else None
    run_id, done = found or (uuid.uuid4().hex, set())

    def record(layer: str, table: str, state: str, started: dt.datetime) -> None:
        log[TABLE_LOG].append([(run_id, layer, table, state, started, _now())])

    def steps(layer: str) -> dict[str, Step]:
        if layer == "bronze":
            return bronze_steps(spark, layout, landing, run_id)
        return silver_steps(spark, layout) if layer == "silver" else gold_steps(spark, layout, as_of)

    def build(layer: str) -> list[str]:
        built = []
        for table, step in steps(layer).items():
            if (layer, table) in done:
                continue
            started = _now()
            try:
                result = step()
            except Exception:
                record(layer, table, "FAILED", started)
                raise
            record(layer, table, "SUCCEEDED", started)
            built.append(result.message() if isinstance(result, LoadResult) else table)
        return built

    for layer in (name for name in LAYERS if name in layers):
        scheduled = _now()
        try:
            built = build(layer)
        except Exception as error:
            _log_event(log[EVENT_LOG], "ERROR", f"{layer}: {error}")
            log[RUN_LOG].append([(layer, "FAILED", scheduled, _now(), str(error))])
            raise
        _log_event(log[EVENT_LOG], "INFO", f"{layer}: {', '.join(built)}")
        log[RUN_LOG].append([(layer, "SUCCEEDED", scheduled, _now(), None)])
    record(*RUN_END, "SUCCEEDED", _now())
