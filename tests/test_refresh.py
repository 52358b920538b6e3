"""The whole refresh: CSV files in, tables and views out."""

from __future__ import annotations

import csv
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import inputs
from martwright.plans import monitoring, refresh, semantic
from martwright.sources.tables import Layout, rebuild_table, route_schema

DATA = "/root/testdata/sf0.001"
FILES = {
    "customers": "customers.csv",
    "geolocation": "geolocation.csv",
    "orders": "orders.CSV",
    "items": "order_items.csv",
    "payments": "order_payments.csv",
    "reviews": "order_reviews.csv",
    "products": "products.csv",
    "sellers": "sellers.csv",
    "translation": "category_translation.csv",
}


def test_schema_routing():
    assert route_schema(" GOLDLAYER ", "main") == "GOLDLAYER"
    assert route_schema(None, "main") == "main"
    layout = Layout(default="main", bronze=None)
    assert layout.name("bronze", "RAW_X") == "`main`.`RAW_X`"
    assert layout.name("semantic", "v") == "`analytics`.`v`"


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """The landings of the registered queries as CSV files."""
    directory = tmp_path_factory.mktemp("landing")
    for name, file_name in FILES.items():
        df = getattr(inputs, f"raw_{name}")(spark, lambda t: spark.read.parquet(f"{DATA}/{t}.parquet"))
        with open(directory / file_name, "w", newline="") as f:
            writer = csv.writer(f)
            writer.writerow(df.columns)
            writer.writerows(df.collect())
    return str(directory)


def contents(spark, layout, layer, tables) -> dict[str, Counter]:
    return {t: Counter(map(tuple, spark.table(layout.name(layer, t)).drop("loaded_at").collect())) for t in tables}


def test_refresh_twice_gives_the_same_tables(spark, landing):
    layout = Layout()
    as_of = dt.date(2020, 1, 1)
    refresh.refresh(spark, landing, layout=layout, as_of=as_of)
    gold_tables = [*refresh.DIMENSIONS, "dim_dates", "fact_orders"]
    first = {
        **contents(spark, layout, "silver", refresh.SILVER),
        **contents(spark, layout, "gold", gold_tables),
        **contents(spark, layout, "semantic", semantic.VIEWS),
    }
    assert all(first.values()), "a table is empty"
    loaded = layout.source(spark, "reviews").count()

    # the landings are appended again; deduplication absorbs them
    refresh.refresh(spark, landing, layout=layout, as_of=as_of)
    assert layout.source(spark, "reviews").count() == 2 * loaded
    second = {
        **contents(spark, layout, "silver", refresh.SILVER),
        **contents(spark, layout, "gold", gold_tables),
        **contents(spark, layout, "semantic", semantic.VIEWS),
    }
    assert second == first

    check_keys(spark, layout)
    check_logs(spark, layout)
    for name in ("silver", "gold"):
        table = "customers" if name == "silver" else "dim_customers"
        kind = dict(spark.table(layout.name(name, table)).dtypes)["loaded_at"]
        assert kind == ("timestamp_ntz" if name == "silver" else "timestamp")


def check_keys(spark, layout):
    keys = {
        ("silver", "customers"): ["customer_id"],
        ("silver", "geolocation"): ["geolocation_zip_code_prefix"],
        ("silver", "order_items"): ["order_id", "order_item_id"],
        ("silver", "order_payments"): ["order_id", "payment_sequential"],
        ("silver", "order_reviews"): ["review_id"],
        ("silver", "orders"): ["order_id"],
        ("silver", "products"): ["product_id"],
        ("silver", "sellers"): ["seller_id"],
        ("gold", "dim_customers"): ["customer_id"],
        ("gold", "dim_dates"): ["date_id"],
        ("gold", "dim_products"): ["product_id"],
        ("gold", "dim_sellers"): ["seller_id"],
        ("gold", "fact_orders"): ["order_id", "order_item_id"],
    }
    for (layer, table), key in keys.items():
        df = spark.table(layout.name(layer, table))
        assert df.groupBy(*key).count().where("count > 1").count() == 0, table
    sellers = spark.table(layout.name("silver", "sellers"))
    assert sellers.groupBy("seller_zip_code_prefix").count().where("count > 1").count() == 0
    items, orders = (spark.table(layout.name("silver", t)) for t in ("order_items", "orders"))
    fact = spark.table(layout.name("gold", "fact_orders"))
    assert fact.count() == items.join(orders, "order_id", "left_semi").count()
    assert spark.table(layout.name("semantic", "semantic_orders")).count() == fact.count()
    dims = spark.table(layout.name("gold", "dim_customers"))
    regions = {"Southeast", "South", "Northeast", "North", "Center-West", "Unknown"}
    assert {r[0] for r in dims.select("customer_region").distinct().collect()} <= regions
    assert spark.table(layout.name("gold", "dim_dates")).agg(F.max("date_id")).first()[0] == dt.date(2020, 1, 1)


def check_logs(spark, layout):
    runs = spark.table(layout.name("log", refresh.RUN_LOG))
    history = monitoring.run_history(runs).collect()
    assert [r["name"] for r in history] == ["gold", "silver", "bronze"] * 2
    assert all(r["state"] == "SUCCEEDED" and r["duration_sec"] >= 0 for r in history)
    logs = monitoring.recent_logs(spark.table(layout.name("log", refresh.EVENT_LOG))).collect()
    assert {r["severity"] for r in logs} == {"INFO"} and len(logs) == 6
    assert any("`RAW_ORDERS`" in r["message"] and "rows loaded" in r["message"] for r in logs)


def test_a_failing_layer_is_logged_and_stops_the_refresh(spark):
    layout = Layout(
        bronze="empty_bronze", silver="empty_silver", gold="empty_gold", semantic="empty_semantic", log="empty_log"
    )
    with pytest.raises(Exception, match="RAW_CUSTOMERS"):
        refresh.refresh(spark, layers=("silver", "gold"), layout=layout)
    (run,) = monitoring.failed_runs(spark.table(layout.name("log", refresh.RUN_LOG))).collect()
    assert run["name"] == "silver" and "RAW_CUSTOMERS" in run["error_message"]
    (line,) = monitoring.recent_logs(spark.table(layout.name("log", refresh.EVENT_LOG))).collect()
    assert line["severity"] == "ERROR"


def test_a_failing_rebuild_keeps_the_table(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS rebuild_test")
    name = "`rebuild_test`.`t`"
    for n in (3, 5):
        rebuild_table(spark.range(n).toDF("id"), name)
    assert spark.table(name).count() == 5
    failing = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        rebuild_table(failing, name)
    assert spark.table(name).count() == 5
    rebuild_table(spark.range(2).toDF("id"), name)
    assert spark.table(name).count() == 2


def test_a_sorted_rebuild_lets_a_filter_skip_files(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS rebuild_test")
    name = "`rebuild_test`.`days`"
    # one day holds a third of the rows
    day = F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 100)
    days = spark.range(6000).select(F.date_add(F.lit(dt.date(2020, 1, 1)), day.cast("int")).alias("purchase_date"), "id")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # the rows here would fit one file
    try:
        rebuild_table(days.repartition(6), name, sort_by=("purchase_date", "id"))
    finally:
        spark.conf.unset(setting)
    files = spark.table(name).groupBy(F.input_file_name()).agg(F.min("purchase_date").alias("a"), F.max("purchase_date").alias("b"), F.count("*").alias("n")).collect()
    one = dt.date(2020, 1, 11)
    assert len(files) > 1 and sum(f["a"] <= one <= f["b"] for f in files) == 1
    assert max(f["n"] for f in files) < 2 * 6000 / len(files)
