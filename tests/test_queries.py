"""Registered queries against DuckDB, and what their plans must not hold."""

from __future__ import annotations

import pytest

from checks import oracles, registry
from checks.compare import connect, difference
from checks.registry import Layers
from martwright.plans import silver

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_a_statement():
    assert registry.queries().keys() == oracles.oracle_sql().keys()


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_duckdb(spark, duck, name):
    rows, lines = difference(spark, duck, DATA, name)
    assert rows > 0 and lines == []


def test_plans_stay_in_the_jvm_without_cross_joins(spark, plan_of):
    plan = plan_of(registry.queries()["semantic_orders"](spark, DATA))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_deduplication_shuffle_is_shared_with_the_fence(spark, plan_of):
    df = registry.queries()["silver_payments"](spark, DATA)
    df.collect()
    plan = plan_of(df)
    final = plan[: plan.rindex("Initial Plan")]
    assert "ReusedExchange" in final and "ReusedSubquery" in final


def test_scans_of_stored_landings_are_pruned_and_filtered(spark, plan_of, tmp_path):
    layers = Layers(spark, DATA)
    path = str(tmp_path / "items")
    layers.raw("items").selectExpr("*", "'x' AS unused").write.parquet(path)
    plan = plan_of(silver.silver_order_items(spark.read.parquet(path)))
    assert "unused" not in plan
    for name in ("order_id", "product_id", "seller_id", "shipping_limit_date"):
        assert f"IsNotNull({name})" in plan
