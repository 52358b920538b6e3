"""Semantic star join over the fact table, and the marts that show parts of it.

Every dimension has one row per join key, so a join to it neither drops nor repeats fact
rows. A mart therefore joins only the dimensions whose columns it shows, and equals the
projection of the full star join.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Dimension:
    """How the fact table refers to a dimension, and the columns shown of it."""

    table: str
    fact_key: str
    key: str
    columns: tuple[str, ...]


DIMENSIONS = (
    Dimension("dim_customers", "customer_id", "customer_order_id", ("customer_region", "customer_state")),
    Dimension("dim_products", "product_id", "product_id", ("product_category_name",)),
    Dimension("dim_sellers", "seller_id", "seller_id", ("seller_region", "seller_state")),
)

# View -> its columns. All but the first are marts for one group of users.
VIEWS = {
    "semantic_orders": (
        "order_id",
        "order_item_id",
        "purchase_date",
        "customer_region",
        "customer_state",
        "product_category_name",
        "seller_region",
        "seller_state",
        "order_status",
        "review_sentiment",
        "primary_payment_type",
        "item_total_revenue",
        "is_on_time",
        "is_late",
        "delivery_delta_days",
    ),
    "semantic_finance_orders": ("purchase_date", "order_id", "primary_payment_type", "item_total_revenue"),
    "semantic_marketing_orders": (
        "purchase_date",
        "customer_region",
        "customer_state",
        "product_category_name",
        "item_total_revenue",
        "review_sentiment",
    ),
    "semantic_ops_orders": (
        "purchase_date",
        "seller_region",
        "seller_state",
        "is_on_time",
        "is_late",
        "delivery_delta_days",
    ),
}


def dimensions_of(view: str) -> list[Dimension]:
    """The dimensions a view needs."""
    return [d for d in DIMENSIONS if set(d.columns) & set(VIEWS[view])]


def star_join(view: str, fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """The columns of ``view``, one row per fact row, by the text that the catalog view has."""
    needed = [d.table for d in dimensions_of(view)]
    text = view_sql(view, "{fact}", {table: f"{{{table}}}" for table in needed})
    return fact.sparkSession.sql(text, fact=fact, **{table: dimensions[table] for table in needed}).drop("loaded_at")


def view_sql(view: str, fact: str, dimensions: Mapping[str, str]) -> str:
    """SELECT text of ``view`` over stored tables, for a catalog view.

    Items of an order whose customer id is not the one kept in the customer dimension, or
    whose seller was dropped, have NULL there.

    The tables are read directly by the joins, so adaptive execution sees their real sizes:
    it broadcasts small dimensions and splits the partitions of hot keys.
    """
    needed = dimensions_of(view)
    source = {column: d.table for d in needed for column in d.columns}
    columns = ",\n    ".join(f"{source.get(c, 'fact')}.{c}" for c in VIEWS[view])
    joins = "".join(
        f"\nLEFT JOIN {dimensions[d.table]} AS {d.table} ON fact.{d.fact_key} = {d.table}.{d.key}" for d in needed
    )
    return f"SELECT\n    {columns},\n    current_timestamp() AS loaded_at\nFROM {fact} AS fact{joins}"
