"""The registered queries: name -> function of (spark, directory of Parquet tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import inputs
from martwright.operators.calendar import date_dimension
from martwright.plans import gold, monitoring, semantic, silver

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals and doubles as doubles of six decimals, the form the oracle has them in."""
    fractions = (T.DecimalType, T.DoubleType)
    return df.select(
        *[
            F.round(F.col(f.name).cast("double"), 6).alias(f.name) if isinstance(f.dataType, fractions) else f.name
            for f in df.schema.fields
        ]
    )


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: a test table is one row group, so that one task would render and parse its whole landing."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def dealt(name: str, df: DataFrame) -> DataFrame:
    """The large tables over all cores; a shuffle of a small one would cost more than it brings."""
    return spread(df) if name in ("lineitem", "events") else df


class Layers:
    """The layered tables over one directory, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        # one DataFrame per file and landing: reading the schema of a file is a job of its own
        self.table = cache(lambda name: dealt(name, spark.read.parquet(f"{sf_dir}/{name}.parquet")))
        self.raw = cache(lambda name: getattr(inputs, f"raw_{name}")(spark, self.table))
        self.geolocation = cache(lambda: silver.silver_geolocation(self.raw("geolocation")))

    def customers(self) -> DataFrame:
        return silver.silver_customers(self.raw("customers"))

    def items(self) -> DataFrame:
        return silver.silver_order_items(self.raw("items"))

    def payments(self) -> DataFrame:
        return silver.silver_payments(self.raw("payments"))

    def reviews(self) -> DataFrame:
        return silver.silver_reviews(self.raw("reviews"))

    def orders(self) -> DataFrame:
        return silver.silver_orders(self.raw("orders"))

    def products(self) -> DataFrame:
        return silver.silver_products(self.raw("products"), self.raw("translation"))

    def sellers(self) -> DataFrame:
        return silver.silver_sellers(self.raw("sellers"))

    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.customers(), self.geolocation(), hot_from=self.raw("customers"))

    def dim_sellers(self) -> DataFrame:
        return gold.dim_sellers(self.sellers(), self.geolocation())

    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.products())

    def dim_dates(self) -> DataFrame:
        """The calendar from the first to the last order date."""
        days = self.table("orders").select(F.to_date("o_orderdate").alias("day"))
        first, last = days.agg(F.min("day")).scalar(), days.agg(F.max("day")).scalar()
        return date_dimension(self.spark, first, as_of=last)

    def fact(self) -> DataFrame:
        return gold.fact_orders(
            self.orders(), self.items(), self.payments(), self.reviews(), hot_from=self.raw("items")
        )

    def view(self, name: str) -> DataFrame:
        build = {
            "dim_customers": self.dim_customers,
            "dim_products": self.dim_products,
            "dim_sellers": self.dim_sellers,
        }
        dimensions = {d.table: build[d.table]() for d in semantic.dimensions_of(name)}
        return semantic.star_join(name, self.fact(), dimensions)

    def newest_event(self):
        return self.table("events").agg(F.max("ts")).scalar()

    def recent_logs(self) -> DataFrame:
        return monitoring.recent_logs(monitoring.with_record(inputs.event_log(self.spark, self.table)), self.newest_event())

    def run_history(self) -> DataFrame:
        return monitoring.run_history(inputs.run_log(self.spark, self.table), self.newest_event())

    def failed_runs(self) -> DataFrame:
        return monitoring.failed_runs(inputs.run_log(self.spark, self.table))


# Each entry builds its query from the layers; `queries` makes the result comparable.
BUILDERS: dict[str, Callable[[Layers], DataFrame]] = {
    "silver_customers": Layers.customers,
    "silver_geolocation": lambda t: t.geolocation(),
    "silver_order_items": Layers.items,
    "silver_payments": Layers.payments,
    "silver_reviews": Layers.reviews,
    "silver_orders": Layers.orders,
    "silver_products": Layers.products,
    "silver_sellers": Layers.sellers,
    "iqr_bounds_payments": lambda t: silver.payment_bounds(t.raw("payments")),
    "iqr_bounds_delivery_days": lambda t: silver.delivery_bounds(t.raw("orders")),
    "dim_customers": Layers.dim_customers,
    "dim_sellers": Layers.dim_sellers,
    "dim_products": Layers.dim_products,
    "dim_dates": Layers.dim_dates,
    "payments_per_order": lambda t: gold.payments_per_order(t.payments()),
    "reviews_per_order": lambda t: gold.reviews_per_order(t.reviews()),
    "fact_orders": Layers.fact,
    "semantic_orders": lambda t: t.view("semantic_orders"),
    "mart_finance": lambda t: t.view("semantic_finance_orders"),
    "mart_marketing": lambda t: t.view("semantic_marketing_orders"),
    "mart_ops": lambda t: t.view("semantic_ops_orders"),
    "recent_logs": Layers.recent_logs,
    "run_history": Layers.run_history,
    "failed_runs": Layers.failed_runs,
}


def queries() -> dict[str, Query]:
    def query(build: Callable[[Layers], DataFrame]) -> Query:
        return lambda spark, sf_dir: comparable(build(Layers(spark, sf_dir)))

    return {name: query(build) for name, build in BUILDERS.items()}
