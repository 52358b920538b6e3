"""Gold tables: dimensions and the fact table at order-item grain.

``hot_from`` is that of ``lookup_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import codes, numbers, times
from martwright.operators.bloom import bloom_filter
from martwright.operators.dedup import ascending, keep_first
from martwright.operators.lookup import lookup_join


def _positions(geolocation: DataFrame, prefix: str) -> DataFrame:
    return geolocation.select(
        F.col("geolocation_zip_code_prefix").alias("_zip"),
        F.col("geolocation_lat").alias(f"{prefix}_lat"),
        F.col("geolocation_lng").alias(f"{prefix}_lng"),
    )


def dim_customers(customers: DataFrame, geolocation: DataFrame, hot_from: DataFrame | None = None) -> DataFrame:
    """One row per person, with the position of the zip code and the macro-region.

    ``customer_id`` is the person; ``customer_order_id`` is one (the smallest) of the
    ids their orders carry, so orders under another of their ids find no match here.
    """
    people = keep_first(customers, ["customer_unique_id"], ascending("customer_id")).select(
        F.col("customer_unique_id").alias("customer_id"),
        F.col("customer_id").alias("customer_order_id"),
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )
    placed = lookup_join(
        people,
        _positions(geolocation, "customer"),
        "customer_zip_code_prefix",
        "_zip",
        spread_by=["customer_id"],
        hot_from=customers if hot_from is None else hot_from,
    )
    return placed.select(
        "customer_id",
        "customer_order_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
        codes.region_of(F.col("customer_state")).alias("customer_region"),
        "customer_lat",
        "customer_lng",
    )


def dim_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Sellers with the position of their zip code and the macro-region.

    Both sides have one row per zip code, so no key can be hot.
    """
    positions = _positions(geolocation, "seller").withColumnRenamed("_zip", "seller_zip_code_prefix")
    return sellers.join(positions, "seller_zip_code_prefix", "left").select(
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
        "seller_lat",
        "seller_lng",
        codes.region_of(F.col("seller_state")).alias("seller_region"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    """Products with weight class (no weight counts as very heavy), photo tier and density."""
    # fixed values: limits of the weight classes in grams, and of the photo tiers
    weight, photos = F.col("product_weight_g"), F.col("product_photos_qty")
    weight_class = numbers.banded(
        [(weight < 300, F.lit("light")), (weight < 2000, F.lit("medium")), (weight < 10000, F.lit("heavy"))],
        "very_heavy",
    )
    photo_tier = numbers.banded(
        [(photos == 0, F.lit("no_photo")), (photos == 1, F.lit("single_photo")), (photos <= 3, F.lit("few_photos"))],
        "many_photos",
    )
    return products.select(
        "product_id",
        "product_category_name",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_volume_cm3",
        "is_uncategorized",
        "has_outlier_dimensions",
        weight_class.alias("weight_class"),
        photo_tier.alias("photo_tier"),
        numbers.safe_ratio(weight, F.col("product_volume_cm3"), 4).alias("density_g_per_cm3"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Payment facts of an order in one aggregation.

    The primary type is that of the highest payment; among equal payments the
    alphabetically last type.
    """
    types = F.collect_set("payment_type")
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment_value"),
        F.max("payment_installments").alias("max_installments"),
        F.min("payment_installments").alias("min_installments"),
        F.array_join(F.array_sort(types), ", ").alias("payment_types_used"),
        F.size(types).cast("bigint").alias("num_payment_methods"),
        (F.size(types) > 1).alias("is_split_payment"),
        F.max_by("payment_type", F.struct("payment_value", "payment_type")).alias("primary_payment_type"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """Review facts of an order."""
    return reviews.groupBy("order_id").agg(
        F.max("review_score").alias("review_score"),
        F.count("review_id").alias("review_count"),
        F.max("review_creation_date").alias("review_creation_date"),
        (F.count_if(F.col("review_comment_message").isNotNull()) > 0).alias("has_review_comment"),
    )


def order_facts(orders: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order with its payment, review and delivery facts.

    All three inputs have one row per order here, so no key can be hot in these joins.
    """
    score = F.col("review_score")
    purchase, approved = "order_purchase_timestamp", "order_approved_at"
    delivered, estimated = "order_delivered_customer_date", "order_estimated_delivery_date"
    return (
        orders.join(payments_per_order(payments), "order_id", "left")
        .join(reviews_per_order(reviews), "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            F.to_date(purchase).alias("purchase_date"),
            F.to_date(approved).alias("approved_date"),
            F.to_date("order_delivered_carrier_date").alias("carrier_date"),
            F.to_date(delivered).alias("delivered_date"),
            F.to_date(estimated).alias("estimated_delivery_date"),
            "order_status",
            purchase,
            approved,
            "order_delivered_carrier_date",
            delivered,
            estimated,
            "total_payment_value",
            "max_installments",
            "min_installments",
            "payment_types_used",
            "num_payment_methods",
            "is_split_payment",
            "primary_payment_type",
            "review_score",
            "review_count",
            "review_creation_date",
            "has_review_comment",
            times.day_diff(purchase, approved).alias("approval_time_days"),
            times.day_diff(purchase, delivered).alias("actual_delivery_days"),
            times.day_diff(purchase, estimated).alias("estimated_delivery_days"),
            times.day_diff(estimated, delivered).alias("delivery_delta_days"),
            numbers.flag(F.col(delivered) <= F.col(estimated)).alias("is_on_time"),
            numbers.flag(F.col(delivered) > F.col(estimated)).alias("is_late"),
            numbers.banded(
                [
                    (score >= 4, F.lit("positive")),
                    (score == 3, F.lit("neutral")),
                    (score <= 2, F.lit("negative")),
                ],
                "no_review",
            ).alias("review_sentiment"),
        )
    )


# Columns of the fact table.
FACT_COLUMNS = (
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "customer_id",
    "purchase_date",
    "approved_date",
    "carrier_date",
    "delivered_date",
    "estimated_delivery_date",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "item_price",
    "item_freight",
    "item_total_revenue",
    "shipping_limit_date",
    "total_payment_value",
    "max_installments",
    "min_installments",
    "payment_types_used",
    "num_payment_methods",
    "is_split_payment",
    "primary_payment_type",
    "review_score",
    "review_count",
    "review_creation_date",
    "has_review_comment",
    "approval_time_days",
    "actual_delivery_days",
    "estimated_delivery_days",
    "delivery_delta_days",
    "is_on_time",
    "is_late",
    "review_sentiment",
)


def fact_orders(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    hot_from: DataFrame | None = None,
    bloom: bool = False,
) -> DataFrame:
    """Order items of surviving orders with all facts of their order.

    Order-level facts repeat on every item of the order, so they must not be summed over items. With ``bloom``, items of other orders are
    left out where they are read, by a Bloom filter of the order ids: for ``orders`` that are stored, and so are cheap to read once more.
    """
    if bloom:
        items = items.where(bloom_filter(orders, "order_id").passes("order_id"))
    priced = items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.col("price").alias("item_price"),
        F.col("freight_value").alias("item_freight"),
        (F.col("price") + F.col("freight_value")).alias("item_total_revenue"),
        "shipping_limit_date",
    )
    by_order = order_facts(orders, payments, reviews).withColumnRenamed("order_id", "_order_id")
    return lookup_join(
        priced, by_order, "order_id", "_order_id", spread_by=["order_item_id"], how="inner", hot_from=hot_from
    ).select(*FACT_COLUMNS)
