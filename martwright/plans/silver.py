"""Silver tables: typed, deduplicated, validated versions of the raw landings.

Raw inputs hold text only. Values that do not parse become NULL instead of failing the
job, and every deduplication has a total order, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions import codes, numbers, text, times
from martwright.operators.dedup import ascending, keep_first
from martwright.operators.lookup import lookup_join
from martwright.operators.outliers import iqr_bounds, keep_inside, outside_flag
from martwright.operators.quality import chronology_flags, drop_flagged, require_not_null
from martwright.operators.quantiles import exact_quantiles

# Bounding box of valid coordinates in degrees.
LATITUDE = (-34, 5)
LONGITUDE = (-74, -34)
# Plausible product weight in grams and size in centimetres.
WEIGHT_G = (10, 50000)
SIZE_CM = (1, 200)

# Range widths for exact quantiles, in units of the value: degrees, money, days.
DEGREE_RANGE = 0.001
MONEY_RANGE = 1024
DAY_RANGE = 64

# Precision and scale of prices: wide, and finer than cents, so that a landing's own scale is kept.
MONEY = (24, 6)

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def silver_customers(raw: DataFrame) -> DataFrame:
    """One row per ``customer_id`` with trimmed city and state."""
    cleaned = require_not_null(raw, "customer_id", "customer_unique_id").select(
        F.col("customer_id").cast("string"),
        F.col("customer_unique_id").cast("string"),
        F.col("customer_zip_code_prefix").cast("string"),
        text.lower_trimmed("customer_city").alias("customer_city"),
        text.upper_trimmed("customer_state").alias("customer_state"),
    )
    order = ascending("customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state")
    return keep_first(cleaned, ["customer_id"], order)


def silver_geolocation(raw: DataFrame) -> DataFrame:
    """One row per zip code: the place name with most distinct points, and their median position.

    ``duplicate_count`` counts distinct points, not raw rows.
    """
    latitude = numbers.to_decimal("geolocation_lat", 10, 8)
    longitude = numbers.to_decimal("geolocation_lng", 11, 8)
    variant = [
        "geolocation_zip_code_prefix",
        "geolocation_city",
        "geolocation_city_original",
        "geolocation_state",
    ]
    points = (
        require_not_null(raw, "geolocation_zip_code_prefix")
        .where(text.not_blank("geolocation_city") & text.not_blank("geolocation_state"))
        .where(latitude.between(*LATITUDE) & longitude.between(*LONGITUDE))
        .select(
            text.pad_zip("geolocation_zip_code_prefix").alias("geolocation_zip_code_prefix"),
            F.trim(text.fold_accents("geolocation_city")).alias("geolocation_city"),
            F.trim("geolocation_city").alias("geolocation_city_original"),
            text.upper_trimmed("geolocation_state").alias("geolocation_state"),
            latitude.cast("decimal(11,8)").alias("lat"),
            longitude.alias("lng"),
        )
        .distinct()
    )
    coordinates = points.unpivot(variant, ["lat", "lng"], "axis", "degrees")
    medians = exact_quantiles(coordinates, "degrees", {"median": "0.5"}, DEGREE_RANGE, by=[*variant, "axis"])

    def median_of(axis: str) -> Column:
        return F.max(F.when(F.col("axis") == axis, F.col("median"))).cast("double")

    variants = medians.groupBy(*variant).agg(
        median_of("lat").alias("geolocation_lat"),
        median_of("lng").alias("geolocation_lng"),
        F.max("n").alias("duplicate_count"),
    )
    most_points = [F.desc("duplicate_count"), *ascending(*variant[1:])]
    return keep_first(variants, ["geolocation_zip_code_prefix"], most_points).select(
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_city_original",
        "geolocation_state",
        "duplicate_count",
    )


def silver_order_items(raw: DataFrame) -> DataFrame:
    """One row per order and item number: the one with the latest shipping limit."""
    typed = (
        require_not_null(raw, "order_id", "product_id", "seller_id", "shipping_limit_date")
        .select(
            "order_id",
            numbers.to_int("order_item_id").alias("order_item_id"),
            "product_id",
            "seller_id",
            times.parse_ts_or_iso("shipping_limit_date").alias("shipping_limit_date"),
            numbers.to_decimal("price", *MONEY).alias("price"),
            numbers.to_decimal("freight_value", *MONEY).alias("freight_value"),
        )
    )
    latest = [
        F.desc_nulls_last("shipping_limit_date"),
        *ascending("product_id", "seller_id", "price", "freight_value"),
    ]
    # numbers that are none, or below 1, fall out after the choice: before it, Spark would parse each number twice
    number = F.coalesce("order_item_id", F.lit(0))
    return keep_first(typed, ["order_id", number], latest).where("order_item_id >= 1")


def deduplicated_payments(raw: DataFrame) -> DataFrame:
    """Typed payments, the highest value per order and sequence number."""
    keyed = require_not_null(raw, "order_id", "payment_sequential").withColumn(
        "_value", numbers.to_number("payment_value")
    )
    # '1' and '1.0' are one number; a number that does not parse stays its own key
    number = numbers.to_int("payment_sequential")
    key = F.coalesce(number.cast("string"), F.col("payment_sequential"))
    highest = [F.desc_nulls_last("_value"), *ascending("payment_type", "payment_installments", "payment_sequential")]
    return keep_first(keyed, ["order_id", key], highest).select(
        "order_id",
        number.alias("payment_sequential"),
        codes.map_synonyms("payment_type", codes.PAYMENT_SYNONYMS).alias("payment_type"),
        numbers.to_int("payment_installments").alias("payment_installments"),
        F.round("_value", 2).alias("payment_value"),
    )


def payment_bounds(raw: DataFrame, k: str = "1.5") -> DataFrame:
    """Fence of the payment value over all deduplicated payments, zero and negative ones included."""
    return iqr_bounds(deduplicated_payments(raw), "payment_value", MONEY_RANGE, k)


def silver_payments(raw: DataFrame, k: str = "1.5") -> DataFrame:
    """Payments with positive value and instalments whose value lies inside the fence."""
    deduplicated = deduplicated_payments(raw)
    bounds = iqr_bounds(deduplicated, "payment_value", MONEY_RANGE, k)
    return keep_inside(deduplicated, "payment_value", bounds).where("payment_installments > 0 AND payment_value > 0")


def silver_reviews(raw: DataFrame) -> DataFrame:
    """One row per ``review_id`` (the newest) with a score of 1 to 5 and cleaned texts.

    A review without an answer time counts as newer than one with.
    """
    score = numbers.to_number("review_score")
    typed = (
        require_not_null(raw, "review_id", "order_id", "review_creation_date")
        .where(score.between(1, 5))
        .select(
            "review_id",
            "order_id",
            numbers.to_int("review_score").alias("review_score"),
            "review_comment_title",
            "review_comment_message",
            times.parse_ts_or_iso("review_creation_date").alias("review_creation_date"),
            times.parse_ts_or_iso("review_answer_timestamp").alias("review_answer_timestamp"),
        )
    )
    newest = [
        F.desc_nulls_last("review_creation_date"),
        F.desc_nulls_first("review_answer_timestamp"),
        *ascending("order_id", "review_score", "review_comment_message", "review_comment_title"),
    ]
    return (
        keep_first(typed, ["review_id"], newest)
        .withColumn("review_comment_title", text.null_tokens("review_comment_title"))
        .withColumn("review_comment_message", text.null_tokens("review_comment_message"))
    )


def deduplicated_orders(raw: DataFrame) -> DataFrame:
    """Orders with all five times, the latest purchase per ``order_id``, and their delivery days."""
    names = ("order_id", "customer_id", "order_status")
    # NULL texts fall out at the scan; what does not parse does so after the choice, so that each time is parsed once
    texts = require_not_null(raw, *names, *ORDER_TIMES)
    parsed = texts.select(*names, *[times.parse_ts(name).alias(name) for name in ORDER_TIMES])
    complete = F.least(*[F.col(name).isNotNull() for name in ORDER_TIMES])
    latest = [
        F.desc(complete),
        F.desc("order_purchase_timestamp"),
        *ascending("customer_id", "order_status"),
        *[F.desc(name) for name in ORDER_TIMES[1:]],
    ]
    days = times.day_diff("order_purchase_timestamp", "order_delivered_customer_date")
    return require_not_null(keep_first(parsed, ["order_id"], latest), *ORDER_TIMES).withColumn("delivery_time_days", days)


def delivery_bounds(raw: DataFrame, k: str = "1.5") -> DataFrame:
    """Fence of the delivery days over all deduplicated orders, negative durations included."""
    return iqr_bounds(deduplicated_orders(raw), "delivery_time_days", DAY_RANGE, k)


def silver_orders(raw: DataFrame, k: str = "1.5") -> DataFrame:
    """Delivered orders with consistent times and a delivery duration inside the fence."""
    deduplicated = deduplicated_orders(raw)
    bounds = iqr_bounds(deduplicated, "delivery_time_days", DAY_RANGE, k)
    flags = {
        **chronology_flags(*ORDER_TIMES),
        "is_delivery_time_outlier": outside_flag("delivery_time_days", bounds),
    }
    return drop_flagged(deduplicated, flags).select(
        "order_id", "customer_id", text.upper_trimmed("order_status").alias("order_status"), *ORDER_TIMES
    )


def unique_translation(raw: DataFrame) -> DataFrame:
    """``category_key, english``: one translation per category, compared lower-cased and trimmed."""
    keyed = raw.select(
        text.lower_trimmed("product_category_name").alias("category_key"),
        "product_category_name",
        F.col("product_category_name_english").alias("english"),
    )
    order = ascending("product_category_name", "english")
    return keep_first(require_not_null(keyed, "category_key"), ["category_key"], order).select("category_key", "english")


def silver_products(raw: DataFrame, raw_translation: DataFrame) -> DataFrame:
    """One row per ``product_id``: English category, sizes clamped to plausible values, volume and flags."""
    sizes = ("product_length_cm", "product_height_cm", "product_width_cm")
    details = (
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        *sizes,
    )
    one_each = keep_first(
        require_not_null(raw, "product_id").select("product_id", *details), ["product_id"], ascending(*details)
    ).withColumn("_category_key", text.lower_trimmed("product_category_name"))
    # adaptive execution sees the size of the translations when they are made unique: it broadcasts them, and splits the products of a
    # hot category where they are too many for that, so no one has to look for hot categories beforehand
    named = one_each.join(unique_translation(raw_translation).withColumnRenamed("category_key", "_category_key"), "_category_key", "left")

    measured = named.select(
        "product_id",
        F.coalesce("english", "product_category_name", F.lit("uncategorized")).alias("product_category_name"),
        numbers.to_int("product_name_lenght").alias("product_name_length"),
        numbers.to_int("product_description_lenght").alias("product_description_length"),
        F.coalesce(numbers.to_int("product_photos_qty"), F.lit(0)).alias("product_photos_qty"),
        *[numbers.to_decimal(c, 18, 4).alias(f"_raw_{c}") for c in ("product_weight_g", *sizes)],
    )
    weight = F.col("_raw_product_weight_g")
    outside = (weight < WEIGHT_G[0]) | (weight > WEIGHT_G[1])
    for size in sizes:
        outside = outside | (F.col(f"_raw_{size}") <= 0) | (F.col(f"_raw_{size}") > SIZE_CM[1])
    clamped = measured.withColumns(
        {
            "product_weight_g": numbers.clamp(weight, *WEIGHT_G).cast("decimal(10,2)"),
            **{s: numbers.clamp_positive(F.col(f"_raw_{s}"), *SIZE_CM).cast("decimal(10,2)") for s in sizes},
        }
    )
    return clamped.select(
        "product_id",
        "product_category_name",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        *sizes,
        (F.col(sizes[0]) * F.col(sizes[1]) * F.col(sizes[2])).alias("product_volume_cm3"),
        (F.col("product_category_name") == "uncategorized").alias("is_uncategorized"),
        outside.alias("has_outlier_dimensions"),
    )


def silver_sellers(raw: DataFrame) -> DataFrame:
    """One seller per ``seller_id`` and per zip code, with a valid zip code and state.

    The seller of a zip code is chosen before validation, so an invalid one can win its
    zip code and leave it without any seller.
    """
    cleaned = require_not_null(raw, "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state").select(
        F.trim("seller_id").alias("seller_id"),
        text.pad_zip("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        text.upper_trimmed("seller_state").alias("seller_state"),
        F.lower(text.collapse_spaces("seller_city")).alias("seller_city"),
    )
    by_id = keep_first(cleaned, ["seller_id"], ascending("seller_zip_code_prefix", "seller_city", "seller_state"))
    by_zip = keep_first(by_id, ["seller_zip_code_prefix"], ascending("seller_id"))

    zip_number = numbers.to_int("seller_zip_code_prefix")
    valid_zip = (F.length("seller_zip_code_prefix") == text.ZIP_WIDTH) & zip_number.between(1000, 99999)
    flags = {
        "is_invalid_zip": ~F.coalesce(valid_zip, F.lit(False)),
        "is_invalid_state": ~codes.is_valid_state(F.col("seller_state")),
        "is_empty_string": ~(text.not_blank("seller_id") & text.not_blank("seller_city")),
    }
    return drop_flagged(by_zip, flags)
