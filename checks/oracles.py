"""DuckDB statements for the registered queries, written independently of the Spark code.

The landings are stated with the values their text stands for (a timestamp rather than its
text, NULL for text that does not parse), so parsing is checked as well.
"""

from __future__ import annotations

import re

from checks.inputs import STATE_LIST

# Common table expressions; each may use the ones above it. Fixed values in them, as in the library: the regions, the columns of
# the tables, and the limits of the classes.
PARTS = {
    "shipped": """
        SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY l_orderkey""",
    # every 50th order twice; DuckDB 2.0.0 fails with an internal error on UNNEST here at 150,000 orders
    "landed_orders": """
        SELECT o_orderkey AS k, o_custkey, o_orderstatus, first_ship, last_ship,
               o_orderdate + to_minutes(o_orderkey % 1440) + to_days(copy) AS purchase
        FROM orders LEFT JOIN shipped ON l_orderkey = o_orderkey
        JOIN (SELECT 0 AS copy UNION ALL SELECT 1) ON copy = 0 OR o_orderkey % 50 = 0""",
    "complete_orders": """
        SELECT CAST(k AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status, purchase AS order_purchase_timestamp,
               purchase + to_days(CAST(k % 5 - 1 AS INTEGER)) AS order_approved_at,
               first_ship AS order_delivered_carrier_date,
               last_ship + to_minutes(k * 7 % 1440) AS order_delivered_customer_date,
               purchase + to_days(CAST(k % 400 - 20 AS INTEGER)) AS order_estimated_delivery_date,
               CAST(last_ship AS DATE) - CAST(purchase AS DATE) AS days
        FROM landed_orders
        WHERE k % 89 <> 0 AND k % 97 <> 0 AND first_ship IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY purchase DESC) = 1""",
    "delivery_quartiles": """
        SELECT quantile_cont(CAST(days AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(days AS DOUBLE), 0.75) AS q3
        FROM complete_orders""",
    "s_orders": """
        SELECT complete_orders.* EXCLUDE (days)
        FROM complete_orders, delivery_quartiles
        WHERE order_delivered_customer_date >= order_purchase_timestamp
          AND order_delivered_customer_date >= order_delivered_carrier_date
          AND order_approved_at >= order_purchase_timestamp
          AND order_estimated_delivery_date >= order_purchase_timestamp
          AND days >= q1 - 1.5 * (q3 - q1) AND days <= q3 + 1.5 * (q3 - q1)""",
    "s_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate + to_minutes(l_partkey % 1440) AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight_value
        FROM lineitem
        WHERE l_partkey % 101 <> 0 AND l_partkey % 103 <> 0 AND l_partkey % 107 <> 0
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY shipping_limit_date DESC, product_id, seller_id, price, freight_value) = 1""",
    "typed_payments": """
        SELECT CAST(user_id AS VARCHAR) AS order_id, CAST(event_id % 20 AS INTEGER) AS payment_sequential,
               CASE event_type WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'Credit Card' ELSE 'card' END
                               WHEN 'error' THEN ' BANK_SLIP ' WHEN 'click' THEN 'gift_card' WHEN 'view' THEN 'UNKNOWN'
                               ELSE CASE WHEN event_id % 2 = 0 THEN ' Pix' ELSE 'debit card' END END AS spelling,
               CASE event_type WHEN 'signup' THEN 'credit_card' WHEN 'error' THEN 'boleto'
                               WHEN 'click' THEN 'voucher' WHEN 'view' THEN 'not_defined'
                               ELSE CASE WHEN event_id % 2 = 0 THEN 'pix' ELSE 'debit_card' END END AS payment_type,
               CASE WHEN event_id % 211 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END
                   AS payment_installments,
               CASE WHEN event_id % 97 = 0 THEN NULL
                    WHEN event_id % 53 = 0 THEN -CAST(value AS DECIMAL(10,2))
                    WHEN event_id % 59 = 0 THEN 0
                    ELSE CAST(value AS DECIMAL(10,2)) END AS payment_value
        FROM events
        QUALIFY row_number() OVER (
            PARTITION BY user_id, event_id % 20
            ORDER BY payment_value DESC NULLS LAST, spelling,
                     CASE WHEN event_id % 211 = 0 THEN 'x' ELSE json_extract_string(props, '$.k') END) = 1""",
    "payment_quartiles": """
        SELECT quantile_cont(CAST(payment_value AS DOUBLE), 0.25) AS q1,
               quantile_cont(CAST(payment_value AS DOUBLE), 0.75) AS q3
        FROM typed_payments""",
    "s_payments": """
        SELECT typed_payments.* EXCLUDE (spelling)
        FROM typed_payments, payment_quartiles
        WHERE payment_installments > 0 AND payment_value > 0
          AND payment_value >= q1 - 1.5 * (q3 - q1) AND payment_value <= q3 + 1.5 * (q3 - q1)""",
    "s_reviews": """
        SELECT CAST(conv_id AS VARCHAR) AS review_id, CAST(conv_id * 7 AS VARCHAR) AS order_id,
               CAST(turn AS INTEGER) AS review_score,
               CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN NULL WHEN 'system' THEN NULL END
                   AS review_comment_title,
               CASE WHEN conv_id % 5 = 0 THEN NULL ELSE nullif(trim(text, ' '), '') END AS review_comment_message,
               TIMESTAMP '2017-01-01' + to_days(CAST(turn // 2 AS INTEGER)) AS review_creation_date,
               CASE WHEN turn % 2 = 0 THEN TIMESTAMP '2017-01-03' + to_days(CAST(turn AS INTEGER)) END
                   AS review_answer_timestamp
        FROM conversations
        WHERE turn BETWEEN 1 AND 5 AND NOT (conv_id % 41 = 0 AND turn = 3)
        QUALIFY row_number() OVER (
            PARTITION BY conv_id
            ORDER BY review_creation_date DESC, review_answer_timestamp DESC NULLS FIRST, review_score) = 1""",
    "points": """
        SELECT DISTINCT lpad(CAST(doc_id % 60 AS VARCHAR), 5, '0') AS zip,
               (n_chars % 4500 - 3400) / 100.0 AS lat, (n_chars % 5000 - 7400) / 100.0 AS lng,
               lower(source) AS initial, source || 'ÃO  Town' AS original, upper(lang) AS state
        FROM documents
        WHERE doc_id % 83 <> 0 AND doc_id % 71 <> 0
          AND n_chars % 4500 - 3400 BETWEEN -3400 AND 500 AND n_chars % 5000 - 7400 BETWEEN -7400 AND -3400""",
    "s_geolocation": """
        SELECT zip AS geolocation_zip_code_prefix, median(CAST(lat AS DOUBLE)) AS geolocation_lat,
               median(CAST(lng AS DOUBLE)) AS geolocation_lng,
               trim(strip_accents(initial) || 'ao  town', ' ') AS geolocation_city,
               trim(original, ' ') AS geolocation_city_original,
               state AS geolocation_state, count(*) AS duplicate_count
        FROM points
        GROUP BY zip, initial, original, state
        QUALIFY row_number() OVER (
            PARTITION BY zip
            ORDER BY duplicate_count DESC, geolocation_city, geolocation_city_original, geolocation_state) = 1""",
    "s_customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey % 1000 AS VARCHAR) AS customer_unique_id,
               lpad(CAST(c_nationkey * 3 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               lower(c_mktsegment) AS customer_city, list_extract([{STATE_LIST}], c_nationkey + 1) AS customer_state
        FROM customer WHERE c_custkey % 499 <> 0""",
    "s_sellers": f"""
        SELECT seller_id, seller_zip_code_prefix, seller_state, seller_city FROM (
            SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
                   lpad(CAST(s_nationkey * 1000 + s_suppkey % 3 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
                   CASE WHEN s_suppkey % 13 = 0 THEN 'XX' ELSE list_extract([{STATE_LIST}], s_nationkey + 1) END
                       AS seller_state,
                   replace(lower(s_name), '#', ' ') AS seller_city
            FROM supplier
            QUALIFY row_number() OVER (PARTITION BY seller_zip_code_prefix ORDER BY seller_id) = 1)
        WHERE seller_state <> 'XX' AND CAST(seller_zip_code_prefix AS INTEGER) >= 1000""",
    "measured_products": """
        SELECT p_partkey, p_name, p_size,
               CASE WHEN p_partkey % 31 = 0 THEN NULL
                    WHEN p_partkey % 3 = 0 THEN ' ' || lower(p_type) || ' ' ELSE p_type END AS category,
               CASE WHEN p_partkey % 43 <> 0 THEN (CAST(p_retailprice AS DECIMAL(10,2)) - 900) * 600 END AS weight,
               CAST(p_size - 5 AS DECIMAL(10,2)) AS length_cm,
               CAST((p_size - 5) * 5.5 AS DECIMAL(10,2)) AS height_cm,
               CASE WHEN p_partkey % 47 <> 0 THEN CAST((p_size - 5) * 10 AS DECIMAL(10,2)) END AS width_cm
        FROM part""",
    "s_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN category IS NULL THEN 'uncategorized'
                    WHEN lower(trim(category)) = 'economy' THEN category
                    ELSE 'en ' || lower(trim(category)) END AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_length,
               CAST(round(p_size * 10.5) AS INTEGER) AS product_description_length,
               CAST(CASE WHEN p_partkey % 29 = 0 THEN 0 ELSE p_size % 6 END AS INTEGER) AS product_photos_qty,
               CASE WHEN weight IS NOT NULL THEN greatest(10, least(50000, weight)) END AS product_weight_g,
               CASE WHEN length_cm <= 0 THEN 1 ELSE least(length_cm, 200) END AS product_length_cm,
               CASE WHEN height_cm <= 0 THEN 1 ELSE least(height_cm, 200) END AS product_height_cm,
               CASE WHEN width_cm <= 0 THEN 1 WHEN width_cm IS NOT NULL THEN least(width_cm, 200) END AS product_width_cm,
               CAST(product_length_cm AS DOUBLE) * product_height_cm * product_width_cm AS product_volume_cm3,
               category IS NULL AS is_uncategorized,
               weight < 10 OR weight > 50000 OR length_cm <= 0 OR length_cm > 200 OR height_cm <= 0
                   OR height_cm > 200 OR width_cm <= 0 OR width_cm > 200 AS has_outlier_dimensions
        FROM measured_products""",
    "regions": """
        SELECT unnest(['SP', 'RJ', 'MG', 'ES']) AS code, 'Southeast' AS region
        UNION ALL SELECT unnest(['PR', 'SC', 'RS']), 'South'
        UNION ALL SELECT unnest(['BA', 'PE', 'CE', 'MA', 'PB', 'RN', 'PI', 'AL', 'SE']), 'Northeast'
        UNION ALL SELECT unnest(['AM', 'PA', 'RO', 'RR', 'AC', 'AP', 'TO']), 'North'
        UNION ALL SELECT unnest(['MT', 'MS', 'GO', 'DF']), 'Center-West'""",
    "g_customers": """
        SELECT customer_unique_id AS customer_id, customer_id AS customer_order_id, customer_zip_code_prefix,
               customer_city, customer_state, coalesce(region, 'Unknown') AS customer_region,
               geolocation_lat AS customer_lat, geolocation_lng AS customer_lng
        FROM (SELECT * FROM s_customers
              QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id) = 1)
        LEFT JOIN s_geolocation ON geolocation_zip_code_prefix = customer_zip_code_prefix
        LEFT JOIN regions ON code = customer_state""",
    "g_sellers": """
        SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state,
               geolocation_lat AS seller_lat, geolocation_lng AS seller_lng,
               coalesce(region, 'Unknown') AS seller_region
        FROM s_sellers
        LEFT JOIN s_geolocation ON geolocation_zip_code_prefix = seller_zip_code_prefix
        LEFT JOIN regions ON code = seller_state""",
    "order_payments": """
        SELECT order_id, sum(payment_value) AS total_payment_value,
               max(payment_installments) AS max_installments, min(payment_installments) AS min_installments,
               string_agg(DISTINCT payment_type, ', ' ORDER BY payment_type) AS payment_types_used,
               count(DISTINCT payment_type) AS num_payment_methods,
               count(DISTINCT payment_type) > 1 AS is_split_payment,
               first(payment_type ORDER BY payment_value DESC, payment_type DESC) AS primary_payment_type
        FROM s_payments GROUP BY order_id""",
    "order_reviews": """
        SELECT order_id, max(review_score) AS review_score, count(*) AS review_count,
               max(review_creation_date) AS review_creation_date,
               bool_or(review_comment_message IS NOT NULL) AS has_review_comment
        FROM s_reviews GROUP BY order_id""",
    "g_fact": """
        SELECT order_id, order_item_id, product_id, seller_id, customer_id,
               CAST(order_purchase_timestamp AS DATE) AS purchase_date,
               CAST(order_approved_at AS DATE) AS approved_date,
               CAST(order_delivered_carrier_date AS DATE) AS carrier_date,
               CAST(order_delivered_customer_date AS DATE) AS delivered_date,
               CAST(order_estimated_delivery_date AS DATE) AS estimated_delivery_date,
               order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date,
               price AS item_price, freight_value AS item_freight, price + freight_value AS item_total_revenue,
               shipping_limit_date, total_payment_value, max_installments, min_installments, payment_types_used,
               num_payment_methods, is_split_payment, primary_payment_type,
               review_score, review_count, review_creation_date, has_review_comment,
               CAST(approved_date - purchase_date AS INTEGER) AS approval_time_days,
               CAST(delivered_date - purchase_date AS INTEGER) AS actual_delivery_days,
               CAST(CAST(order_estimated_delivery_date AS DATE) - purchase_date AS INTEGER) AS estimated_delivery_days,
               CAST(delivered_date - CAST(order_estimated_delivery_date AS DATE) AS INTEGER) AS delivery_delta_days,
               order_delivered_customer_date <= order_estimated_delivery_date AS is_on_time,
               order_delivered_customer_date > order_estimated_delivery_date AS is_late,
               CASE WHEN review_score IN (4, 5) THEN 'positive' WHEN review_score = 3 THEN 'neutral'
                    WHEN review_score IN (1, 2) THEN 'negative' ELSE 'no_review' END AS review_sentiment
        FROM s_orders JOIN s_items USING (order_id)
        LEFT JOIN order_payments USING (order_id) LEFT JOIN order_reviews USING (order_id)""",
    "semantic": """
        SELECT order_id, order_item_id, purchase_date, customer_region, customer_state, product_category_name,
               seller_region, seller_state, order_status, review_sentiment, primary_payment_type,
               item_total_revenue, is_on_time, is_late, delivery_delta_days
        FROM g_fact
        LEFT JOIN g_customers ON customer_order_id = g_fact.customer_id
        LEFT JOIN s_products ON s_products.product_id = g_fact.product_id
        LEFT JOIN g_sellers ON g_sellers.seller_id = g_fact.seller_id""",
    "runs": """
        SELECT event_type AS name, CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
               ts AS scheduled_time, ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) AS completed_time,
               CASE event_type WHEN 'error' THEN 'failed: ' || event_id END AS error_message
        FROM events""",
}

# Columns that are decimals or fractions, compared as doubles of six decimals.
FRACTIONS = {
    "s_items": ("price", "freight_value"),
    "s_payments": ("payment_value",),
    "s_geolocation": ("geolocation_lat", "geolocation_lng"),
    "s_products": (
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_volume_cm3",
    ),
    "g_customers": ("customer_lat", "customer_lng"),
    "g_sellers": ("seller_lat", "seller_lng"),
    "order_payments": ("total_payment_value",),
    "g_fact": ("item_price", "item_freight", "item_total_revenue", "total_payment_value"),
    "semantic": ("item_total_revenue",),
}


def _double(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6)"


def _statement(body: str) -> str:
    """``body`` behind the common table expressions it needs."""
    needed: set[str] = set()
    text = [body]
    while text:
        words = set(re.findall(r"\w+", text.pop()))
        new = (words & PARTS.keys()) - needed
        needed |= new
        text += [PARTS[name] for name in new]
    if not needed:
        return body
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in PARTS.items() if name in needed)
    return f"WITH {parts}\n{body}"


def _all(part: str, extra: str = "") -> str:
    doubles = ", ".join(f"{_double(c)} AS {c}" for c in FRACTIONS.get(part, ()))
    replaced = f" REPLACE ({doubles})" if doubles else ""
    return _statement(f"SELECT *{replaced}{extra} FROM {part}")


def _bounds(part: str) -> str:
    return _statement(
        f"""SELECT {_double('q1')} AS q1, {_double('q3')} AS q3, {_double('q3 - q1')} AS iqr,
               {_double('q1 - 1.5 * (q3 - q1)')} AS lower_bound, {_double('q3 + 1.5 * (q3 - q1)')} AS upper_bound
        FROM {part}"""
    )


def oracle_sql() -> dict[str, str]:
    revenue = f"{_double('item_total_revenue')} AS item_total_revenue"
    return {
        "silver_customers": _all("s_customers"),
        "silver_geolocation": _all("s_geolocation"),
        "silver_order_items": _all("s_items"),
        "silver_payments": _all("s_payments"),
        "silver_reviews": _all("s_reviews"),
        "silver_orders": _all("s_orders"),
        "silver_products": _all("s_products"),
        "silver_sellers": _all("s_sellers"),
        "iqr_bounds_payments": _bounds("payment_quartiles"),
        "iqr_bounds_delivery_days": _bounds("delivery_quartiles"),
        "dim_customers": _all("g_customers"),
        "dim_sellers": _all("g_sellers"),
        "dim_products": _all(
            "s_products",
            """, CASE WHEN product_weight_g < 300 THEN 'light' WHEN product_weight_g < 2000 THEN 'medium'
                  WHEN product_weight_g < 10000 THEN 'heavy' ELSE 'very_heavy' END AS weight_class,
               CASE product_photos_qty WHEN 0 THEN 'no_photo' WHEN 1 THEN 'single_photo' WHEN 2 THEN 'few_photos'
                    WHEN 3 THEN 'few_photos' ELSE 'many_photos' END AS photo_tier,
               round(CAST(product_weight_g AS DOUBLE) * 10000 / product_volume_cm3) / 10000 AS density_g_per_cm3""",
        ),
        "dim_dates": """
            WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
                          FROM orders),
            spine AS (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date_id
                      FROM span)
            SELECT date_id, CAST(year(date_id) AS INTEGER) AS year, CAST(month(date_id) AS INTEGER) AS month,
                   CAST(day(date_id) AS INTEGER) AS day, CAST(week(date_id) AS INTEGER) AS week_of_year,
                   CAST(quarter(date_id) AS INTEGER) AS quarter, strftime(date_id, '%Y-%m') AS year_month,
                   year(date_id) || '-Q' || quarter(date_id) AS year_quarter,
                   left(dayname(date_id), 3) AS day_name, left(monthname(date_id), 3) AS month_name,
                   isodow(date_id) > 5 AS is_weekend,
                   ['Q1 (Jan-Mar)', 'Q2 (Apr-Jun)', 'Q3 (Jul-Sep)', 'Q4 (Oct-Dec)'][quarter(date_id)] AS quarter_label
            FROM spine""",
        "payments_per_order": _all("order_payments"),
        "reviews_per_order": _all("order_reviews"),
        "fact_orders": _all("g_fact"),
        "semantic_orders": _all("semantic"),
        "mart_finance": _statement(f"SELECT purchase_date, order_id, primary_payment_type, {revenue} FROM semantic"),
        "mart_marketing": _statement(
            f"""SELECT purchase_date, customer_region, customer_state, product_category_name, {revenue}, review_sentiment
                FROM semantic"""
        ),
        "mart_ops": _statement(
            """SELECT purchase_date, seller_region, seller_state, is_on_time, is_late, delivery_delta_days
               FROM semantic"""
        ),
        "recent_logs": """
            SELECT ts AS timestamp, upper(event_type) AS severity, event_type || ' ' || event_id AS message
            FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS
            ORDER BY ts DESC, severity, message LIMIT 100""",
        "run_history": _statement(
            """SELECT name, state, scheduled_time, completed_time,
                      date_diff('second', scheduled_time, completed_time) AS duration_sec, error_message
               FROM runs WHERE scheduled_time >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS
               ORDER BY scheduled_time DESC, name, completed_time NULLS FIRST, state NULLS FIRST, error_message NULLS FIRST
               LIMIT 100"""
        ),
        "failed_runs": _statement(
            "SELECT name, state, error_message, scheduled_time FROM runs WHERE state = 'FAILED'"
        ),
    }
