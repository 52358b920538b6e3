"""Raw landings shaped from the driver's Parquet tables.

Each is text only, as a CSV landing is, with dirt injected by key: missing and malformed
values, spelling variants and repeated keys. ``checks.oracles`` states the same inputs for
DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# 27 state codes by nation number, the last two unused.
STATES = "SP RJ MG ES PR SC RS BA PE CE MA PB RN PI AL SE AM PA RO RR AC AP TO MT MS GO DF".split()
STATE_LIST = ", ".join(f"'{s}'" for s in STATES)


Read = Callable[[str], DataFrame]


def raw_orders(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        """
        WITH shipped AS (
            SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
            FROM {lineitem} GROUP BY l_orderkey
        ), timed AS (
            SELECT o_orderkey AS k, o_custkey, o_orderstatus,
                   o_orderdate + make_dt_interval(copy, 0, o_orderkey % 1440) AS purchase,
                   first_ship, last_ship
            FROM {orders} LEFT JOIN shipped ON o_orderkey = l_orderkey
            LATERAL VIEW explode(IF(o_orderkey % 50 = 0, array(0, 1), array(0))) c AS copy
        )
        SELECT CAST(k AS STRING) AS order_id,
               CAST(o_custkey AS STRING) AS customer_id,
               IF(k % 3 = 0, concat(' ', lower(o_orderstatus), ' '), o_orderstatus) AS order_status,
               IF(k % 2 = 0, date_format(purchase, 'MM/dd/yyyy HH:mm'), date_format(purchase, 'M/d/yyyy H:mm'))
                   AS order_purchase_timestamp,
               IF(k % 89 = 0, 'not a date',
                  date_format(purchase + make_dt_interval(CAST(k % 5 AS INT) - 1), 'MM/dd/yyyy HH:mm'))
                   AS order_approved_at,
               date_format(first_ship, 'M/d/yyyy H:mm') AS order_delivered_carrier_date,
               IF(k % 97 = 0, NULL,
                  date_format(last_ship + make_dt_interval(0, 0, (k * 7) % 1440), 'MM/dd/yyyy HH:mm'))
                   AS order_delivered_customer_date,
               date_format(purchase + make_dt_interval(CAST(k % 400 AS INT) - 20), 'MM/dd/yyyy HH:mm')
                   AS order_estimated_delivery_date
        FROM timed
        """,
        lineitem=table("lineitem"),
        orders=table("orders"),
    )


def raw_items(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        """
        SELECT CAST(l_orderkey AS STRING) AS order_id,
               CASE WHEN l_partkey % 101 = 0 THEN 'abc'
                    WHEN l_partkey % 103 = 0 THEN '0'
                    WHEN l_partkey % 11 = 0 THEN concat(l_linenumber, '.0')
                    ELSE CAST(l_linenumber AS STRING) END AS order_item_id,
               CAST(l_partkey AS STRING) AS product_id,
               IF(l_partkey % 107 = 0, NULL, CAST(l_suppkey AS STRING)) AS seller_id,
               IF(l_partkey % 4 = 0,
                  date_format(l_shipdate + make_dt_interval(0, 0, l_partkey % 1440), 'yyyy-MM-dd HH:mm:ss'),
                  date_format(l_shipdate + make_dt_interval(0, 0, l_partkey % 1440), 'M/d/yyyy H:mm'))
                   AS shipping_limit_date,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS STRING) AS freight_value
        FROM {lineitem}
        """,
        lineitem=table("lineitem"),
    )


def raw_payments(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        """
        SELECT CAST(user_id AS STRING) AS order_id,
               CAST(event_id % 20 AS STRING) AS payment_sequential,
               IF(event_id % 211 = 0, 'x', get_json_object(props, '$.k')) AS payment_installments,
               CASE event_type WHEN 'signup' THEN IF(event_id % 2 = 0, 'Credit Card', 'card')
                               WHEN 'error' THEN ' BANK_SLIP '
                               WHEN 'click' THEN 'gift_card'
                               WHEN 'view' THEN 'UNKNOWN'
                               ELSE IF(event_id % 2 = 0, ' Pix', 'debit card') END AS payment_type,
               CASE WHEN event_id % 97 = 0 THEN NULL
                    WHEN event_id % 53 = 0 THEN CAST(-CAST(value AS DECIMAL(12,2)) AS STRING)
                    WHEN event_id % 59 = 0 THEN '0'
                    ELSE CAST(CAST(value AS DECIMAL(12,2)) AS STRING) END AS payment_value
        FROM {events}
        """,
        events=table("events"),
    )


def raw_reviews(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        """
        SELECT CAST(conv_id AS STRING) AS review_id,
               CAST(conv_id * 7 AS STRING) AS order_id,
               IF(conv_id % 41 = 0 AND turn = 3, 'abc', CAST(turn AS STRING)) AS review_score,
               CASE role WHEN 'system' THEN ' N/A ' WHEN 'user' THEN concat(' ', role, ' ') ELSE '' END
                   AS review_comment_title,
               IF(conv_id % 5 = 0, 'None', text) AS review_comment_message,
               date_format(date_add(DATE '2017-01-01', CAST(turn DIV 2 AS INT)), 'M/d/yyyy H:mm')
                   AS review_creation_date,
               IF(turn % 2 = 1, NULL, date_format(date_add(DATE '2017-01-03', CAST(turn AS INT)), 'yyyy-MM-dd HH:mm:ss'))
                   AS review_answer_timestamp
        FROM {conversations}
        """,
        conversations=table("conversations"),
    )


def raw_geolocation(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        """
        SELECT CAST(doc_id % 60 AS STRING) AS geolocation_zip_code_prefix,
               CASE WHEN doc_id % 83 = 0 THEN '123.5'
                    ELSE CAST(CAST((n_chars % 4500 - 3400) * 0.01 AS DECIMAL(10,2)) AS STRING) END AS geolocation_lat,
               CAST(CAST((n_chars % 5000 - 7400) * 0.01 AS DECIMAL(10,2)) AS STRING) AS geolocation_lng,
               CASE WHEN doc_id % 71 = 0 THEN '  ' ELSE concat(' ', source, 'ÃO  Town ') END AS geolocation_city,
               concat(lang, ' ') AS geolocation_state
        FROM {documents}
        """,
        documents=table("documents"),
    )


def raw_customers(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        f"""
        SELECT CAST(c_custkey AS STRING) AS customer_id,
               IF(c_custkey % 499 = 0, NULL, concat(c_custkey % 1000, IF(copy = 1, 'b', ''))) AS customer_unique_id,
               lpad(CAST(c_nationkey * 3 AS STRING), 5, '0') AS customer_zip_code_prefix,
               concat('  ', c_mktsegment, ' ') AS customer_city,
               lower(array({STATE_LIST})[c_nationkey]) AS customer_state
        FROM {{customer}}
        LATERAL VIEW explode(IF(c_custkey % 40 = 0, array(0, 1), array(0))) c AS copy
        """,
        customer=table("customer"),
    )


def raw_sellers(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        f"""
        SELECT concat(' ', s_suppkey) AS seller_id,
               CAST(s_nationkey * 1000 + s_suppkey % 3 AS STRING) AS seller_zip_code_prefix,
               replace(s_name, '#', '   ') AS seller_city,
               IF(s_suppkey % 13 = 0, 'XX', array({STATE_LIST})[s_nationkey]) AS seller_state
        FROM {{supplier}}
        """,
        supplier=table("supplier"),
    )


def raw_products(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        """
        SELECT CAST(p_partkey AS STRING) AS product_id,
               CASE WHEN p_partkey % 31 = 0 THEN NULL
                    WHEN p_partkey % 3 = 0 THEN concat(' ', lower(p_type), ' ')
                    ELSE p_type END AS product_category_name,
               CAST(length(p_name) AS STRING) AS product_name_lenght,
               CAST(p_size * 10.5 AS STRING) AS product_description_lenght,
               IF(p_partkey % 29 = 0, NULL, CAST(p_size % 6 AS STRING)) AS product_photos_qty,
               IF(p_partkey % 43 = 0, NULL,
                  CAST((CAST(p_retailprice AS DECIMAL(10,2)) - 900) * 600 + copy AS STRING)) AS product_weight_g,
               CAST(p_size - 5 AS STRING) AS product_length_cm,
               CAST((p_size - 5) * 5.5 AS STRING) AS product_height_cm,
               IF(p_partkey % 47 = 0, NULL, CAST((p_size - 5) * 10 AS STRING)) AS product_width_cm
        FROM {part}
        LATERAL VIEW explode(IF(p_partkey % 60 = 0, array(1, 0), array(0))) c AS copy
        """,
        part=table("part"),
    )


def raw_translation(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        """
        SELECT concat(' ', name) AS product_category_name, concat('en ', name) AS product_category_name_english
        FROM (SELECT DISTINCT lower(p_type) AS name FROM {part})
        LATERAL VIEW explode(array(0, 1)) c AS copy
        WHERE name <> 'economy'
        """,
        part=table("part"),
    )


def event_log(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        """
        SELECT ts AS timestamp,
               concat('{{"severity_text": "', upper(event_type), '", "props": ', props, '}}') AS record,
               concat(event_type, ' ', event_id) AS value
        FROM {events}
        """,
        events=table("events"),
    )


def run_log(spark: SparkSession, table: Read) -> DataFrame:
    return spark.sql(
        """
        SELECT event_type AS name,
               IF(event_type = 'error', 'FAILED', 'SUCCEEDED') AS state,
               ts AS scheduled_time,
               ts + make_dt_interval(0, 0, 0, CAST(value AS DECIMAL(12,2))) AS completed_time,
               IF(event_type = 'error', concat('failed: ', event_id), NULL) AS error_message
        FROM {events}
        """,
        events=table("events"),
    )
