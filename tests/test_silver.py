"""Silver tables on hand-written landings: every cleaning rule and every trap."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from martwright.plans import silver


def rows(df, *order: str) -> list[tuple]:
    return [tuple(r) for r in df.orderBy(*(order or df.columns[:2])).collect()]


def test_customers(texts):
    raw = texts(
        "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
        [
            ("c1", "u2", "01046", "  São PAULO ", " sp"),
            ("c1", "u1", "01047", "Rio", "RJ"),
            ("c2", "u1", "1046", None, None),
            (None, "u3", "1", "x", "SP"),
            ("c3", None, "1", "x", "SP"),
        ],
    )
    assert rows(silver.silver_customers(raw)) == [
        ("c1", "u1", "01047", "rio", "RJ"),
        ("c2", "u1", "1046", None, None),
    ]


GEO = "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state"


def test_geolocation_takes_the_variant_with_most_distinct_points(texts):
    raw = texts(
        GEO,
        [
            # two distinct points, one of them repeated
            ("1046", "-23.5", "-46.6", "são paulo", "sp"),
            ("1046", "-23.5", "-46.6", "são paulo", "sp"),
            ("1046", "-23.6", "-46.5", "são paulo", "SP "),
            # other spelling: one point, three times
            *[("1046", "-23.9", "-46.9", "SÃO PAULO", "SP")] * 3,
        ],
    )
    assert rows(silver.silver_geolocation(raw)) == [("01046", -23.55, -46.55, "sao paulo", "são paulo", "SP", 2)]


def test_geolocation_drops_bad_points_and_breaks_ties_by_name(texts):
    raw = texts(
        GEO,
        [
            ("2", "5", "-34", "Edge", "AM"),
            ("2", "-34", "-74", "Bdge", "AM"),
            ("3", "5.01", "-50", "x", "AM"),
            ("3", "123.5", "-50", "x", "AM"),
            ("3", "abc", "-50", "x", "AM"),
            ("3", "0", "-33.99", "x", "AM"),
            ("3", "0", "-50", "  ", "AM"),
            ("3", "0", "-50", "x", ""),
            ("3", "0", "-50", None, "AM"),
            (None, "0", "-50", "x", "AM"),
        ],
    )
    assert rows(silver.silver_geolocation(raw)) == [("00002", -34.0, -74.0, "bdge", "Bdge", "AM", 1)]


def test_geolocation_median_of_many_points_equals_the_builtin(spark):
    raw = spark.range(3000).selectExpr(
        "'77' AS geolocation_zip_code_prefix",
        "CAST(CAST(-30 + pmod(id * 7919, 3001) * 0.0101 AS DECIMAL(12,8)) AS STRING) AS geolocation_lat",
        "CAST(CAST(-70 + pmod(id * 104729, 2999) * 0.0103 AS DECIMAL(12,8)) AS STRING) AS geolocation_lng",
        "'town' AS geolocation_city",
        "'SP' AS geolocation_state",
    )
    expected = raw.selectExpr(
        "median(CAST(geolocation_lat AS DECIMAL(10,8)))", "median(CAST(geolocation_lng AS DECIMAL(11,8)))"
    ).first()
    got = silver.silver_geolocation(raw).first()
    assert (round(got["geolocation_lat"], 9), round(got["geolocation_lng"], 9)) == tuple(round(v, 9) for v in expected)
    assert got["duplicate_count"] == 3000


ITEMS = "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"


def test_order_items(texts):
    raw = texts(
        ITEMS,
        [
            ("o1", "1", "p1", "s1", "9/13/2017 8:59", "99.3", "1.005"),
            ("o1", "1.0", "p2", "s1", "10/2/2017 8:59", "100", "2"),  # later, though its text sorts first
            ("o1", "2", "p1", "s1", "2017-10-02 08:59:00", "bad", None),
            ("o1", "0", "p1", "s1", "9/13/2017 8:59", "1", "1"),
            ("o1", "abc", "p1", "s1", "9/13/2017 8:59", "1", "1"),
            ("o1", "3", None, "s1", "9/13/2017 8:59", "1", "1"),
            ("o1", "3", "p1", None, "9/13/2017 8:59", "1", "1"),
            ("o1", "3", "p1", "s1", None, "1", "1"),
            (None, "3", "p1", "s1", "9/13/2017 8:59", "1", "1"),
        ],
    )
    at = dt.datetime(2017, 10, 2, 8, 59)
    assert rows(silver.silver_order_items(raw)) == [
        ("o1", 1, "p2", "s1", at, Decimal("100.00"), Decimal("2.00")),
        ("o1", 2, "p1", "s1", at, None, None),
    ]


PAYMENTS = "order_id payment_sequential payment_installments payment_type payment_value"


def test_payments_keep_the_highest_number_not_the_highest_text(texts):
    raw = texts(
        PAYMENTS,
        [
            ("o1", "1", "1", "Credit Card", "99.3"),
            ("o1", "1", "1", " BANK_SLIP", "100"),
            ("o1", "1.0", "1", "pix", None),
            ("o1", "2", "1.6", "gift_card", "100.005"),
            ("o2", "1", "x", "card", "100"),
            ("o2", "2", "0", "card", "100"),
            ("o2", "3", "1", "card", "0"),
            ("o2", "4", "1", "card", "-1"),
            ("o2", "5", "1", "UNKNOWN", "100"),
            ("o2", "y", "1", "card", "101"),
            (None, "1", "1", "card", "100"),
            ("o3", None, "1", "card", "100"),
            *[(f"f{i}", "1", "1", "card", "100") for i in range(12)],
        ],
    )
    kept = [r for r in rows(silver.silver_payments(raw, k="3")) if not r[0].startswith("f")]
    # value 0 and -1 lie outside the fence of nearly equal values, and are not positive either
    assert kept == [
        ("o1", 1, "boleto", 1, Decimal("100.00")),
        ("o2", 5, "not_defined", 1, Decimal("100.00")),
    ]


def test_payment_fence_counts_all_values_and_keeps_its_bounds(texts):
    # quartiles 10 and 20 with the zero and the negative value counted: fence -5 to 35
    values = ["-10", "0", "10", "10", "10", "15", "20", "20", "20", "35", "35.01"]
    raw = texts(PAYMENTS, [("o", str(i), "1", "card", v) for i, v in enumerate(values)])
    bounds = silver.payment_bounds(raw).first()
    assert (bounds["q1"], bounds["q3"], bounds["lower_bound"], bounds["upper_bound"]) == (10, 20, -5, 35)
    assert [float(r[4]) for r in rows(silver.silver_payments(raw), "payment_value")] == [10, 10, 10, 15, 20, 20, 20, 35]


REVIEWS = (
    "review_id order_id review_score review_comment_title review_comment_message"
    " review_creation_date review_answer_timestamp"
)


def test_reviews(texts):
    raw = texts(
        REVIEWS,
        [
            ("r1", "o1", "5", " N/A ", ' two\nlines "quoted" ', "9/13/2017 0:00", "9/14/2017 0:00"),
            ("r1", "o1", "4", "none", "older by text only", "10/2/2017 0:00", "10/3/2017 0:00"),
            ("r1", "o2", "3", "", "  newest ", "10/2/2017 0:00", None),  # no answer counts as newest
            ("r2", "o1", "4.6", "good", "null", "2017-10-02 00:00:00", "x"),
            ("r3", "o1", "0", "", "", "10/2/2017 0:00", None),
            ("r4", "o1", "6", "", "", "10/2/2017 0:00", None),
            ("r5", "o1", "abc", "", "", "10/2/2017 0:00", None),
            ("r6", None, "5", "", "", "10/2/2017 0:00", None),
            ("r7", "o1", "5", "", "", None, None),
        ],
    )
    created = dt.datetime(2017, 10, 2)
    assert rows(silver.silver_reviews(raw)) == [
        ("r1", "o2", 3, None, "newest", created, None),
        ("r2", "o1", 5, "good", None, created, None),
    ]


ORDERS = (
    "order_id customer_id order_status order_purchase_timestamp order_approved_at"
    " order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"
)


def order(order_id: str, delivered: str = "1/11/2017 0:01", **changes: str | None) -> tuple:
    values = {
        "order_id": order_id,
        "customer_id": "c",
        "order_status": " delivered ",
        "order_purchase_timestamp": "1/1/2017 23:59",
        "order_approved_at": "01/02/2017 00:01",
        "order_delivered_carrier_date": "1/3/2017 8:00",
        "order_delivered_customer_date": delivered,
        "order_estimated_delivery_date": "1/20/2017 0:00",
    }
    return tuple({**values, **changes}.values())


def test_orders(texts):
    raw = texts(
        ORDERS,
        [
            *[order(f"normal{i}") for i in range(9)],
            order("wrong date", order_approved_at="2017-01-02 00:01:00"),
            order("not delivered", delivered=None),
            order("delivered before purchase", "1/1/2017 23:58", order_delivered_carrier_date="1/1/2017 0:00"),
            order("delivered before carrier", "1/3/2017 7:59"),
            order("approved before purchase", order_approved_at="1/1/2017 23:58"),
            order("estimated before purchase", order_estimated_delivery_date="1/1/2017 23:58"),
            order("too long", "6/11/2017 0:01"),
            order("twice", order_status="OLD"),
            order("twice", "1/12/2017 0:00", order_purchase_timestamp="1/2/2017 0:00"),
            order("no customer", customer_id=None),
        ],
    )
    got = rows(silver.silver_orders(raw))
    assert [r[0] for r in got] == [*[f"normal{i}" for i in range(9)], "twice"]
    assert got[0][1:4] == ("c", "DELIVERED", dt.datetime(2017, 1, 1, 23, 59))
    assert got[-1][2:4] == ("DELIVERED", dt.datetime(2017, 1, 2))


def test_delivery_days_count_midnights_and_negative_durations(texts):
    raw = texts(
        ORDERS,
        [
            order("a", "1/2/2017 0:01"),
            order("b", "12/31/2016 0:01"),
            order("c", "1/1/2017 23:58"),
        ],
    )
    days = {r["order_id"]: r["delivery_time_days"] for r in silver.deduplicated_orders(raw).collect()}
    assert days == {"a": 1, "b": -1, "c": 0}
    assert float(silver.delivery_bounds(raw).first()["q1"]) == -0.5


PRODUCTS = (
    "product_id product_category_name product_name_lenght product_description_lenght product_photos_qty"
    " product_weight_g product_length_cm product_height_cm product_width_cm"
)
TRANSLATION = "product_category_name product_category_name_english"


def test_products(texts):
    raw = texts(
        PRODUCTS,
        [
            ("p1", "  Moveis ", "10", "20.5", None, "5", "0", "0.5", "250"),
            ("p2", None, "10", "20", "3", "60000", "10", "10", "10"),
            ("p3", " sem par", None, "x", "1", None, "10", "10", "10"),
            ("p4", "moveis", "1", "1", "1", None, "-1", "10", "10"),
            ("p5", "moveis", "2", "1", "1", "300", "10", "20", "3"),
            ("p5", "moveis", "1", "1", "1", "300", "10", "20", "3"),
            (None, "moveis", "1", "1", "1", "1", "1", "1", "1"),
        ],
    )
    # the same category twice, as after loading a file twice
    translation = texts(TRANSLATION, [("moveis", "furniture"), ("MOVEIS ", "furniture"), (None, "nothing")])
    got = {r["product_id"]: r for r in silver.silver_products(raw, translation).collect()}
    assert sorted(got) == ["p1", "p2", "p3", "p4", "p5"]
    assert tuple(got["p1"])[1:] == (
        "furniture",
        10,
        21,
        0,
        Decimal("10.00"),
        Decimal("1.00"),
        Decimal("0.50"),
        Decimal("200.00"),
        Decimal("100.000000"),
        False,
        True,
    )
    assert tuple(got["p2"])[1:6] == ("uncategorized", 10, 20, 3, Decimal("50000.00"))
    assert got["p2"]["is_uncategorized"] and got["p2"]["has_outlier_dimensions"]
    # the flag is NULL unless something is known to be outside
    assert got["p3"]["product_category_name"] == " sem par" and got["p3"]["has_outlier_dimensions"] is None
    assert got["p4"]["has_outlier_dimensions"] is True and got["p4"]["product_weight_g"] is None
    assert got["p5"]["product_name_length"] == 1 and got["p5"]["has_outlier_dimensions"] is False


def test_sellers(texts):
    raw = texts(
        "seller_id seller_zip_code_prefix seller_city seller_state",
        [
            (" s1 ", "1046", "rio   de  Janeiro", " rj"),
            ("s1", "2046", "x", "RJ"),
            ("s2", "3000", "x", "XX"),  # wins its zip code and is then rejected
            ("s3", "3000", "x", "SP"),
            ("s4", "12", "x", "SP"),
            ("s5", "abcde", "x", "SP"),
            ("s6", "123456", "x", "SP"),
            ("   ", "4000", "x", "SP"),
            ("s7", "5000", "  ", "SP"),
            ("s8", "6000", None, "SP"),
        ],
    )
    assert rows(silver.silver_sellers(raw)) == [
        ("s1", "01046", "RJ", "rio de janeiro"),
        ("s6", "12345", "SP", "x"),
    ]


def test_money_is_neither_cut_nor_rounded(texts):
    item = ("o1", "1", "p", "s", "9/13/2017 8:59")
    raw = texts(
        "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
        [(*item, "150000000.00", "12.345"), ("o2", *item[1:], "x", "0.1")],
    )
    found = {r["order_id"]: (r["price"], r["freight_value"]) for r in silver.silver_order_items(raw).collect()}
    assert found == {"o1": (Decimal("150000000"), Decimal("12.345")), "o2": (None, Decimal("0.1"))}
    payments = texts(
        "order_id payment_sequential payment_type payment_installments payment_value",
        [(f"o{i}", "1", "pix", "1", v) for i, v in enumerate(["150000000.00", "150000000.005", "149999999.99"])],
    )
    paid = [r["payment_value"] for r in silver.silver_payments(payments).orderBy("order_id").collect()]
    assert paid == [Decimal("150000000.00"), Decimal("150000000.01"), Decimal("149999999.99")]


def test_scores_are_compared_before_they_are_rounded(texts):
    raw = texts(
        "review_id order_id review_score review_comment_title review_comment_message review_creation_date review_answer_timestamp",
        [(s, "o", s, None, None, "1/2/2017 3:04", None) for s in ("5.00004", "0.99996", "1.49996", "5", "1")],
    )
    found = {r["review_id"]: r["review_score"] for r in silver.silver_reviews(raw).collect()}
    assert found == {"1.49996": 1, "5": 5, "1": 1}


def test_an_incomplete_order_row_gives_way_to_a_complete_one(texts):
    complete = ("o1", "c1", "d", *["1/2/2017 3:04"] * 5)
    broken = ("o1", "c2", "d", "1/9/2017 3:04", "no date", *["1/9/2017 3:04"] * 3)
    columns = "order_id customer_id order_status " + " ".join(silver.ORDER_TIMES)
    found = silver.deduplicated_orders(texts(columns, [complete, broken, ("o2", *broken[1:])])).collect()
    assert [(r["order_id"], r["customer_id"]) for r in found] == [("o1", "c1")]


def test_every_text_is_parsed_once(spark, plan_of, tmp_path):
    columns = ["order_id", "customer_id", "order_status", *silver.ORDER_TIMES]
    spark.createDataFrame([("o",) * len(columns)], columns).write.parquet(str(tmp_path / "orders"))
    plan = plan_of(silver.deduplicated_orders(spark.read.parquet(str(tmp_path / "orders"))))
    assert plan.count("regexp_replace(") == 5 and "isnotnull(order_approved_at" in plan
    columns = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
    spark.createDataFrame([("o",) * len(columns)], columns).write.parquet(str(tmp_path / "items"))
    plan = plan_of(silver.silver_order_items(spark.read.parquet(str(tmp_path / "items"))))
    assert plan.count("cast(order_item_id") == 2  # the plain and the decimal way of one conversion
