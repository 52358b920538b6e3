"""Column functions, one row per case."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martwright.functions import codes, numbers, text, times


@pytest.fixture
def apply(spark):
    def run(expression, values, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        return [r[0] for r in rows.select("i", expression(F.col("c")).alias("out")).orderBy("i").select("out").collect()]

    return run


def test_fold_accents_covers_upper_case_and_leaves_others(apply):
    assert apply(text.fold_accents, ["SÃO", "Étang", "ÇÜÖ", "ñ", None]) == ["sao", "etang", "cuo", "ñ", None]


def test_collapse_spaces_means_whitespace_not_the_letter_s(apply):
    assert apply(text.collapse_spaces, ["  rio   de \t janeiro ", "a  ss b"]) == ["rio de janeiro", "a ss b"]


def test_null_tokens(apply):
    values = [" N/A ", "", "  ", "none", "NULL", "na", " fine ", "nab", None]
    assert apply(text.null_tokens, values) == [None] * 6 + ["fine", "nab", None]


def test_pad_zip_pads_and_cuts(apply):
    assert apply(text.pad_zip, ["12", "01046", "123456", None]) == ["00012", "01046", "12345", None]


def test_to_int_rounds_and_never_fails(apply):
    values = ["1", "1.0", "1.5", "2.5", " 3 ", "abc", "", "99999999999", None, "1.49996", "0.99996"]
    assert apply(numbers.to_int, values) == [1, 1, 2, 3, 3, None, None, None, None, 1, 1]


def test_to_decimal_out_of_range_is_null(apply):
    assert apply(lambda c: numbers.to_decimal(c, 10, 8), ["5", "5.01", "123.5", "x"]) == [
        Decimal("5.00000000"),
        Decimal("5.01000000"),
        None,
        None,
    ]


def test_clamps_keep_null_and_small_positive(apply):
    weights = [Decimal(v) if v else None for v in ("5", "10", "50001", "300.5", None)]
    assert apply(lambda c: numbers.clamp(c, 10, 50000), weights, "decimal(10,2)") == [10, 10, 50000, Decimal("300.5"), None]
    sizes = [Decimal(v) if v else None for v in ("0", "-3", "0.5", "250", "200", None)]
    assert apply(lambda c: numbers.clamp_positive(c, 1, 200), sizes, "decimal(10,2)") == [
        1,
        1,
        Decimal("0.5"),
        200,
        200,
        None,
    ]


def test_flag_is_two_valued(apply):
    assert apply(lambda c: numbers.flag(c > 1), [0, 2, None], "int") == [False, True, False]


def test_safe_ratio(apply):
    values = [Decimal("3"), Decimal("0"), None]
    ratio = apply(lambda c: numbers.safe_ratio(F.lit(Decimal("1.00")), c, 4), values, "decimal(10,2)")
    assert ratio == [Decimal("0.3333"), None, None]


def test_parse_ts_accepts_one_digit_parts_only_in_its_own_format(apply):
    values = ["9/3/2017 8:59", "10/02/2017 21:07", "13/45/2017 1:00", "2017-10-02 21:07:00", "", None]
    first, second = dt.datetime(2017, 9, 3, 8, 59), dt.datetime(2017, 10, 2, 21, 7)
    assert apply(times.parse_ts, values) == [first, second, None, None, None, None]
    assert apply(times.parse_ts_or_iso, values) == [first, second, None, second, None, None]


def test_times_do_not_depend_on_the_zone_of_the_session(spark, apply):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # the clock skipped this hour there
        assert apply(times.parse_ts, ["10/15/2017 0:30"]) == [dt.datetime(2017, 10, 15, 0, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_day_and_second_diff_count_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert df.select(times.day_diff("a", "b"), times.day_diff("b", "a")).first() == (1, -1)
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 1, 100000))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert df.select(times.second_diff("a", "b")).first()[0] == 1


def test_regions(apply):
    assert len(codes.STATE_CODES) == len(set(codes.STATE_CODES)) == 27
    assert apply(codes.region_of, ["SP", "RS", "SE", "TO", "DF", "XX", "sp", None]) == [
        "Southeast",
        "South",
        "Northeast",
        "North",
        "Center-West",
        "Unknown",
        "Unknown",
        "Unknown",
    ]


def test_payment_synonyms(apply):
    values = ["Credit Card", " card", "BANK_SLIP", "gift_card", "debit card", "UNKNOWN", " Pix ", None]
    assert apply(lambda c: codes.map_synonyms(c, codes.PAYMENT_SYNONYMS), values) == [
        "credit_card",
        "credit_card",
        "boleto",
        "voucher",
        "debit_card",
        "not_defined",
        "pix",
        None,
    ]
