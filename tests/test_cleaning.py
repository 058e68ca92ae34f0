"""Scalar functions on chosen values."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import attributes as A
from lakeloom.functions import cleaning as C
from lakeloom.functions import keys


def apply(spark, values, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(function("v")).collect()]


def test_clean_text_collapses_and_nulls(spark):
    values = ["  São\t\n Paulo  ", "", "   ", None, "Rio"]
    assert apply(spark, values, "string", C.clean_text) == ["são paulo", None, None, None, "rio"]


def test_clean_code_keeps_inner_spaces(spark):
    assert apply(spark, [" sp ", "in  transit", "", None], "string", C.clean_code) == ["SP", "IN  TRANSIT", None, None]


def test_blank_to_null_keeps_text_whole(spark):
    values = ["  line one\nline two ", "   ", "", None]
    assert apply(spark, values, "string", C.blank_to_null) == ["  line one\nline two ", None, None, None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2017-10-02 10:56:33", datetime(2017, 10, 2, 10, 56, 33)),
        ("2016-02-29 00:00:00", datetime(2016, 2, 29)),
        ("2017-02-29 00:00:00", None),
        ("2017-13-01 00:00:00", None),
        ("2017-10-02", None),
        ("2017-10-02T10:56:33", None),
        ("2017-10-02 10:56:33.5", None),
        ("2017-10-02 10:56:33+01:00", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_to_timestamp_takes_one_format(spark, text, expected):
    assert apply(spark, [text], "string", C.to_timestamp) == [expected]


def test_to_money_rounds_half_up_and_never_fails(spark):
    values = ["10.005", "-10.005", " 7 ", "abc", "", "99999999999.99", None]
    expected = [Decimal("10.01"), Decimal("-10.01"), Decimal("7.00"), None, None, None, None]
    assert apply(spark, values, "string", C.to_money) == expected


def test_to_int_takes_whole_numbers_with_a_fraction(spark):
    values = ["40", "40.0", "40.9", "39.99999999", " 3", "x", "", "99999999999", None]
    assert apply(spark, values, "string", C.to_int) == [40, 40, 40, 39, 3, None, None, None, None]


def test_date_key_of_missing_date_is_unknown(spark):
    values = [datetime(2020, 1, 9, 23, 59), None]
    assert apply(spark, values, "timestamp", keys.date_key) == [20200109, -1]


def test_version_key_separates_its_parts(spark):
    rows = spark.createDataFrame(
        [("ab", date(2020, 1, 1)), ("a", date(2020, 1, 1)), ("-1", date(2020, 1, 1))], "k string, valid_from date"
    )
    found = [r[0] for r in rows.select(keys.version_key("k")).collect()]
    assert len(set(found)) == 3 and found[2] == "-1" and len(found[0]) == 64


def test_batch_id_repeats_for_the_same_day():
    assert keys.batch_id("orders", date(2026, 8, 1)) == keys.batch_id("orders", date(2026, 8, 1))
    assert keys.batch_id("orders", date(2026, 8, 1)) != keys.batch_id("orders", date(2026, 8, 2))


def test_weight_bucket_bounds(spark):
    found = apply(spark, [499, 500, 2000, 2001, None], "int", lambda c: A.weight_bucket(F.col(c)))
    assert found == ["ligero", "medio", "medio", "pesado", None]


def test_segment_bounds(spark):
    values = [Decimal("4999.99"), Decimal("5000.00"), Decimal("50000.00"), Decimal("50000.01")]
    found = apply(spark, values, "decimal(12,2)", lambda c: A.segment_of(F.col(c)))
    assert found == ["Bronze", "Silver", "Silver", "Gold"]


def test_region_of_all_states_and_of_none(spark):
    found = apply(spark, ["SP", "BA", "DF", "AM", "RS", "XX", None], "string", lambda c: A.region_of(F.col(c)))
    assert found == ["Sudeste", "Nordeste", "Centro-Oeste", "Norte", "Sul", None, None]


def test_volume_does_not_overflow(spark):
    found = apply(spark, [100_000], "int", lambda c: A.volume_cm3(F.col(c), F.col(c), F.col(c)))
    assert found == [10**15]


def test_months_since_counts_calendar_months(spark):
    df = spark.createDataFrame([(date(2020, 1, 31), date(2020, 2, 1))], "a date, b date")
    assert df.select(A.months_since(F.col("a"), F.col("b"))).first()[0] == 1


def test_late_by_hours_on_the_promised_day_is_up_to_three_days(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 1, 9), datetime(2020, 1, 1))], "delivered timestamp, promised timestamp")
    late = A.is_late(F.col("delivered"), F.col("promised"))
    assert df.select(late, A.delay_bucket(late, F.datediff("delivered", "promised"))).first() == (1, "1-3 dias")


def test_key_date_is_the_inverse_of_date_key(spark):
    values = [20200229, 19000101, 99991231, -1, None]
    expected = [date(2020, 2, 29), date(1900, 1, 1), date(9999, 12, 31), None, None]
    assert apply(spark, values, "int", keys.key_date) == expected
