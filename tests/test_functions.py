"""Scalar expressions against hand-made values."""

import datetime as dt
import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cotalake.functions import dates, numbers, text
from cotalake.operators import periods, relationship


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def test_known_surrogate_keys(spark):
    assert column(spark, ["191", "192", ""], "string", text.hash_key) == [898300, 770285, 178366]


def test_surrogate_key_is_the_md5_integer(spark):
    values = [str(n * 7919).zfill(14) for n in range(200)]
    expected = [int(hashlib.md5(v.encode()).hexdigest(), 16) % 1_000_000 for v in values]
    assert column(spark, values, "string", text.hash_key) == expected


def test_cnpj_keeps_leading_zeros(spark):
    assert column(spark, ["00.000.000/0001-91", "--", None], "string", text.normalize_cnpj) == ["00000000000191", "", None]


def test_strip_blanks(spark):
    values = ["\t\xa0 x  \n", " \t ", "a b", None, "\x1cx　"]
    assert column(spark, values, "string", text.strip_blanks) == ["x", "", "a b", None, "x"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\xa0 abcé", max_size=12), min_size=1, max_size=20))
def test_strip_is_python_strip_and_idempotent(spark, values):
    once = column(spark, values, "string", text.strip_blanks)
    assert once == [v.strip() for v in values]
    assert column(spark, once, "string", text.strip_blanks) == once


def test_number_coercion(spark):
    values = ["1", "1.5", "1,5", " 2 ", "1e3", "", "inf", "x", "1_0", "0x10", "True", "10d", "-Infinity", ".5", "5."]
    got = column(spark, values, "string", numbers.to_number)
    assert got == [1, 1.5, None, 2, 1000, None, math.inf, None, None, None, None, None, -math.inf, 0.5, 5.0]


def test_date_coercion(spark):
    values = ["2024-01-01", "2024-01-02 10:00", "02/01/2024", "2024-1-3", "bad", None, "2024-02-30"]
    got = column(spark, values, "string", dates.parse_report_date)
    assert got == [dt.date(2024, 1, 1), None, None, dt.date(2024, 1, 3), None, None, None]


def test_plain_dates_do_not_take_the_pattern(spark):
    """Ten-digit dates are cast; others give what the pattern alone gives."""
    values = ["2024-12-31", "0000-01-01", "2024-13-01", "2023-02-29", "2024-01-01\n", " 2024-01-01", "2024-1-03", "02024-1-1", "+2024-1-1",
              "12024-01-01", "+12024-01-01", "-2024-01-01", "2024--1-1", "2024-001-1", "24-1-1", "ontem", "", "1-2", "٢٠٢٤-01-01", "a2024-01-01", "2024-01-01-1"]
    got = column(spark, values, "string", lambda c: dates.parse_report_date(c).cast("string"))
    assert got == column(spark, values, "string", lambda c: F.try_to_timestamp(c, F.lit("yyyy-M-d")).cast("date").cast("string"))
    assert "TRY_CAST" in str(dates.parse_report_date(F.col("x"))).upper()


def test_date_keys(spark):
    assert column(spark, [dt.date(2024, 2, 9)], "date", dates.date_key) == [20240209]
    assert column(spark, [20240229, 20230229, 20241301], "int", dates.key_to_date) == [dt.date(2024, 2, 29), None, None]
    assert column(spark, [20240209, 19991231], "int", dates.month_key) == [202402, 199912]


def test_clip_keeps_null(spark):
    values = [None, math.nan, -1.0, 0.0, 50.0, 101.0, math.inf]
    assert column(spark, values, "double", lambda v: numbers.clip(v, 0, 100)) == [None, None, 0, 0, 50, 100, 100]


def test_floor_value(spark):
    assert column(spark, [None, 1.0, 30000.0], "double", lambda v: numbers.floor_value(v, 20000)) == [None, 20000, 30000]


def test_ratio_change(spark):
    pairs = [(110.0, 100.0), (0.0, 0.0), (5.0, 0.0), (-5.0, 0.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, c double, p double")
    got = [r["o"] for r in df.select("i", numbers.ratio_change(F.col("c"), F.col("p"), 100).alias("o")).orderBy("i").collect()]
    assert got[0] == pytest.approx(10)
    assert got[1:] == [None, math.inf, -math.inf, None, None]


def test_local_band_edges(spark):
    values = [0.0, 1e-9, 25.0, 25.1, 50.0, 100.0, None, math.inf]

    def band(v):
        return periods.risk_band(numbers.clip(v, 0, 100))

    assert column(spark, values, "double", band) == [None, "baixo", "baixo", "medio", "medio", "alto", None, "alto"]


def test_cloud_score_never_reaches_the_lowest_band(spark):
    assert column(spark, [0.0, None, 3.0, 9.0], "double", periods.risk_score_cloud) == [50, 50, 80, 100]
    bands = column(spark, [0.0, None, 3.0], "double", lambda v: periods.risk_band(periods.risk_score_cloud(v), "cloud"))
    assert bands == ["medio", "medio", "alto"]


def test_age_bands(spark):
    got = column(spark, [20.0, 20.5, 30.0, 100.0, 101.0, None], "double", relationship.age_band)
    assert got == [None, "21-30", "21-30", "60+", None, None]


def test_client_levels_are_left_closed(spark):
    got = column(spark, [44.9, 45.0, 69.9, 70.0, None], "double", relationship.client_risk_level)
    assert got == ["estavel", "atencao", "atencao", "critico", None]


def test_business_id(spark):
    assert column(spark, [42, 12345678], "bigint", text.business_id) == ["CLI_0000042", "CLI_12345678"]


def test_band_arguments():
    with pytest.raises(ValueError):
        numbers.right_closed_band(F, [0, 1], ["a", "b"])
    with pytest.raises(ValueError):
        numbers.left_closed_band(F, [1], ["a"])
