"""Edge rows for the scalar cleaning functions (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordersmith.functions import scalars as X


def run(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_order_date_from_sn(spark):
    vals = ["250604X1", "20250604X1", "20101204X1", "700604X1", "680101X1", "abc", "", None, "250230X1",
            "9901 5zz", "991311xx", "19991231"]
    exp = [dt.date(2025, 6, 4), dt.date(2025, 6, 4), dt.date(2020, 10, 12), dt.date(1970, 6, 4),
           dt.date(2068, 1, 1), None, None, None, None, dt.date(1999, 1, 5), None, dt.date(1999, 12, 31)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    assert [r.d for r in X.with_order_date_from_sn(df, "v", "d").orderBy("i").collect()] == exp


def test_currency(spark):
    vals = ["NT$1,234.5", "-5", "-", "1.2.3", "(100)", "1e3", "nan", "", None]
    assert run(spark, vals, X.currency_to_double) == [1234.5, -5.0, None, None, 100.0, 13.0, None, None, None]


def test_percent(spark):
    assert run(spark, ["2%", "0.02", "x", None], X.percent_to_fraction) == [0.02, 0.0002, 0.0, 0.0]


def test_integer(spark):
    assert run(spark, ["1", "1.0", "1.5", "x", None], X.to_nullable_long) == [1, 1, None, None, None]
    assert run(spark, ["1", "1.0", "1.5", "x", None], X.is_fractional_integer_text) == [False, False, True, False, False]


def test_timestamp(spark):
    vals = ["2025-06-01 10:00", "2025/06/02 11:00", "-", "nan", None, "2025-06-03"]
    exp = [dt.datetime(2025, 6, 1, 10), dt.datetime(2025, 6, 2, 11), None, None, None, dt.datetime(2025, 6, 3)]
    assert run(spark, vals, X.to_timestamp_tolerant) == exp


def test_date_tolerant(spark):
    vals = ["1998-01-02", "1998/1/2", "19980102", "1998-01-02 10:00:00", "-", None, "02/01/1998"]
    exp = [dt.date(1998, 1, 2)] * 4 + [None, None, dt.date(1998, 2, 1)]
    assert run(spark, vals, X.to_date_tolerant) == exp


def test_null_tokens(spark):
    vals = ["nan", "NaN", "None", "", None, "Nantes"]
    assert run(spark, vals, lambda c: X.null_tokens_to(c, "")) == ["", "", "", "", "", "Nantes"]
    assert run(spark, vals, lambda c: X.null_tokens_to(c)) == [None, None, None, "", None, "Nantes"]


def test_newlines(spark):
    assert run(spark, ["a\nb\r", None], X.strip_newlines) == ["a b", None]


def test_to_number_nan(spark):
    assert run(spark, ["nan", "1e3", " 12 ", "x"], X.to_number) == [None, 1000.0, 12.0, None]


@pytest.mark.parametrize("name,shop,acct", [
    ("shop_acc_1_Order.all.20250504_20250603.xlsx", "shop", "acc_1"),
    ("shop_Order.all.x.xlsx", None, None),
    ("x.xlsx", None, None),
    ("_acc_Order.all.x.xlsx", None, None),
])
def test_file_name(spark, name, shop, acct):
    assert run(spark, [name], X.file_shop_name) == [shop]
    assert run(spark, [name], X.file_shop_account) == [acct]


def test_keys(spark):
    assert run(spark, [" a ", "nan", "", None], X.key_part) == ["a", None, None, None]
    assert run(spark, [" s ", "", None], X.sku_key) == ["s", "NULL_SKU", "NULL_SKU"]
    df = spark.createDataFrame([(None, " 1 ", None)], "d date, sn string, b string")
    assert df.select(X.display_order_key("d", "sn", "b")).first()[0] == "NO_DATE|||1|||NO_BUYER"


def test_order_date_more_heads(spark):
    vals = [" 250604 ", "00000101", "12345", "2025064", "991301"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r.d for r in X.with_order_date_from_sn(df, "v", "d").orderBy("i").collect()]
    assert got == [dt.date(2025, 6, 4), None, None, None, None]


def test_timestamp_with_a_zone_is_rejected(spark):
    vals = ["2025-06-04T10:00:00+08:00", "2025-06-04 10:00:00Z", "2025-06-04 10:00:00", "2025/06/04 10:00"]
    assert run(spark, vals, X.to_timestamp_tolerant) == [
        None, None, dt.datetime(2025, 6, 4, 10), dt.datetime(2025, 6, 4, 10)]
