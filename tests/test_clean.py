"""Scalar cleaning edges (§1.2): blank and malformed numbers, impossible dates, JSON-or-text."""

import datetime as dt

from pyspark.sql import functions as F

from perilscope.functions import clean


def one(spark, expr_col, rows, schema="v string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr_col).collect()]


def test_coerce_int(spark):
    got = one(spark, clean.coerce_int("v"), [("1900?",), ("  1975 ",), ("3.7",), ("",), ("  ",), (None,), ("abc",),
                                              ("-12x",), ("99999999999999999999999",)])
    assert got == [1900, 1975, 3, None, None, None, None, -12, None]


def test_coerce_float(spark):
    got = one(spark, clean.coerce_float("v"), [("12,345.6",), (".5",), ("1e5",), ("n/a",), ("",), ("-3.25",), (None,)])
    assert got == [12345.6, 5.0, 1.0, None, None, -3.25, None]


def test_safe_cast_never_raises(spark):
    got = one(spark, clean.safe_cast("v", "timestamp_ntz"),
              [("2023-02-30 00:00:00",), (" ",), ("2024-01-05 06:00:00",), ("garbage",)])
    assert got == [None, None, dt.datetime(2024, 1, 5, 6), None]
    assert one(spark, clean.safe_cast("v", "double"), [("degrees_north",), ("45.5",)]) == [None, 45.5]


def test_datetime_from_parts_guards(spark):
    rows = [(2023, 2, 30, 1, 2, 3.7), (2023, 2, 3, 1, 2, 3.7), (2023, 2, 3, 24, 0, 0.0),
            (2023, 13, 1, 0, 0, 0.0), (2023, 2, 3, 1, 2, None), (0, 1, 1, 0, 0, 0.0), (2023, 1, 1, 0, 0, 60.0)]
    df = spark.createDataFrame(rows, "y long, m long, d long, hh long, mm long, ss double")
    got = [r[0] for r in df.select(clean.datetime_from_parts("y", "m", "d", "hh", "mm", "ss")).collect()]
    assert got == [None, dt.datetime(2023, 2, 3, 1, 2, 3), None, None, dt.datetime(2023, 2, 3, 1, 2, 0), None, None]


def test_parse_yyyymmdd(spark):
    df = spark.createDataFrame([(20240131,), (20240231,), (None,), (2024013,)], "v int")
    got = [r[0] for r in df.select(clean.parse_yyyymmdd("v")).collect()]
    assert got == [dt.datetime(2024, 1, 31), None, None, None]


def test_pick_label(spark):
    rows = [('{"code":"US","name":"x"}',), ('{"name":"Chile"}',), ('{"code":null,"name":"Peru"}',),
            ('["a","b"]',), ("plain",), (None,), ('{"other":1}',)]
    assert one(spark, clean.pick_label("v", ("code", "name")), rows) == ["US", "Chile", "Peru", None, "plain", None, None]


def test_null_safe_sum_and_fmt(spark):
    df = spark.createDataFrame([(None, 2), (None, None), (1, 1)], "a long, b long")
    assert [r[0] for r in df.select(clean.null_safe_sum("a", "b")).collect()] == [2, 0, 2]
    df = spark.createDataFrame([(0.125,), (2.0,), (-0.0049,), (None,)], "x double")
    assert [r[0] for r in df.select(clean.fmt_num("x", 2)).collect()] == ["0.13", "2.00", "0.00", None]


def test_log_population_and_grid(spark):
    df = spark.createDataFrame([(None,), (0,), (999,)], "p long")
    got = [r[0] for r in df.select(clean.log_population("p")).collect()]
    assert got[0] == 0.0 and got[1] == 0.0 and abs(got[2] - 3.0) < 1e-12
    df = spark.createDataFrame([(-0.1,), (0.49,), (0.5,), (179.99,)], "x double")
    assert [r[0] for r in df.select(clean.grid_bin("x", 0.5)).collect()] == [-1, 0, 1, 359]
