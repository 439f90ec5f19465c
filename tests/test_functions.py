"""Column functions on single values: the parsing semantics the rules rely on."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from strata.functions.cleaning import is_blank, is_finite, normalise_status, parse_amount, parse_date
from strata.functions.lineage import file_name_of, load_time


def _eval(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_is_blank(spark):
    values = [None, "", " ", "   ", "\t", "a", " a "]
    assert _eval(spark, values, is_blank) == [True, True, True, True, False, False, False]


def test_parse_amount(spark):
    values = ["12", " 12 ", "1e3", "-0.5", "1,000", "abc", "", None, "1d"]
    assert _eval(spark, values, parse_amount) == [12.0, 12.0, 1000.0, -0.5, None, None, None, None, 1.0]


def test_is_finite(spark):
    got = _eval(spark, ["1", "NaN", "Infinity", "-Infinity", None, "abc"], lambda c: is_finite(parse_amount(c)))
    assert got == [True, False, False, False, False, False]
    assert math.isnan(_eval(spark, ["NaN"], parse_amount)[0])


def test_parse_date_is_strict(spark):
    values = ["2026-01-05", "2026-1-5", " 2026-01-05", "2026-01-05 10:00", "2026-02-30", "2026-13-01", None]
    assert _eval(spark, values, parse_date) == [dt.date(2026, 1, 5), None, None, None, None, None, None]


def test_normalise_status(spark):
    values = ["success", " Success ", "SUCCESS", "\tfailed", None]
    assert _eval(spark, values, normalise_status) == ["SUCCESS", "SUCCESS", "SUCCESS", "\tFAILED", None]


def test_file_name_and_load_time(spark):
    assert _eval(spark, ["file:/a/b/orders.csv", "s3a://bucket/x/y.csv"], file_name_of) == ["orders.csv", "y.csv"]
    at = dt.datetime(2026, 1, 2, 3, 4, 5)
    assert _eval(spark, ["x"], lambda _c: load_time(at)) == [at]
