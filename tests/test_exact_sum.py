"""The exact total against fractions: every double is added without loss."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from strata.operators.gold import summarise

SCHEMA = "province string, order_id string, amount double, status string"


def _total(values):
    known = [Fraction(v) for v in values if v is not None]
    total = sum(known, Fraction(0))
    return None if not known else int(total) if abs(total) >= 2**53 else int(float(total))


def _check(spark, groups):
    rows = [(k, "1", v, "S") for k, values in groups.items() for v in values]
    got = {r.province: r.total_amount for r in summarise(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == {k: _total(v) for k, v in groups.items()}


def test_every_exponent_and_sign(spark):
    draw = random.Random(3)
    exponents = [0, 0, 0, 10, 50, -8, -9, -20, -30, -60, -100, -500, -1060, -1074]
    groups = {}
    for g in range(60):
        sign = (lambda: draw.choice([1, -1])) if g % 2 else (lambda: 1)
        groups[str(g)] = [sign() * math.ldexp(draw.random() + 0.5, draw.choice(exponents)) for _ in range(draw.randint(1, 30))]
    _check(spark, groups)


def test_totals_next_to_whole_numbers(spark):
    draw = random.Random(4)
    groups = {
        "nulls": [None, None], "zero": [0.0, -0.0, None], "under": [1.0, -(2.0**-1074)], "over": [-1.0, 2.0**-1074],
        "large": [9.0e18, 2.0**53, 1.0], "cut": [0.9999999], "cancels": [2.0**62, -(2.0**62), 5.5],
    }
    for k in range(120):
        sign = draw.choice([1, -1])
        whole = 2 ** draw.randint(0, 53) - draw.randint(0, 1) if k % 2 else draw.randint(0, 100)
        tail = draw.choice([0.5, 0.75, 1 - 2.0**-53, 1 - 2.0**-20, 2.0**-60])
        groups[f"n{k}"] = [sign * float(whole), sign * tail]
        if k % 3:
            groups[f"n{k}"].append(draw.choice([1, -1]) * 2.0 ** -draw.randint(50, 1070))
    _check(spark, groups)


def test_many_small_amounts(spark):
    small = spark.range(10_000_000).select(
        F.lit("P").alias("province"), F.lit("1").alias("order_id"), F.lit(0.0000004).alias("amount"), F.lit("S").alias("status")
    )
    assert summarise(small).first().total_amount == 4


def test_totals_beyond_a_long_raise(spark):
    rows = [("P", "1", 9.0e18, "S")] * 2
    with pytest.raises(Exception, match="OVERFLOW"):
        summarise(spark.createDataFrame(rows, SCHEMA)).collect()
