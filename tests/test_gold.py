"""Gold aggregation: counters, NULL groups, zero-match groups, ordering."""

from __future__ import annotations

from strata import gold
from strata.schemas import GOLD_COLUMNS, GOLD_SCHEMA, SILVER_SCHEMA


def _silver(spark, rows):
    return spark.createDataFrame(rows, schema=SILVER_SCHEMA)


ROWS = [
    ("1", "C", "Hanoi", 100.0, "SUCCESS", None),
    ("2", "C", "Hanoi", 50.0, "FAILED", None),
    ("3", "C", "Hanoi", 25.0, "PENDING", None),
    ("4", "C", "HCM", 175.0, "PENDING", None),  # no SUCCESS / FAILED at all
    ("5", "C", None, 10.0, "SUCCESS", None),  # NULL province is its own group
    ("6", "C", "DaNang", 175.0, "WEIRD", None),  # unknown status: total only
    ("7", "C", "CanTho", 0.9, "SUCCESS", None),  # truncation, not rounding
    ("8", "C", "CanTho", 0.9, None, None),
]


def test_gold_values(spark):
    g = gold(_silver(spark, ROWS))
    assert g.columns == GOLD_COLUMNS
    assert [(f.name, f.dataType) for f in g.schema] == [(f.name, f.dataType) for f in GOLD_SCHEMA]
    got = {r.province: tuple(r)[1:] for r in g.collect()}
    assert got == {
        "Hanoi": (3, 175, 1, 1),
        "HCM": (1, 175, 0, 0),
        None: (1, 10, 1, 0),
        "DaNang": (1, 175, 0, 0),
        "CanTho": (2, 1, 1, 0),
    }


def test_gold_order_desc_with_tie_break(spark):
    g = gold(_silver(spark, ROWS)).collect()
    assert [r.province for r in g] == ["DaNang", "HCM", "Hanoi", None, "CanTho"]


def test_gold_exact_total_beyond_double_precision(spark):
    # 2^53 + 1 is not a double; the sum of these parts is still exact.
    big = float(2**52)
    rows = [(str(i), "C", "P", v, "SUCCESS", None) for i, v in enumerate([big, big, 1.0, 1.0, 1.0])]
    g = gold(_silver(spark, rows)).collect()[0]
    assert g.total_amount == 2**53 + 3


def test_total_is_cut_not_rounded(spark):
    rows = [("1", "C", "P", 0.9999999, "SUCCESS", None), ("2", "C", "Q", 2.0**53, "SUCCESS", None), ("3", "C", "Q", 0.25, "S", None)]
    got = {r.province: r.total_amount for r in gold(_silver(spark, rows)).collect()}
    assert got == {"P": 0, "Q": 2**53}


def test_gold_empty(spark):
    g = gold(_silver(spark, []))
    assert g.count() == 0 and g.columns == GOLD_COLUMNS
