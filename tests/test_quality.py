"""Silver rules on hand-made rows: every fault class and its reason."""

from __future__ import annotations

import datetime as dt

from strata import bronze, rejects, silver
from strata.operators.quality import reject_counts, stage_counts
from strata.schemas import BRONZE_COLUMNS, BUSINESS_COLUMNS, SILVER_SCHEMA

ROWS = [
    # order_id, customer_id, province, amount, status, order_date
    ("1", "CUS001", "Hanoi", "100", "SUCCESS", "2026-01-01"),
    (None, "CUS002", "Hanoi", "100", "SUCCESS", "2026-01-01"),  # NULL id
    ("", "CUS003", "Hanoi", "100", "SUCCESS", "2026-01-01"),  # empty id
    ("   ", "CUS004", "Hanoi", "100", "SUCCESS", "2026-01-01"),  # spaces-only id
    ("5", "CUS005", "HCM", "0", "SUCCESS", "2026-01-01"),  # zero
    ("6", "CUS006", "HCM", "-50000", "FAILED", "2026-01-01"),  # negative
    ("7", "CUS007", "HCM", "abc", "FAILED", "2026-01-01"),  # not a number
    ("8", "CUS008", "HCM", None, "FAILED", "2026-01-01"),  # NULL amount
    ("9", "CUS009", "HCM", "NaN", "FAILED", "2026-01-01"),  # NaN
    ("10", "CUS010", "HCM", "Infinity", "FAILED", "2026-01-01"),  # infinite
    ("11", "CUS011", "DaNang", " 12 ", " success ", "2026-02-03"),  # padded amount + status
    ("12", "CUS012", "DaNang", "1e3", "Failed", "2026-13-01"),  # bad date kept as NULL
    ("13", "CUS013", None, "50", "pending", "2026-1-5"),  # NULL province, non-padded date
    ("14", "CUS014", "DaNang", "7", None, None),  # NULL status and date
    ("15", "CUS015", "DaNang", "1e33", "SUCCESS", None),  # finite, but beyond a long
]


def _silver(raw_rows):
    return silver(bronze(raw_rows(ROWS), load_time_at=dt.datetime(2026, 1, 1)))


def test_silver_schema_and_rows(raw_rows):
    df = _silver(raw_rows)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]
    got = {r.order_id: r for r in df.collect()}
    assert sorted(got, key=int) == ["1", "11", "12", "13", "14"]
    assert got["11"].amount == 12.0 and got["11"].status == "SUCCESS"
    assert got["12"].amount == 1000.0 and got["12"].status == "FAILED" and got["12"].order_date is None
    assert got["13"].order_date is None  # strict pattern: single-digit month is not a date
    assert got["13"].province is None and got["13"].status == "PENDING"
    assert got["14"].status is None and got["14"].order_date is None
    assert got["1"].order_date == dt.date(2026, 1, 1)


def test_reject_reasons(raw_rows):
    b = bronze(raw_rows(ROWS))
    reasons = {r.order_id: r.reject_reason for r in rejects(b).collect()}
    assert reasons == {
        None: "missing_order_id",
        "": "missing_order_id",
        "   ": "missing_order_id",
        "5": "amount_not_positive",
        "6": "amount_not_positive",
        "7": "amount_not_numeric",
        "8": "amount_not_numeric",
        "9": "amount_not_numeric",
        "10": "amount_not_numeric",
        "15": "amount_out_of_range",
    }
    counts = {r.reason: r.n for r in reject_counts(b).collect()}
    assert counts == {"missing_order_id": 3, "amount_not_positive": 2, "amount_not_numeric": 4, "amount_out_of_range": 1}


def test_first_failing_rule_wins(raw_rows):
    b = bronze(raw_rows([(None, "C", "P", "abc", "S", "2026-01-01"), ("  ", "C", "P", "-1", "S", "x")]))
    assert [r.reject_reason for r in rejects(b).collect()] == ["missing_order_id"] * 2


def test_bronze_equals_silver_plus_rejects(raw_rows):
    b = bronze(raw_rows(ROWS))
    assert b.count() == silver(b).count() + rejects(b).count()


def test_stage_counts(raw_rows):
    row = stage_counts(bronze(raw_rows(ROWS)), group_key="province").collect()[0]
    assert row.bronze == 15 and row.after_order_id == 12 and row.after_amount == 5 and row.silver == 5
    assert row.gold == 3  # Hanoi, DaNang, and the NULL province group


def test_bronze_keeps_raw_text(raw_rows):
    b = bronze(raw_rows(ROWS), load_time_at=dt.datetime(2026, 5, 1))
    assert b.columns == BRONZE_COLUMNS
    rows = b.select(*BUSINESS_COLUMNS).collect()
    assert [tuple(r) for r in rows] == ROWS  # nothing trimmed, cast or dropped
    assert {r.load_time for r in b.select("load_time").collect()} == {dt.datetime(2026, 5, 1)}


def test_empty_input_keeps_schema(raw_rows):
    empty = raw_rows([])
    assert [f.dataType for f in silver(bronze(empty)).schema] == [f.dataType for f in SILVER_SCHEMA]
    assert silver(bronze(empty)).count() == 0
