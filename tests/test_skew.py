"""Skew: a hot key costs no more shuffle than any other key."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import SF001


def test_hot_key_shuffles_only_partial_rows(tmp_path):
    """A province holding ~70 % of the orders: Gold's exchange still carries at
    most (map tasks x provinces x bins of the amount) rows, read from Spark's own
    shuffle metrics. The orders' amounts lie in two bins: one, and a few tiny ones."""
    import duckdb

    from strata.plans.oracles import SRC, gold_sql, silver_sql

    job = os.path.join(os.path.dirname(os.path.abspath(__file__)), "jobs", "skewed_gold.py")
    out = subprocess.run(
        [sys.executable, job, SF001, str(tmp_path)], capture_output=True, text=True, timeout=600, check=True
    ).stdout.strip().splitlines()[-1]
    res = json.loads(out)
    totals = {p: v[0] for p, v in res["gold"].items()}
    assert totals["Hanoi"] / sum(totals.values()) > 0.6  # the hot key
    partial_stages = [int(s) for s, n in res["stage_tasks"].items() if n == 8]
    assert partial_stages and all(res["stage_records"][str(s)] <= 8 * 5 * 2 for s in partial_stages)

    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{SF001}/orders.parquet')")
    skewed = (
        "(SELECT order_id, customer_id, CASE WHEN customer_id < 'CUS034' THEN 'Hanoi' ELSE province END AS province,"
        f" amount, status, order_date FROM {SRC} s)"
    )
    expected = {r[0]: list(r[1:]) for r in con.execute(gold_sql(silver_sql(skewed))).fetchall()}
    assert res["gold"] == expected
