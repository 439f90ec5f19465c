"""The correctness gate: every query of the order tables equals its DuckDB oracle.

Row count, column names and an order-insensitive hash of the values, at
sf0.01 (the driver's scale), plus the entry smoke check at sf0.001.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from strata.plans import catalogue, oracles
from tests.conftest import SF001, has_testdata
from tools.oracle_check import TABLES, _digest

pytestmark = pytest.mark.skipif(not has_testdata(SF001), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(catalogue.queries()) == set(oracles.oracle_sql())
    assert set(oracles.oracle_sql()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF001)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(cols, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["province", "total_orders", "total_amount", "success_orders", "failed_orders"]
    assert len(rows) == 5
    assert rows[0].province == "CanTho" and rows[0].total_amount == 10000000065689627
