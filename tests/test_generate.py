"""Generators: determinism, partition independence, domains and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import bronze, rejects, silver
from strata.sources.generate import (
    AMOUNT_RANGE,
    PROVINCES,
    STATUSES,
    generate_clean_orders,
    generate_dirty_orders,
)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_clean_same_rows_under_any_partitioning(spark):
    one = generate_clean_orders(spark, ids=spark.range(0, 3000, 1, 1))
    seven = generate_clean_orders(spark, ids=spark.range(0, 3000, 1, 7))
    assert _rows(one) == _rows(seven)
    assert _rows(generate_clean_orders(spark, n=3000)) == _rows(one)


def test_seed_changes_data(spark):
    a = generate_clean_orders(spark, n=200, seed=1)
    b = generate_clean_orders(spark, n=200, seed=2)
    assert _rows(a) != _rows(b)


def test_clean_domains_and_weights(spark):
    df = generate_clean_orders(spark, n=20000)
    stats = df.agg(
        F.min("amount").alias("lo"), F.max("amount").alias("hi"),
        F.count_distinct("customer_id").alias("customers"),
        F.min("order_id").alias("first"), F.max("order_id").alias("last"),
    ).collect()[0]
    assert AMOUNT_RANGE[0] <= stats.lo and stats.hi <= AMOUNT_RANGE[1]
    assert stats.customers == 50 and stats.first == 1 and stats.last == 20000
    share = {r.status: r["count"] / 20000 for r in df.groupBy("status").count().collect()}
    assert set(share) == set(STATUSES)
    assert abs(share["SUCCESS"] - 0.6) < 0.02 and abs(share["FAILED"] - 0.1) < 0.02
    assert {r.province for r in df.select("province").distinct().collect()} == set(PROVINCES)


def test_dirty_fault_rates_and_silver(spark):
    n = 25000
    raw = generate_dirty_orders(spark, n=n)
    b = bronze(raw)
    counts = {r.reject_reason: r["count"] for r in rejects(b).groupBy("reject_reason").count().collect()}
    assert abs(counts["missing_order_id"] / n - 15 / 250) < 0.006
    assert abs(counts["amount_not_positive"] / n - 15 / 250) < 0.006
    assert "amount_not_numeric" not in counts
    s = silver(b)
    assert {r.status for r in s.select("status").distinct().collect()} == set(STATUSES)
    assert s.filter(F.col("order_date").isNull()).count() == 0
    spellings = {r.status for r in raw.filter(F.upper("status") == "SUCCESS").select("status").distinct().collect()}
    assert spellings == {"SUCCESS", "success", "Success"}


def test_dirty_shuffle_keeps_rows(spark):
    a = generate_dirty_orders(spark, n=500)
    b = generate_dirty_orders(spark, n=500, shuffle=True)
    assert _rows(a) == _rows(b)


def test_large_ids_and_seeds_match_duckdb(spark):
    import duckdb

    from strata.sources.generate import clean_orders_sql, dirty_orders_sql

    ids = [0, 1, 2**31 - 1, 2**31, 2**32 + 5, 2**40 + 7, 10**15 + 3, 2**62]
    con = duckdb.connect()
    id_sql = "SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT)" for i in ids) + ") t(id)"
    id_df = spark.createDataFrame([(i,) for i in ids], "id long")
    for seed in (0, 42, 2**31 - 1):
        assert _rows(generate_dirty_orders(spark, ids=id_df, seed=seed)) == sorted(
            con.execute(dirty_orders_sql(id_sql, seed)).fetchall()
        )
        assert _rows(generate_clean_orders(spark, ids=id_df, seed=seed)) == sorted(
            con.execute(clean_orders_sql(id_sql, seed)).fetchall()
        )
