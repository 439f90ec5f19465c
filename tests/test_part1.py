"""Literal sample table, select/filter/group, DataFrame vs SQL forms."""

from __future__ import annotations

from strata.operators import summaries
from strata.plans.sql import sql_province_totals
from strata.schemas import ORDER_SCHEMA
from strata.sources.literal import sample_orders


def test_sample_schema_and_rows(spark):
    df = sample_orders(spark)
    assert df.schema == ORDER_SCHEMA
    assert df.count() == 8


def test_sample_success_and_totals(spark):
    df = sample_orders(spark)
    assert [r.order_id for r in summaries.filter_status(df).orderBy("order_id").collect()] == [102, 105, 109, 110, 118]
    got = [tuple(r) for r in summaries.province_totals(df, status="SUCCESS").collect()]
    assert got == [("Lao Cai", 2, 3000095500), (None, 1, 610000), ("Ben Tre", 1, 331000), ("Nghe An", 1, 12250)]


def test_sql_and_dataframe_forms_agree(spark):
    df = sample_orders(spark)
    a = summaries.province_totals(df, status="SUCCESS")
    b = sql_province_totals(spark, df, status="SUCCESS")
    assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]
    assert b.schema["total_amount"].dataType.simpleString() == "bigint"
    all_status = {r.province: (r.total_orders, r.total_amount) for r in sql_province_totals(spark, df).collect()}
    assert all_status["Nghe An"] == (2, 752250) and all_status["Ben Tre"] == (2, 331000)


def test_status_filter_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, "C", "P", 1, "success"), (2, "C", "P", 1, "SUCCESS")], ORDER_SCHEMA)
    assert summaries.filter_status(df).count() == 1


def test_preview_is_top_k_by_key(spark):
    df = sample_orders(spark)
    assert [r.order_id for r in summaries.preview(df, 3).collect()] == [101, 102, 105]
