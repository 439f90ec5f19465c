"""Order-table summaries in DataFrame form (select, filter, group, sort)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.schemas import SUCCESS


def select_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def filter_status(df: DataFrame, status: str = SUCCESS) -> DataFrame:
    """Case-sensitive equality on status; pushed to a Parquet scan as ``EqualTo``."""
    return df.filter(F.col("status") == F.lit(status))


def province_totals(df: DataFrame, status: str | None = None) -> DataFrame:
    """``province, total_orders, total_amount`` per province, largest total first.

    ``total_orders`` counts non-NULL order ids; ``total_amount`` is the sum of
    an integer amount (bigint). Optional case-sensitive status filter first.
    """
    if status is not None:
        df = filter_status(df, status)
    return (
        df.groupBy("province")
        .agg(F.count("order_id").alias("total_orders"), F.sum("amount").alias("total_amount"))
        .orderBy(F.col("total_amount").desc_nulls_last(), F.col("province").asc_nulls_first())
    )


def preview(df: DataFrame, n: int = 10, key: str = "order_id") -> DataFrame:
    """First ``n`` rows by ``key``: a top-k (TakeOrderedAndProject), deterministic,
    each task keeps only its own top ``n`` before the merge."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)
