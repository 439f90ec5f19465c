"""A small literal order table with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.schemas import ORDER_SCHEMA

# An eight-row sample (order_id, customer_id, province, amount, status) with a
# repeated province, a missing province, a missing amount and a large amount.
SAMPLE_ORDERS: list[tuple[int, str, str | None, int | None, str]] = [
    (101, "C-ana", "Nghe An", 740_000, "FAILED"),
    (102, "C-bao", "Lao Cai", 95_500, "SUCCESS"),
    (105, "C-chi", None, 610_000, "SUCCESS"),
    (109, "C-bao", "Lao Cai", 3_000_000_000, "SUCCESS"),
    (110, "C-dung", "Nghe An", 12_250, "SUCCESS"),
    (114, "C-emi", "Ben Tre", None, "PENDING"),
    (118, "C-ana", "Ben Tre", 331_000, "SUCCESS"),
    (120, "C-gia", "Ca Mau", 77_700, "CANCELLED"),
]


def sample_orders(spark: SparkSession) -> DataFrame:
    """The sample table as a DataFrame (explicit schema, order_id non-null)."""
    return spark.createDataFrame(SAMPLE_ORDERS, schema=ORDER_SCHEMA)
