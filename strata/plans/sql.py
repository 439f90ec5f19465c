"""SQL forms of the order summaries.

A DataFrame is passed to ``spark.sql`` as a named argument instead of being
registered as a session-global temp view, and the status is a bound
parameter, not spliced text. Catalyst plans the SQL and DataFrame forms
identically (same partial/final aggregate, same pushed filter).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A missing status asks for all rows.
PROVINCE_TOTALS = """
SELECT province,
       COUNT(*)    AS total_orders,
       SUM(amount) AS total_amount
FROM {orders}
WHERE :status IS NULL OR status = :status
GROUP BY province
ORDER BY total_amount DESC NULLS LAST, province
"""


def sql_province_totals(spark: SparkSession, orders: DataFrame, status: str | None = None) -> DataFrame:
    """Per-province row count and amount sum, optionally for one status."""
    return spark.sql(PROVINCE_TOTALS, args={"status": status}, orders=orders)
