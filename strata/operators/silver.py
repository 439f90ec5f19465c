"""Silver: the quality rules applied to Bronze, typed business columns only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import normalise_status, parse_amount, parse_date
from strata.operators.quality import PARSED_COLUMN, REASON_COLUMN, amount_valid, order_id_present


def silver(bronze_df: DataFrame) -> DataFrame:
    """Bronze -> Silver: drop rejected rows, type and normalise the rest.

    * rule 1: order_id present (not NULL, not blank)
    * rule 2: amount parses to a finite double above 0 that fits a long
    * rule 3: status -> ``upper(trim(status))``
    * rule 4: order_date parsed with ``yyyy-MM-dd``; a bad date becomes NULL
      and the row is kept
    * rule 5: exactly the six business columns, in fixed order

    All of it is one narrow stage (filter + project, no shuffle); the part of the
    filter that Parquet can use is pushed to the scan. A frame that carries
    ``reject_reason`` already (computed to count reasons during a write, with the
    amount parsed once a row) is only filtered and projected. Lineage columns are
    not selected, so a Parquet Bronze scan does not read them.
    """
    if REASON_COLUMN in bronze_df.columns:
        kept, amount = bronze_df.filter(F.col(REASON_COLUMN).isNull()), F.col(PARSED_COLUMN)
    else:
        kept, amount = bronze_df.filter(order_id_present() & amount_valid()), parse_amount("amount")
    return kept.select(
        F.col("order_id"),
        F.col("customer_id"),
        F.col("province"),
        amount.alias("amount"),
        normalise_status("status").alias("status"),
        parse_date("order_date").alias("order_date"),
    )
