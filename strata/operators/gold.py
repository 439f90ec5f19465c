"""Gold: per-key business summary of Silver.

Two hash aggregates. The first is by key and bin of the amount (see
:mod:`strata.functions.exact_sum`; amounts in use are all in one bin) and runs partial
(map side, one row per key and bin per task) then final, so the shuffle carries at most
``tasks x keys x bins`` rows no matter how the rows are spread over keys — a key holding
a third of all orders costs the same as any other. The second adds up the few bins of a
key. The final sort is over the few result rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exact_sum import DIGITS, exact_bin, exact_digits, truncated_total
from strata.schemas import FAILED, SUCCESS

# The Gold per-status counters and the status each one counts.
GOLD_STATUS_COUNTS: dict[str, str] = {"success_orders": SUCCESS, "failed_orders": FAILED}

BIN = "amount_bin"


def summary_parts(
    df: DataFrame,
    key: str = "province",
    id_col: str = "order_id",
    amount_col: str = "amount",
    status_col: str = "status",
    status_counts: dict[str, str] | None = None,
) -> DataFrame:
    """One row per key and bin of the amount: counts and exact digit sums. It is one
    aggregate, so a stream can keep it as its state."""
    status_counts = GOLD_STATUS_COUNTS if status_counts is None else status_counts
    amount, status = f"CAST(`{amount_col}` AS DOUBLE)", F.col(status_col)
    return df.groupBy(key, F.expr(exact_bin(amount)).alias(BIN)).agg(
        F.count(id_col).alias("total_orders"),
        *[F.count_if(status == F.lit(label)).alias(name) for name, label in status_counts.items()],
        *[F.expr(f"sum({digit})").alias(name) for name, digit in exact_digits(amount).items()],
    )


def summary_of_parts(parts: DataFrame, key: str = "province") -> DataFrame:
    """The summary from its parts: the bins of a key added up, the total exact and
    independent of row order and partitioning, then truncated to a long (a total beyond
    a long raises instead of returning a silent NULL)."""
    counts = [c for c in parts.columns if c not in (key, BIN, *DIGITS, "total_orders")]
    return parts.groupBy(key).agg(
        F.sum("total_orders").alias("total_orders"),
        truncated_total(BIN, DIGITS).alias("total_amount"),
        *[F.sum(c).alias(c) for c in counts],
    )


def summarise(
    df: DataFrame,
    key: str = "province",
    id_col: str = "order_id",
    amount_col: str = "amount",
    status_col: str = "status",
    status_counts: dict[str, str] | None = None,
    order: bool = True,
) -> DataFrame:
    """``key, total_orders, total_amount, <one count per status label>``.

    ``total_orders`` counts non-NULL ids; each status counter is a
    conditional count, 0 (not NULL) for a group without that status. A NULL
    key forms its own group. With ``order`` the result is sorted by
    ``total_amount`` descending (NULLs last), ties broken by key.
    """
    out = summary_of_parts(summary_parts(df, key, id_col, amount_col, status_col, status_counts), key)
    return order_gold(out, key) if order else out


def order_gold(df: DataFrame, key: str = "province") -> DataFrame:
    """Report order: ``total_amount`` descending (NULLs last), ties by key."""
    return df.orderBy(F.col("total_amount").desc_nulls_last(), F.col(key).asc_nulls_first())


def gold(silver_df: DataFrame, order: bool = True) -> DataFrame:
    """Silver -> Gold: per province, total/amount/success/failed."""
    return summarise(silver_df, order=order)
