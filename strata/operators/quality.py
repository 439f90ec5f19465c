"""Silver data-quality rules as named Column expressions.

Rules apply in a fixed order and the first failing rule names the reason:

1. ``missing_order_id``   order_id is NULL, empty or spaces only
2. ``amount_not_numeric`` amount does not parse as a finite number
3. ``amount_not_positive`` amount parses but is <= 0
4. ``amount_out_of_range`` amount does not fit the long that Gold totals are

A row passes when its reason is NULL. Every predicate here is NULL-free, so a
row is always on exactly one side: ``bronze = silver + rejects``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import MAX_AMOUNT, is_blank, is_finite, parse_amount

# Reject reason labels, in rule order.
MISSING_ORDER_ID = "missing_order_id"
AMOUNT_NOT_NUMERIC = "amount_not_numeric"
AMOUNT_NOT_POSITIVE = "amount_not_positive"
AMOUNT_OUT_OF_RANGE = "amount_out_of_range"
REASONS: list[str] = [MISSING_ORDER_ID, AMOUNT_NOT_NUMERIC, AMOUNT_NOT_POSITIVE, AMOUNT_OUT_OF_RANGE]

# The stage names of the row-count report, in pipeline order.
STAGES: list[str] = ["bronze", "after_order_id", "after_amount", "silver", "gold"]


def order_id_present(order_id: str | Column = "order_id") -> Column:
    """Rule 1 passes: order_id is neither NULL nor blank."""
    return ~is_blank(order_id)


def reject_reason(order_id: str | Column = "order_id", parsed: str | Column = "parsed_amount") -> Column:
    """First failing rule's label, or NULL when the row passes every rule;
    ``parsed`` is the amount as a double."""
    amt = F.col(parsed) if isinstance(parsed, str) else parsed
    return (
        F.when(is_blank(order_id), F.lit(MISSING_ORDER_ID))
        .when(~is_finite(amt), F.lit(AMOUNT_NOT_NUMERIC))
        .when(amt <= F.lit(0.0), F.lit(AMOUNT_NOT_POSITIVE))
        .when(amt > F.lit(MAX_AMOUNT), F.lit(AMOUNT_OUT_OF_RANGE))
    )


def amount_valid(amount: str | Column = "amount") -> Column:
    """Rules 2 to 4 pass: amount parses to a number above 0 and up to MAX_AMOUNT
    (NULL, NaN and infinities do not)."""
    # one range test from the smallest positive double on, so the text is parsed once for it
    return F.coalesce(parse_amount(amount).between(F.lit(5e-324), F.lit(MAX_AMOUNT)), F.lit(False))


REASON_COLUMN = "reject_reason"
PARSED_COLUMN = "parsed_amount"


def with_reject_reason(df: DataFrame, name: str = REASON_COLUMN) -> DataFrame:
    """df with the amount parsed once (``parsed_amount``) and the reject reason."""
    return df.withColumn(PARSED_COLUMN, parse_amount("amount")).withColumn(name, reject_reason(parsed=PARSED_COLUMN))


def reason_metrics() -> list[Column]:
    """Aggregates over a frame carrying ``reject_reason``: row count plus one
    count per reason (for ``observe()``: counted while the layer is written)."""
    reason = F.col(REASON_COLUMN)
    return [F.count(F.lit(1)).alias("bronze")] + [F.count_if(reason == F.lit(r)).alias(r) for r in REASONS]


def rejects(bronze_df: DataFrame) -> DataFrame:
    """The rows Silver drops, with all their Bronze columns and the reason."""
    return with_reject_reason(bronze_df).filter(F.col("reject_reason").isNotNull()).drop(PARSED_COLUMN)


def reject_counts(bronze_df: DataFrame) -> DataFrame:
    """(reason, n) for every reason that occurs: one scan, partial aggregation."""
    return (
        with_reject_reason(bronze_df)
        .filter(F.col("reject_reason").isNotNull())
        .groupBy(F.col("reject_reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def stage_counts(bronze_df: DataFrame, group_key: str | None = None) -> DataFrame:
    """Rows left after each rule, as one row of counts from a single scan.

    Columns: bronze, after_order_id, after_amount, silver (equal to
    after_amount: the remaining Silver steps are projections, kept as its own
    column because it is the number a reader of the layer looks for). With
    ``group_key``, also ``gold``: the number of groups the Silver rows form on
    that key (a NULL key is one group). That is a two-level aggregate — per
    key, then global — both levels partial-then-final, so a hot key costs no
    more than any other and no row is duplicated (a DISTINCT count would
    expand every row).
    """
    id_ok = order_id_present()
    all_ok = id_ok & amount_valid()
    counts = [
        F.count(F.lit(1)).alias("bronze"),
        F.count_if(id_ok).alias("after_order_id"),
        F.count_if(all_ok).alias("after_amount"),
    ]
    if group_key is None:
        return bronze_df.agg(*counts).withColumn("silver", F.col("after_amount"))
    per_key = bronze_df.groupBy(group_key).agg(*counts)
    return per_key.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("bronze", "after_order_id", "after_amount")],
        F.coalesce(F.sum("after_amount"), F.lit(0)).cast("long").alias("silver"),
        F.count_if(F.col("after_amount") > 0).alias("gold"),
    )
