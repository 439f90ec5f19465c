"""Order generators: clean typed orders and dirty raw orders at any size.

Rows are keyed by an id column — ``spark.range(n)`` or the key of an
existing table — and every field is a deterministic draw of
(seed, id, slot) (see :mod:`strata.functions.draws`). Generation is a chain of
narrow projections: no shuffle, no driver-side loop, same rows under any
partitioning. ``shuffle=True`` adds a global sort on a hash to scatter rows
when the physical order of a file matters (a distributed range sort).

Land generated rows as files (:func:`land_dirty_orders`) before reading them
with filters, as a real source would arrive: chained lazily, the optimizer
pushes a consumer's filter into the generator's projections and evaluates
the digests once per reference instead of once per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.functions.draws import (
    DUCKDB,
    SPARK,
    Dialect,
    below,
    hashes_sql,
    pick,
    randint,
    uniform,
    weighted,
    with_hashes,
)
from strata.sources.files import CSV_KEEP_BLANKS

DEFAULT_SEED = 42

# Generator domains.
PROVINCES = ["Hanoi", "HCM", "DaNang", "HaiPhong", "CanTho"]
STATUSES = ["SUCCESS", "PENDING", "CANCELLED", "FAILED"]
CLEAN_STATUS_WEIGHTS = [0.6, 0.2, 0.1, 0.1]
DIRTY_STATUS_WEIGHTS = [0.55, 0.2, 0.1, 0.15]
CUSTOMERS = 50  # CUS001 .. CUS050
AMOUNT_RANGE = (50_000, 5_000_000)  # whole VND
NON_POSITIVE_AMOUNTS = ["0", "-1", "-50000"]
START_DATE = "2026-01-01"
DATE_SPAN_DAYS = 250  # order_date in START_DATE + [0, 250] days
# Fault rates of the dirty source: 15 blank ids and 15 non-positive amounts per 250 rows.
BLANK_ID_RATE = 15 / 250
NON_POSITIVE_RATE = 15 / 250

# Draw width per slot: 32 bits where the domain is large, 16 for the rest;
# a dirty row's seven draws fill exactly one md5 digest.
CLEAN_SLOTS = {"amount": 32, "customer": 16, "province": 16, "status": 16}
DIRTY_SLOTS = {"amount": 32, "fault": 16, "customer": 16, "province": 16, "group": 16, "variant": 16, "date": 16}


def _customer(h: str, d: Dialect) -> str:
    return f"concat('CUS', lpad({d.to_text(randint(h, 1, CUSTOMERS))}, 3, '0'))"


def clean_columns(d: Dialect) -> list[str]:
    return [
        "id + 1 AS order_id",
        f"{_customer('h_customer', d)} AS customer_id",
        f"{pick('h_province', PROVINCES)} AS province",
        # a uniform real amount rounded to whole VND (half away from zero)
        f"CAST(round({uniform('h_amount', *AMOUNT_RANGE, CLEAN_SLOTS['amount'])}, 0) AS INT) AS amount",
        f"{weighted('h_status', STATUSES, CLEAN_STATUS_WEIGHTS, CLEAN_SLOTS['status'])} AS status",
    ]


def dirty_columns(d: Dialect) -> list[str]:
    fault_bits = DIRTY_SLOTS["fault"]
    blank = below("h_fault", BLANK_ID_RATE, fault_bits)
    faulty = below("h_fault", BLANK_ID_RATE + NON_POSITIVE_RATE, fault_bits)
    non_positive = f"(NOT {blank} AND {faulty})"
    group = (
        f"(CASE WHEN {faulty} THEN 'SUCCESS' "
        f"ELSE {weighted('h_group', STATUSES, DIRTY_STATUS_WEIGHTS, DIRTY_SLOTS['group'])} END)"
    )
    return [
        f"CASE WHEN {blank} THEN '' ELSE {d.to_text('id + 1')} END AS order_id",
        f"{_customer('h_customer', d)} AS customer_id",
        f"{pick('h_province', PROVINCES)} AS province",
        f"CASE WHEN {non_positive} THEN {pick('h_amount', NON_POSITIVE_AMOUNTS)} "
        f"ELSE {d.to_text(randint('h_amount', *AMOUNT_RANGE))} END AS amount",
        # upper / lower / capitalised spelling of the status group
        f"CASE h_variant % 3 WHEN 0 THEN {group} WHEN 1 THEN lower({group}) "
        f"ELSE concat(substr({group}, 1, 1), lower(substr({group}, 2))) END AS status",
        f"{d.to_text(d.add_days(START_DATE, randint('h_date', 0, DATE_SPAN_DAYS)))} AS order_date",
    ]


# Rows per generator task when generating from ``n``: tasks stay short however
# large ``n`` is (``spark.range(n)`` alone makes one task per core).
ROWS_PER_PARTITION = 5_000_000


def _ids(spark: SparkSession, n: int | None, ids: DataFrame | None, id_col: str) -> DataFrame:
    if ids is not None:
        return ids.select(ids[id_col].cast("long").alias("id"))
    if n is None:
        raise ValueError("give n or an id DataFrame")
    parts = max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_PARTITION))
    return spark.range(0, n, 1, parts)


def generate_clean_orders(
    spark: SparkSession,
    n: int | None = None,
    ids: DataFrame | None = None,
    id_col: str = "id",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Typed orders: order_id (id + 1), customer_id, province, amount, status."""
    base = with_hashes(_ids(spark, n, ids, id_col), "id", seed, CLEAN_SLOTS)
    return base.selectExpr(*clean_columns(SPARK))


def generate_dirty_orders(
    spark: SparkSession,
    n: int | None = None,
    ids: DataFrame | None = None,
    id_col: str = "id",
    seed: int = DEFAULT_SEED,
    shuffle: bool = False,
) -> DataFrame:
    """Raw all-text orders with injected faults (blank ids, non-positive
    amounts, mixed-case statuses), six columns like a raw source file."""
    base = with_hashes(_ids(spark, n, ids, id_col), "id", seed, DIRTY_SLOTS)
    out = base.selectExpr(*dirty_columns(SPARK), f"xxhash64({int(seed)}, id) AS _order")
    if shuffle:
        out = out.orderBy("_order")
    return out.drop("_order")


def land_dirty_orders(df: DataFrame, path: str) -> str:
    """Write generated raw orders as header CSV files (one per task) at ``path``."""
    df.write.mode("errorifexists").option("header", "true").options(**CSV_KEEP_BLANKS).csv(path)
    return path


def clean_orders_sql(ids_sql: str, seed: int = DEFAULT_SEED) -> str:
    """DuckDB twin of :func:`generate_clean_orders` over ``ids_sql`` (column ``id``)."""
    return f"SELECT {', '.join(clean_columns(DUCKDB))} FROM ({hashes_sql(ids_sql, 'id', seed, CLEAN_SLOTS)})"


def dirty_orders_sql(ids_sql: str, seed: int = DEFAULT_SEED) -> str:
    """DuckDB twin of :func:`generate_dirty_orders` (unshuffled)."""
    return f"SELECT {', '.join(dirty_columns(DUCKDB))} FROM ({hashes_sql(ids_sql, 'id', seed, DIRTY_SLOTS)})"
