"""Order tables derived from the driver's TPC-H-style ``orders`` table.

``orders_src`` is an all-text, deliberately dirty order source (blank and
NULL ids, non-positive and malformed amounts, mixed-case padded statuses,
impossible dates); ``orders_clean`` is the typed five-column order table. Both
are plain projections of ``orders`` (no shuffle), so they scale with it. The
column definitions are SQL expressions that give equal rows in Spark and
DuckDB; the DuckDB oracle uses the same text with its own string type name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.functions.lineage import source_file

# Status by order key, shared by both projections.
_STATUS = (
    "CASE WHEN o_orderkey % 20 < 11 THEN 'SUCCESS' WHEN o_orderkey % 20 < 15 THEN 'PENDING' "
    "WHEN o_orderkey % 20 < 17 THEN 'CANCELLED' ELSE 'FAILED' END"
)
_CUSTOMER = "concat('CUS', lpad(CAST(o_custkey % 50 + 1 AS {S}), 3, '0'))"
_PROVINCE = (
    "CASE o_custkey % 5 WHEN 0 THEN 'Hanoi' WHEN 1 THEN 'HCM' WHEN 2 THEN 'DaNang' "
    "WHEN 3 THEN 'HaiPhong' ELSE 'CanTho' END"
)

# The dirty source projection (all text).
SRC_COLUMNS: dict[str, str] = {
    "order_id": (
        "CASE o_orderkey % 51 WHEN 3 THEN '' WHEN 20 THEN NULL WHEN 37 THEN '   ' "
        "ELSE CAST(o_orderkey AS {S}) END"
    ),
    "customer_id": _CUSTOMER,
    "province": _PROVINCE,
    "amount": (
        "CASE WHEN o_orderkey % 17 = 8 THEN CASE o_orderkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '-1' "
        "ELSE '-50000' END WHEN o_orderkey % 101 = 50 THEN 'abc' WHEN o_orderkey % 211 = 9 THEN NULL "
        "WHEN o_orderkey % 997 = 5 THEN '1e33' WHEN o_orderkey % 4001 = 13 THEN '1e16' "
        "WHEN o_orderkey % 499 = 17 THEN '0.9999999' WHEN o_orderkey % 1009 = 4 THEN '0.0000004' "
        "ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS {S}) END"
    ),
    "status": (
        "CASE o_orderkey % 3 WHEN 0 THEN st WHEN 1 THEN lower(st) "
        "ELSE concat(' ', concat(substr(st, 1, 1), lower(substr(st, 2))), ' ') END"
    ),
    "order_date": (
        "CASE WHEN o_orderkey % 103 = 7 THEN '2026-13-01' "
        "ELSE CAST(CAST(o_orderdate AS DATE) AS {S}) END"
    ),
}

# The typed clean projection.
CLEAN_COLUMNS: dict[str, str] = {
    "order_id": "CAST(o_orderkey AS BIGINT)",  # BIGINT: order keys pass 2^31 at scale
    "customer_id": _CUSTOMER,
    "province": _PROVINCE,
    "amount": "CAST(floor(o_totalprice) AS INT)",
    "status": "st",
}


def _exprs(columns: dict[str, str], string_type: str) -> list[str]:
    return [f"{expr.format(S=string_type)} AS {name}" for name, expr in columns.items()]


def src_sql(table: str = "orders", string_type: str = "VARCHAR") -> str:
    """The dirty projection as a SQL query (DuckDB dialect by default)."""
    cols = ", ".join(_exprs(SRC_COLUMNS, string_type))
    return f"SELECT {cols} FROM (SELECT *, {_STATUS} AS st FROM {table})"


def clean_sql(table: str = "orders", string_type: str = "VARCHAR") -> str:
    cols = ", ".join(_exprs(CLEAN_COLUMNS, string_type))
    return f"SELECT {cols} FROM (SELECT *, {_STATUS} AS st FROM {table})"


def orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")


def project_src(orders: DataFrame, with_source_file: bool = False) -> DataFrame:
    """The dirty projection of an ``orders`` scan (batch or streaming)."""
    return _project(orders, SRC_COLUMNS, with_source_file)


def _project(orders: DataFrame, columns: dict[str, str], with_source_file: bool) -> DataFrame:
    needed = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    base = orders.select(*needed, *([source_file().alias("source_file")] if with_source_file else []))
    out = base.selectExpr("*", f"{_STATUS} AS st").selectExpr(
        *_exprs(columns, "STRING"), *(["source_file"] if with_source_file else [])
    )
    return out


def orders_src(spark: SparkSession, sf_dir: str, with_source_file: bool = False) -> DataFrame:
    """Dirty all-text order source; ``source_file`` is attached at the scan."""
    return _project(orders_table(spark, sf_dir), SRC_COLUMNS, with_source_file)


def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed five-column order table."""
    return _project(orders_table(spark, sf_dir), CLEAN_COLUMNS, False)
