"""DuckDB SQL that computes, independently of Spark, what each registered
query must return. Used by the correctness gate (``oracle_sql()``) and tests.

Dialect notes: DuckDB ``sum`` over integers is HUGEINT (cast to BIGINT);
``CAST(2.9 AS BIGINT)`` rounds in DuckDB but truncates in Spark (use
``trunc``); ``try_strptime`` accepts single-digit months, so the fixtures keep
such dates out.
"""

from __future__ import annotations

from strata.sources.fixtures import clean_sql, src_sql
from strata.sources.generate import clean_orders_sql, dirty_orders_sql

SRC = f"({src_sql()})"
CLEAN = f"({clean_sql()})"

# Silver in DuckDB: the same rules, written independently.

def gold_sql(silver_sql: str) -> str:
    return f"""
SELECT province,
       CAST(count(order_id) AS BIGINT) AS total_orders,
       -- whole parts as integers: a double sum is exact only up to 2^53
       CAST(sum(CAST(floor(amount) AS HUGEINT)) + CAST(floor(sum(amount - floor(amount))) AS HUGEINT) AS BIGINT) AS total_amount,
       CAST(count(*) FILTER (WHERE status = 'SUCCESS') AS BIGINT) AS success_orders,
       CAST(count(*) FILTER (WHERE status = 'FAILED') AS BIGINT) AS failed_orders
FROM {silver_sql} v
GROUP BY province
ORDER BY total_amount DESC NULLS LAST, province
"""


def silver_sql(src: str) -> str:
    return f"""(
SELECT order_id, customer_id, province, TRY_CAST(amount AS DOUBLE) AS amount,
       upper(trim(status)) AS status,
       CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date
FROM {src} s
WHERE order_id IS NOT NULL AND trim(order_id) <> ''
  AND TRY_CAST(amount AS DOUBLE) > 0 AND TRY_CAST(amount AS DOUBLE) < 9223372036854775808::DOUBLE
  AND NOT isnan(TRY_CAST(amount AS DOUBLE)) AND NOT isinf(TRY_CAST(amount AS DOUBLE))
)"""


SILVER = silver_sql(SRC)
GOLD = gold_sql(SILVER)
# Of the orders, every 23rd line has a field too many and every 29th one too few.
MALFORMED = """
SELECT CASE WHEN o_orderkey % 23 = 5 THEN concat_ws(',', o_orderkey, 'C', 'P', 7, 'S', '2026-01-01', 'extra')
            WHEN o_orderkey % 29 = 7 THEN concat_ws(',', o_orderkey, 'C', 'P', 7) END AS malformed_line
FROM orders
"""
SPLIT_LINES = f"""
SELECT coalesce(malformed_line, concat_ws(',', o_orderkey, 'C', 'P', 7, 'S', '2026-01-01')) AS line,
       malformed_line IS NOT NULL AS malformed
FROM ({MALFORMED.replace("AS malformed_line", "AS malformed_line, o_orderkey")}) m
"""
ORDER_KEYS = "SELECT o_orderkey AS id FROM orders"


PROVINCE_TOTALS = """
SELECT province,
       CAST(count(*) AS BIGINT) AS total_orders,
       CAST(sum(amount) AS BIGINT) AS total_amount
FROM {CLEAN} c
{where}
GROUP BY province
"""

BRONZE_VIEW = f"""
SELECT order_id, customer_id, province, amount, status, order_date,
       'orders.parquet' AS source_file, true AS has_load_time
FROM {SRC} s
"""

LAYER_ROW_COUNTS = f"""
WITH b AS (
  SELECT *,
         (order_id IS NOT NULL AND trim(order_id) <> '') AS id_ok,
         (order_id IS NOT NULL AND trim(order_id) <> ''
          AND coalesce(TRY_CAST(amount AS DOUBLE) > 0 AND TRY_CAST(amount AS DOUBLE) < 9223372036854775808::DOUBLE
                       AND NOT isnan(TRY_CAST(amount AS DOUBLE))
                       AND NOT isinf(TRY_CAST(amount AS DOUBLE)), false)) AS all_ok
  FROM {SRC} s
)
SELECT 'bronze' AS stage, CAST(count(*) AS BIGINT) AS n FROM b
UNION ALL SELECT 'after_order_id', CAST(count(*) FILTER (WHERE id_ok) AS BIGINT) FROM b
UNION ALL SELECT 'after_amount', CAST(count(*) FILTER (WHERE all_ok) AS BIGINT) FROM b
UNION ALL SELECT 'silver', CAST(count(*) AS BIGINT) FROM {SILVER} v
UNION ALL SELECT 'gold', CAST(count(*) AS BIGINT) FROM (SELECT province FROM {SILVER} v GROUP BY province) g
"""

REJECTS = f"""
SELECT order_id, customer_id, province, amount, status, order_date,
       CASE WHEN order_id IS NULL OR trim(order_id) = '' THEN 'missing_order_id'
            WHEN TRY_CAST(amount AS DOUBLE) IS NULL OR isnan(TRY_CAST(amount AS DOUBLE))
                 OR isinf(TRY_CAST(amount AS DOUBLE)) THEN 'amount_not_numeric'
            WHEN TRY_CAST(amount AS DOUBLE) <= 0 THEN 'amount_not_positive'
            WHEN TRY_CAST(amount AS DOUBLE) >= 9223372036854775808::DOUBLE THEN 'amount_out_of_range'
       END AS reject_reason
FROM {SRC} s
"""


def oracle_sql() -> dict[str, str]:
    return {
        # inference types the id column INTEGER while every value fits
        "csv_inferred_scan": f"""
            SELECT CAST(order_id AS INTEGER) AS order_id, customer_id, province, amount, status
            FROM {CLEAN} c""",
        "csv_raw_scan": f"""
            SELECT nullif(order_id, '') AS order_id, nullif(customer_id, '') AS customer_id,
                   nullif(province, '') AS province, nullif(amount, '') AS amount,
                   nullif(status, '') AS status, nullif(order_date, '') AS order_date
            FROM {SRC} s""",
        "csv_province_success_totals": PROVINCE_TOTALS.format(CLEAN=CLEAN, where="WHERE status = 'SUCCESS'"),
        "select_columns": f"SELECT order_id, province, amount, status FROM {CLEAN} c",
        "filter_success": f"SELECT * FROM {CLEAN} c WHERE status = 'SUCCESS'",
        "orders_preview": f"SELECT * FROM {CLEAN} c ORDER BY order_id LIMIT 10",
        "province_success_totals": PROVINCE_TOTALS.format(CLEAN=CLEAN, where="WHERE status = 'SUCCESS'"),
        "sql_province_totals": PROVINCE_TOTALS.format(CLEAN=CLEAN, where=""),
        "sql_province_success_totals": PROVINCE_TOTALS.format(CLEAN=CLEAN, where="WHERE status = 'SUCCESS'"),
        "bronze_orders": BRONZE_VIEW,
        "bronze_roundtrip": BRONZE_VIEW,
        "silver_business_columns": f"SELECT * FROM {SRC} s",
        "silver_rule_order_id": f"SELECT * FROM {SRC} s WHERE order_id IS NOT NULL AND trim(order_id) <> ''",
        "silver_rule_amount": f"SELECT order_id, amount FROM {SILVER} v",
        "silver_status_normalised": f"SELECT order_id, upper(trim(status)) AS status FROM {SRC} s",
        "silver_order_date": f"""
            SELECT order_id, CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date
            FROM {SRC} s""",
        "silver_orders": f"SELECT * FROM {SILVER} v",
        "silver_rejects": f"SELECT * FROM ({REJECTS}) r WHERE reject_reason IS NOT NULL",
        "silver_reject_reasons": f"""
            SELECT reject_reason AS reason, CAST(count(*) AS BIGINT) AS n
            FROM ({REJECTS}) r WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
        "layer_row_counts": LAYER_ROW_COUNTS,
        "gold_order_summary": GOLD,
        "layered_gold_summary": GOLD,
        "publish_layers": f"""
            SELECT 'bronze' AS layer, CAST(count(*) AS BIGINT) AS n FROM {SRC} s
            UNION ALL SELECT 'silver', CAST(count(*) AS BIGINT) FROM {SILVER} v
            UNION ALL SELECT 'gold', CAST(count(*) AS BIGINT) FROM ({GOLD}) g""",
        "publish_layers_rows": f"""
            SELECT 'bronze' AS layer, concat_ws('|', coalesce(order_id, '-'), coalesce(customer_id, '-'),
              coalesce(province, '-'), coalesce(amount, '-'), coalesce(status, '-'), coalesce(order_date, '-')) AS row
            FROM {SRC} s
            UNION ALL SELECT 'silver', concat_ws('|', order_id, customer_id, province, CAST(floor(amount) AS BIGINT),
              CAST(round((amount - floor(amount)) * 10000000) AS BIGINT), status, coalesce(CAST(order_date AS VARCHAR), '-'))
            FROM {SILVER} v
            UNION ALL SELECT 'gold', concat_ws('|', province, total_orders, total_amount, success_orders, failed_orders)
            FROM ({GOLD}) g""",
        "export_single_csv": GOLD,
        "stream_bronze_ingest": BRONZE_VIEW,
        "stream_gold_summary": GOLD,
        "incremental_gold_summary": GOLD,
        "rerun_gold_summary": GOLD,
        "csv_typed_scan": f"""
            SELECT order_id + 4000000000 AS order_id, customer_id, province,
                   CAST(amount AS BIGINT) * 100000 AS amount, status
            FROM {CLEAN} c""",
        "bronze_malformed_lines": f"""
            SELECT malformed_line FROM ({MALFORMED}) m WHERE malformed_line IS NOT NULL""",
        "bronze_split_lines": SPLIT_LINES,
        "stream_bronze_split_lines": SPLIT_LINES,
        "generate_shuffled_orders": dirty_orders_sql(ORDER_KEYS),
        "generate_clean_orders": clean_orders_sql(ORDER_KEYS),
        "generate_dirty_orders": dirty_orders_sql(ORDER_KEYS),
        "generated_gold_summary": gold_sql(silver_sql(f"({dirty_orders_sql(ORDER_KEYS)})")),
    }
