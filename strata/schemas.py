"""Schemas and column lists shared by every layer.

The layer contract is fixed: 8 Bronze columns -> 6 Silver columns -> 5 Gold
columns, no extras. Tests assert these as schemas.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Business columns of an order, in order (Silver keeps exactly these).
BUSINESS_COLUMNS: list[str] = [
    "order_id",
    "customer_id",
    "province",
    "amount",
    "status",
    "order_date",
]

# Lineage columns Bronze appends to the raw columns.
LINEAGE_COLUMNS: list[str] = ["source_file", "load_time"]

BRONZE_COLUMNS: list[str] = BUSINESS_COLUMNS + LINEAGE_COLUMNS

# The Gold columns.
GOLD_COLUMNS: list[str] = [
    "province",
    "total_orders",
    "total_amount",
    "success_orders",
    "failed_orders",
]

# Part-1 order table: five columns, no order_date.
ORDER_COLUMNS: list[str] = BUSINESS_COLUMNS[:5]

# Raw source as it arrives: every field is text, so nothing is lost or
# rejected at read time (quality rules decide later, in Silver).
RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in BUSINESS_COLUMNS])

BRONZE_SCHEMA = StructType(
    list(RAW_SCHEMA.fields)
    + [
        StructField("source_file", StringType(), True),
        StructField("load_time", TimestampType(), True),
    ]
)

SILVER_SCHEMA = StructType(
    [
        StructField("order_id", StringType(), True),
        StructField("customer_id", StringType(), True),
        StructField("province", StringType(), True),
        StructField("amount", DoubleType(), True),
        StructField("status", StringType(), True),
        StructField("order_date", DateType(), True),
    ]
)

GOLD_SCHEMA = StructType(
    [
        StructField("province", StringType(), True),
        StructField("total_orders", LongType(), False),
        StructField("total_amount", LongType(), True),
        StructField("success_orders", LongType(), True),
        StructField("failed_orders", LongType(), True),
    ]
)

# The typed Part-1 order table (order_id non-null, the rest nullable;
# ids and amounts pass 2^31 at scale).
ORDER_SCHEMA = StructType(
    [
        StructField("order_id", LongType(), False),
        StructField("customer_id", StringType(), True),
        StructField("province", StringType(), True),
        StructField("amount", LongType(), True),
        StructField("status", StringType(), True),
    ]
)

SUMMARY_COLUMNS: list[str] = ["province", "total_orders", "total_amount"]

# Status values the Gold layer counts separately.
SUCCESS = "SUCCESS"
FAILED = "FAILED"

# Date format of order_date in the raw source.
ORDER_DATE_FORMAT = "yyyy-MM-dd"


LAYER_SCHEMAS: dict[str, StructType] = {"bronze": BRONZE_SCHEMA, "silver": SILVER_SCHEMA, "gold": GOLD_SCHEMA}


def check_layer_schema(schema: StructType, layer: str, ordered: bool = True) -> None:
    """Raise unless ``schema`` has exactly the layer's column names and types
    (in order, unless ``ordered`` is false: a partitioned table reads back
    with its partition columns last)."""
    expected = [(f.name, f.dataType) for f in LAYER_SCHEMAS[layer].fields]
    actual = [(f.name, f.dataType) for f in schema.fields]
    if not ordered:
        expected, actual = sorted(expected, key=str), sorted(actual, key=str)
    if actual != expected:
        raise ValueError(f"{layer} layer schema mismatch: expected {expected}, found {actual}")
