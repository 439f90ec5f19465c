"""Column expressions: every one is a built-in Spark expression (JVM side,
whole-stage codegen), never a Python UDF."""

from strata.functions.cleaning import (
    is_blank,
    is_finite,
    normalise_status,
    parse_amount,
    parse_date,
)
from strata.functions.lineage import file_name_of, load_time, source_file

__all__ = [
    "file_name_of",
    "is_blank",
    "is_finite",
    "load_time",
    "normalise_status",
    "parse_amount",
    "parse_date",
    "source_file",
]
