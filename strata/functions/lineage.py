"""Lineage columns for Bronze.

``source_file`` must be taken at the scan: ``_metadata.file_path`` resolves
only directly on a file scan (after select/filter), not past an aggregate,
a subquery or ``createDataFrame``. Once selected it is an ordinary column and
survives shuffles, unlike ``input_file_name()`` which becomes ``''``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def source_file() -> Column:
    """Full URI of the file a row was read from (use on a file scan only)."""
    return F.col("_metadata.file_path")


def file_name_of(path: str | Column) -> Column:
    """Last path segment of a URI column (``file:/a/b/orders.csv`` -> ``orders.csv``)."""
    path = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(path, "/"), -1)


def load_time(at: dt.datetime | None = None) -> Column:
    """Load timestamp: one value per query, or an injected literal for replay/tests."""
    if at is None:
        return F.current_timestamp()
    return F.lit(at).cast("timestamp")
