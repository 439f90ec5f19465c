"""Bronze: raw rows unchanged plus two lineage columns.

No filter, no cast, no trim: every raw field stays text exactly as read, so a
later rule change can be replayed from Bronze without going back to the source.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.lineage import load_time
from strata.schemas import BUSINESS_COLUMNS
from strata.sources.files import MALFORMED_COLUMN, MALFORMED_FLAG


def bronze(
    raw: DataFrame,
    load_time_at: dt.datetime | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Append ``source_file`` and ``load_time`` to the raw columns.

    ``raw`` should carry ``source_file`` already, attached at the file scan
    (see :func:`strata.sources.files.read_raw`); a frame without it (e.g. a
    literal table) gets NULL, since there is no file to name.
    """
    columns = columns or BUSINESS_COLUMNS
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"raw input lacks columns {missing}; has {raw.columns}")
    src = F.col("source_file") if "source_file" in raw.columns else F.lit(None).cast("string")
    return raw.select(
        *columns,
        src.alias("source_file"),
        load_time(load_time_at).alias("load_time"),
    )


def bronze_lines(lines: DataFrame, load_time_at: dt.datetime | None = None) -> DataFrame:
    """Bronze of every line of a scan that carries ``malformed_line``: the rows as
    :func:`bronze` gives them, with that line and a flag that tells the two kinds apart.
    Written partitioned by the flag, good rows and malformed lines take one pass."""
    flagged = lines.withColumn(MALFORMED_FLAG, F.col(MALFORMED_COLUMN).isNotNull())
    good = [F.when(~F.col(MALFORMED_FLAG), F.col(c)).alias(c) for c in BUSINESS_COLUMNS]  # no half-parsed fields
    return flagged.select(
        *good, "source_file", load_time(load_time_at).alias("load_time"), MALFORMED_COLUMN, MALFORMED_FLAG
    )
