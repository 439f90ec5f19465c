"""Incremental Bronze ingest with Structured Streaming.

Bronze's job is to load every raw file exactly once, so the source never
has to be read again. A file-source stream with an ``availableNow`` trigger
does that as a restartable batch: each run picks up only files not seen
before (tracked in the checkpoint), writes them through the file sink's
commit log, and stops. A failed or killed run resumes from its checkpoint
without duplicating rows; readers of the Bronze path see only committed files.
The same code runs continuously with a processing-time trigger.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.functions.lineage import source_file
from strata.operators.bronze import bronze, bronze_lines
from strata.schemas import RAW_SCHEMA
from strata.sources.files import CSV_WHOLE_LINES, MALFORMED_COLUMN, MALFORMED_FLAG, lines_schema


def read_raw_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW_SCHEMA,
    fmt: str = "csv",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    with_source_file: bool = True,
    archive_dir: str | None = None,
) -> DataFrame:
    """Streaming counterpart of :func:`strata.sources.files.read_lines` (CSV; lines with
    a wrong number of fields are whole in ``malformed_line``) and ``read_raw`` (others).

    ``archive_dir`` moves processed files out of the landing folder (Spark's
    ``cleanSource=archive``), so the folder listed at every trigger stays
    small however many files have arrived over time. A batch's files move
    when a later batch commits, i.e. during the next run that finds new
    files; the archive must lie outside the landing path.
    """
    csv = fmt == "csv"
    reader = spark.readStream.schema(lines_schema(schema) if csv else schema).format(fmt)
    if csv:
        reader = reader.options(**CSV_WHOLE_LINES)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = reader.load(path)
    if not with_source_file:
        return df
    line = [MALFORMED_COLUMN] if csv else []
    return df.select(*schema.fieldNames(), *line, source_file().alias("source_file"))


def checkpoint_for(bronze_path: str) -> str:
    """Default checkpoint: a sibling of the Bronze path (never inside it)."""
    return bronze_path.rstrip("/") + "__checkpoint"


def ingest_bronze(
    raw_stream: DataFrame,
    bronze_path: str,
    checkpoint: str | None = None,
    load_time_at: dt.datetime | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Append new raw rows to the Bronze Parquet layer at ``bronze_path``.

    Without ``processing_time`` the query processes everything available
    now and returns once finished; with it, the query keeps running.
    ``transform`` maps a differently shaped source onto the raw columns first.
    Malformed lines of CSV go to a partition of their own, through the same commit
    log, so they too are there exactly once.
    """
    raw = transform(raw_stream) if transform else raw_stream
    lines = MALFORMED_COLUMN in raw.columns
    rows = (bronze_lines if lines else bronze)(raw, load_time_at).writeStream
    writer = (
        (rows.partitionBy(MALFORMED_FLAG) if lines else rows)
        .format("parquet")
        .outputMode("append")
        .option("path", bronze_path)
        .option("checkpointLocation", checkpoint or checkpoint_for(bronze_path))
    )
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
