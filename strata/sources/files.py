"""File scans: raw text ingest, typed CSV, inferred CSV, and layer read-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.lineage import source_file
from strata.schemas import ORDER_SCHEMA, RAW_SCHEMA
from strata.sinks.layers import Build, current_build, snapshot_builds

# CSV options that keep text exactly as written: no blank stripping on either
# side, so padding survives a round trip.
CSV_KEEP_BLANKS: dict[str, str] = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = RAW_SCHEMA,
    fmt: str = "csv",
    with_source_file: bool = True,
    options: dict[str, str] | None = None,
    whole_lines: bool = False,
) -> DataFrame:
    """Raw ingest: every column as text, plus ``source_file`` taken at the scan.

    CSV is read with ``header`` and ``enforceSchema=false``: the header of
    every file is checked against the schema by name, so a file whose columns
    are swapped fails instead of being mapped by position in silence. The
    schema is explicit, so there is no inference pass over the input.
    ``path`` may be a file, a directory, a glob or a list of them. A CSV line
    with more or fewer fields than the schema is cut or padded, unless
    ``whole_lines`` leaves it to :func:`read_malformed`.
    """
    if whole_lines:
        if fmt != "csv":
            raise ValueError("whole_lines is for CSV input")
        lines = read_lines(spark, path, schema).where(F.col(MALFORMED_COLUMN).isNull())
        return lines.select(*schema.fieldNames(), *(["source_file"] if with_source_file else []))
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false").options(**CSV_KEEP_BLANKS)
    reader = reader.options(**(options or {}))
    df = reader.format(fmt).load(path)
    cols = list(schema.fieldNames())
    if with_source_file:
        return df.select(*cols, source_file().alias("source_file"))
    return df.select(*cols)


MALFORMED_COLUMN = "malformed_line"
# Partition column of a Bronze layer that holds both good rows and malformed lines.
MALFORMED_FLAG = "malformed"
# CSV options under which a line with a wrong number of fields is noticed and kept.
CSV_WHOLE_LINES: dict[str, str] = {
    "header": "true",
    "enforceSchema": "false",
    # pruned columns would hide a wrong number of fields
    "columnPruning": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED_COLUMN,
    **CSV_KEEP_BLANKS,
}


def lines_schema(schema: StructType) -> StructType:
    """``schema`` and the column that takes lines with a wrong number of fields."""
    return StructType([*schema.fields, StructField(MALFORMED_COLUMN, StringType(), True)])


def read_lines(spark: SparkSession, path: str | list[str], schema: StructType = RAW_SCHEMA) -> DataFrame:
    """One scan of raw CSV, every line a row: the fields, ``malformed_line`` (the whole
    line where it has more or fewer fields than the schema, else NULL) and ``source_file``."""
    lines = spark.read.schema(lines_schema(schema)).options(**CSV_WHOLE_LINES).csv(path)
    return lines.select(*schema.fieldNames(), MALFORMED_COLUMN, source_file().alias("source_file"))


def read_malformed(spark: SparkSession, path: str | list[str], schema: StructType = RAW_SCHEMA) -> DataFrame:
    """Lines of raw CSV with more or fewer fields than the schema, whole:
    ``malformed_line`` and ``source_file``. ``read_raw(..., whole_lines=True)``
    leaves exactly these out, so the two together are the input."""
    lines = read_lines(spark, path, schema)
    # Spark refuses a query of the line column alone; naming another column (never
    # taken, the line is not NULL here) keeps all fields parsed
    line = F.coalesce(F.col(MALFORMED_COLUMN), F.col(schema.fieldNames()[0]).cast("string"))
    return lines.where(F.col(MALFORMED_COLUMN).isNotNull()).select(line.alias(MALFORMED_COLUMN), "source_file")


def read_orders_csv(spark: SparkSession, path: str | list[str], schema: StructType = ORDER_SCHEMA) -> DataFrame:
    """Typed CSV scan with an explicit schema (the production form: one pass).
    A field that does not parse as its type fails the read; it never becomes NULL."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("columnPruning", "false")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_inferred_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV scan with ``inferSchema``: an extra eager pass over the whole input to
    guess types. Kept for parity with hand-written scripts; prefer an explicit
    schema (:func:`read_orders_csv`)."""
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


def read_layer(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Read a Parquet layer back (its current build, or a plain table at the
    path); a column list prunes the scan (``ReadSchema``).

    A known ``schema`` (given, or recorded with the build) skips the footer-reading job
    that schema inference runs. Of a Bronze layer these are the good rows;
    :func:`read_malformed_lines` reads the others.
    """
    build = current_build(spark, path)
    df = _read_build(spark, build.path, schema or _schema(build)) if build else _read_build(spark, path, schema)
    return df.select(*columns) if columns else df


def read_snapshot(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The layers that the base's snapshot names: builds of one run, by layer."""
    builds = snapshot_builds(spark, base)
    if not builds:
        raise ValueError(f"there is no snapshot at {base}")
    return {layer: _read_build(spark, b.path, _schema(b)) for layer, b in builds.items()}


def read_malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the raw files of a Bronze layer that had a wrong number of fields, whole:
    ``malformed_line``, ``source_file`` and ``load_time``. Reads their partition only."""
    build = current_build(spark, path)
    schema = "malformed_line string, source_file string, load_time timestamp"
    df = spark.read.schema(schema).parquet(build.path if build else path)
    flagged = df.where(is_malformed()) if MALFORMED_FLAG in df.columns else df.where(F.lit(False))
    return flagged.select(MALFORMED_COLUMN, "source_file", "load_time")


def is_malformed() -> Column:
    """The flag of a Bronze layer's partitions, whose folder names are text."""
    return F.col(MALFORMED_FLAG).cast("boolean")


def _schema(build: Build) -> StructType | None:
    return StructType.fromJson(build.schema) if build.schema else None


def _read_build(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if MALFORMED_FLAG in df.columns:
        df = df.where(~is_malformed()).drop(MALFORMED_FLAG, MALFORMED_COLUMN)
    return df
