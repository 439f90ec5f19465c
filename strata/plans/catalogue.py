"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the fixture projections of
``orders``), so its work grows with them. Queries that exercise a sink write
to a fresh folder under the session's shared ``spark.checkpoint.dir`` and
return a DataFrame that reads the written data back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.cleaning import normalise_status, parse_amount, parse_date
from strata.operators import summaries
from strata.operators.bronze import bronze
from strata.operators.gold import gold
from strata.operators.quality import (
    STAGES,
    amount_valid,
    order_id_present,
    reject_counts,
    rejects,
    stage_counts,
)
from strata.operators.silver import silver
from strata.plans.pipeline import run_pipeline
from strata.plans.sql import sql_province_totals
from strata.schemas import BUSINESS_COLUMNS, GOLD_SCHEMA, SUCCESS
from strata.session import scratch_path
from strata.sinks.export import export_single_csv
from strata.sinks.layers import LAYERS, publish_layers, write_layer
from strata.sources.files import (
    CSV_KEEP_BLANKS,
    MALFORMED_COLUMN,
    read_inferred_csv,
    read_layer,
    read_malformed,
    read_malformed_lines,
    read_orders_csv,
    read_raw,
    read_snapshot,
)
from strata.sources.fixtures import orders_clean, orders_src, orders_table, project_src
from strata.sources.generate import generate_clean_orders, generate_dirty_orders, land_dirty_orders
from strata.streaming.ingest import ingest_bronze, read_raw_stream
from strata.streaming.medallion import run_incremental

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(orders_src(spark, sf_dir, with_source_file=True))


def _lineage_view(df: DataFrame) -> DataFrame:
    """Business columns + the *table* in the source file's path (a file, or a
    folder of part files) + whether a load time is set (the full path and the
    timestamp differ per run, so they are not compared)."""
    return df.select(
        *BUSINESS_COLUMNS,
        F.regexp_extract("source_file", "(orders[.]parquet)(/|$)", 1).alias("source_file"),
        F.col("load_time").isNotNull().alias("has_load_time"),
    )


# --- sources -----------------------------------------------------------------


def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean orders written as CSV, read back with inferred types."""
    path = scratch_path(spark, "orders-clean-csv")
    orders_clean(spark, sf_dir).write.option("header", "true").csv(path)
    return read_inferred_csv(spark, path)


def csv_raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty orders written as CSV (blanks kept), read back as all-text raw columns."""
    path = scratch_path(spark, "orders-src-csv")
    orders_src(spark, sf_dir).write.option("header", "true").options(**CSV_KEEP_BLANKS).csv(path)
    return read_raw(spark, path, with_source_file=False)


def csv_province_success_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SUCCESS totals over orders read back from CSV with inferred types."""
    return summaries.province_totals(csv_inferred_scan(spark, sf_dir), status=SUCCESS)


# --- part 1: DataFrame and SQL summaries ------------------------------------


def select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-column projection of the order table."""
    return summaries.select_columns(orders_clean(spark, sf_dir), "order_id", "province", "amount", "status")


def filter_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose status is exactly SUCCESS."""
    return summaries.filter_status(orders_clean(spark, sf_dir), SUCCESS)


def orders_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten orders with the lowest ids (a top-k report)."""
    return summaries.preview(orders_clean(spark, sf_dir), 10)


def province_success_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-province count and amount of SUCCESS orders, DataFrame form."""
    return summaries.province_totals(orders_clean(spark, sf_dir), status=SUCCESS)


def sql_province_totals_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-province count and amount of all orders, SQL form."""
    return sql_province_totals(spark, orders_clean(spark, sf_dir))


def sql_province_success_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-province count and amount of SUCCESS orders, SQL form."""
    return sql_province_totals(spark, orders_clean(spark, sf_dir), status=SUCCESS)


# --- Bronze ------------------------------------------------------------------


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze over the dirty source: raw text plus lineage."""
    return _lineage_view(_bronze(spark, sf_dir))


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze written as a Parquet layer and read back (blanks and padding intact)."""
    path = scratch_path(spark, "bronze")
    write_layer(_bronze(spark, sf_dir), path)
    return _lineage_view(read_layer(spark, path))


# --- Silver ------------------------------------------------------------------


def silver_business_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six business columns read back from a Bronze layer (lineage pruned at the scan)."""
    path = scratch_path(spark, "bronze")
    write_layer(_bronze(spark, sf_dir), path)
    return read_layer(spark, path, BUSINESS_COLUMNS)


def silver_rule_order_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left after rule 1 (order_id present)."""
    return _bronze(spark, sf_dir).filter(order_id_present()).select(*BUSINESS_COLUMNS)


def silver_rule_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left after rules 1 and 2, with the parsed amount."""
    return (
        _bronze(spark, sf_dir)
        .filter(order_id_present() & amount_valid())
        .select("order_id", parse_amount("amount").alias("amount"))
    )


def silver_status_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule 3 on every row: upper(trim(status))."""
    return _bronze(spark, sf_dir).select("order_id", normalise_status("status").alias("status"))


def silver_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule 4 on every row: strict yyyy-MM-dd parse, NULL when it fails."""
    return _bronze(spark, sf_dir).select("order_id", parse_date("order_date").alias("order_date"))


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver layer: rules 1-5."""
    return silver(_bronze(spark, sf_dir))


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row Silver drops, with its reject reason."""
    return rejects(_bronze(spark, sf_dir)).select(*BUSINESS_COLUMNS, "reject_reason")


def silver_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(reason, n) over the rejected rows."""
    return reject_counts(_bronze(spark, sf_dir))


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stage, n) for bronze, after_order_id, after_amount, silver, gold — one scan.

    The Gold row count is the number of province groups among Silver rows
    (a NULL province is a group of its own), counted in the same aggregate.
    """
    counts = stage_counts(_bronze(spark, sf_dir), group_key="province")
    return counts.unpivot([], STAGES, "stage", "n")


# --- Gold, pipeline, sinks ---------------------------------------------------


def gold_order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: raw -> Bronze -> Silver -> Gold in one lazy plan."""
    return gold(silver(_bronze(spark, sf_dir)))


def layered_gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after real Parquet writes of all three layers (the pipeline)."""
    result = run_pipeline(
        spark,
        orders_src(spark, sf_dir, with_source_file=True),
        scratch_path(spark, "lakehouse"),
        load_time_at=dt.datetime(2026, 1, 1),
    )
    return read_layer(spark, result.paths["gold"])


def publish_layers_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the pipeline, publish its three layers to a second store, and count
    the rows read back from each published path: (layer, n)."""
    local = run_pipeline(spark, orders_src(spark, sf_dir, with_source_file=True), scratch_path(spark, "lakehouse"))
    target = scratch_path(spark, "published")
    published = publish_layers(
        {layer: read_layer(spark, local.paths[layer]) for layer in LAYERS},
        target,
        tables={"bronze": "orders", "silver": "orders", "gold": "order_summary"},
    )
    parts = [
        read_layer(spark, published[layer]).agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), "n")
        for layer in LAYERS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def publish_layers_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of each layer that the published snapshot names: (layer, row)."""
    local = run_pipeline(spark, orders_src(spark, sf_dir, with_source_file=True), scratch_path(spark, "lakehouse"))
    target = scratch_path(spark, "published")
    tables = {"bronze": "orders", "silver": "orders", "gold": "order_summary"}
    publish_layers({layer: read_layer(spark, local.paths[layer]) for layer in LAYERS}, target, tables=tables)
    found = read_snapshot(spark, target)
    text = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    columns = {layer: GOLD_SCHEMA.fieldNames() if layer == "gold" else BUSINESS_COLUMNS for layer in LAYERS}
    out = None
    for layer, df in found.items():
        # Silver's doubles are printed alike in both engines as whole units and ten-millionths
        cells = {c: [F.col(c)] for c in columns[layer]}
        if layer == "silver":
            amount = F.col("amount")
            cells["amount"] = [F.floor(amount), F.round((amount - F.floor(amount)) * 10_000_000).cast("long")]
        part = df.select(F.lit(layer).alias("layer"), F.concat_ws("|", *[text(c) for cs in cells.values() for c in cs]).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def export_gold_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold exported as one named CSV file, read back with the Gold schema."""
    target = scratch_path(spark, "export") + "/gold/order_summary.csv"
    export_single_csv(gold(silver(_bronze(spark, sf_dir))), target)
    return spark.read.schema(GOLD_SCHEMA).option("header", "true").option("enforceSchema", "false").csv(target)


def rerun_gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over half of the orders as CSV, first with other amounts of the same
    length; then that half is rewritten in place, the other half arrives, and every layer
    is run again on its own, resuming what is still current."""
    landing, base = scratch_path(spark, "landing"), scratch_path(spark, "lakehouse")
    rows = orders_src(spark, sf_dir)
    early = F.substring("customer_id", 6, 1) < "5"

    def write(df: DataFrame, day: int) -> None:
        out = df.write.mode("overwrite").option("header", "true").options(**CSV_KEEP_BLANKS)
        out.csv(f"{landing}/day={day}")

    write(rows.where(early).withColumn("amount", F.translate("amount", "123456789", "912345678")), 1)
    run_pipeline(spark, f"{landing}/*", base)
    write(rows.where(early), 1)
    run_pipeline(spark, f"{landing}/*", base, resume=True)
    write(rows.where(~early), 2)
    run_pipeline(spark, f"{landing}/*", base, resume=True, stop_after="bronze")
    run_pipeline(spark, f"{landing}/*", base, resume=True, stop_after="silver")
    result = run_pipeline(spark, None, base, start_at="gold")
    return read_layer(spark, result.paths["gold"])


def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean orders with ids and amounts above 2^31, written as CSV and read back typed."""
    path = scratch_path(spark, "orders-typed-csv")
    large = orders_clean(spark, sf_dir).withColumns(
        {"order_id": F.col("order_id") + F.lit(4_000_000_000), "amount": F.col("amount").cast("long") * F.lit(100_000)}
    )
    large.write.option("header", "true").csv(path)
    return read_orders_csv(spark, path)


def _land_lines(spark: SparkSession, sf_dir: str) -> str:
    """Orders as raw lines, some with a field too many or too few: one file a task,
    each with the header."""
    path = scratch_path(spark, "orders-lines")
    key = F.col("o_orderkey")
    field = lambda *extra: F.concat_ws(",", key, F.lit("C"), F.lit("P"), F.lit(7), *map(F.lit, extra))
    line = (
        F.when(key % 23 == 5, field("S", "2026-01-01", "extra"))
        .when(key % 29 == 7, field())
        .otherwise(field("S", "2026-01-01"))
    )
    lines = orders_table(spark, sf_dir).select(line.alias("line"))
    # Spark's text writer has no header; the header is the writer's first row of
    # a one-column CSV whose separator does not occur.
    lines.select(F.col("line").alias(",".join(BUSINESS_COLUMNS))).write.option("header", "true").option("sep", "\x01").option(
        "quote", ""
    ).csv(path)
    return path


def bronze_malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines with a field too many or too few, whole."""
    return read_malformed(spark, _land_lines(spark, sf_dir)).select(MALFORMED_COLUMN)


def _all_lines(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Good rows of a Bronze layer as lines again, and its malformed lines."""
    good = read_layer(spark, bronze_path).select(F.concat_ws(",", *BUSINESS_COLUMNS).alias("line"), F.lit(False).alias("malformed"))
    bad = read_malformed_lines(spark, bronze_path).select(F.col(MALFORMED_COLUMN).alias("line"), F.lit(True).alias("malformed"))
    return good.unionByName(bad)


def bronze_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows and malformed lines of one Bronze pass: together every line of the input."""
    result = run_pipeline(spark, _land_lines(spark, sf_dir), scratch_path(spark, "lakehouse"), stop_after="bronze")
    return _all_lines(spark, result.paths["bronze"])


def stream_bronze_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same split by the exactly-once stream, run twice over a landing folder."""
    landing, path = _land_lines(spark, sf_dir), scratch_path(spark, "bronze-stream")
    for _ in range(2):
        ingest_bronze(read_raw_stream(spark, landing), path)
    return _all_lines(spark, path)


# --- streaming ingest --------------------------------------------------------


def _orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # as a pattern the path may be one file or a folder of part files
    return read_raw_stream(
        spark,
        f"{sf_dir.rstrip('/')}/orders.parque[t]",
        schema=orders_table(spark, sf_dir).schema,
        fmt="parquet",
        with_source_file=False,
    )


def _stream_ingested_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest the orders file through a file stream into a fresh Bronze layer."""
    path = scratch_path(spark, "bronze-stream")
    ingest_bronze(_orders_stream(spark, sf_dir), path, transform=lambda df: project_src(df, with_source_file=True))
    return read_layer(spark, path)


def stream_bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage_view(_stream_ingested_bronze(spark, sf_dir))


def stream_gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(silver(_stream_ingested_bronze(spark, sf_dir)))


def incremental_gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold maintained incrementally: Bronze, Silver and Gold as checkpointed streams."""
    paths = run_incremental(
        spark,
        _orders_stream(spark, sf_dir),
        scratch_path(spark, "lakehouse-incremental"),
        transform=lambda df: project_src(df, with_source_file=True),
    )
    return read_layer(spark, paths.gold)


# --- generators --------------------------------------------------------------


def _order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_table(spark, sf_dir).select("o_orderkey")


def generated_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated clean order per driver order key."""
    return generate_clean_orders(spark, ids=_order_keys(spark, sf_dir), id_col="o_orderkey")


def generated_dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated dirty raw order per driver order key."""
    return generate_dirty_orders(spark, ids=_order_keys(spark, sf_dir), id_col="o_orderkey")


def generated_shuffled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generated dirty orders in scattered row order (the rows are the same)."""
    return generate_dirty_orders(spark, ids=_order_keys(spark, sf_dir), id_col="o_orderkey", shuffle=True)


def generated_gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow on generated data: the generator lands raw CSV files,
    then the pipeline loads them into Bronze, Silver and Gold."""
    landing = scratch_path(spark, "landing")
    land_dirty_orders(generate_dirty_orders(spark, ids=_order_keys(spark, sf_dir), id_col="o_orderkey"), landing)
    result = run_pipeline(spark, landing, scratch_path(spark, "lakehouse"), load_time_at=dt.datetime(2026, 1, 1))
    return read_layer(spark, result.paths["gold"])


def queries() -> dict[str, Query]:
    return {
        "csv_inferred_scan": csv_inferred_scan,
        "csv_raw_scan": csv_raw_scan,
        "csv_province_success_totals": csv_province_success_totals,
        "select_columns": select_columns,
        "filter_success": filter_success,
        "orders_preview": orders_preview,
        "province_success_totals": province_success_totals,
        "sql_province_totals": sql_province_totals_all,
        "sql_province_success_totals": sql_province_success_totals,
        "bronze_orders": bronze_orders,
        "bronze_roundtrip": bronze_roundtrip,
        "silver_business_columns": silver_business_columns,
        "silver_rule_order_id": silver_rule_order_id,
        "silver_rule_amount": silver_rule_amount,
        "silver_status_normalised": silver_status_normalised,
        "silver_order_date": silver_order_date,
        "silver_orders": silver_orders,
        "silver_rejects": silver_rejects,
        "silver_reject_reasons": silver_reject_reasons,
        "layer_row_counts": layer_row_counts,
        "gold_order_summary": gold_order_summary,
        "layered_gold_summary": layered_gold_summary,
        "publish_layers": publish_layers_counts,
        "publish_layers_rows": publish_layers_rows,
        "export_single_csv": export_gold_csv,
        "stream_bronze_ingest": stream_bronze_ingest,
        "stream_gold_summary": stream_gold_summary,
        "incremental_gold_summary": incremental_gold_summary,
        "rerun_gold_summary": rerun_gold_summary,
        "csv_typed_scan": csv_typed_scan,
        "bronze_malformed_lines": bronze_malformed_lines,
        "bronze_split_lines": bronze_split_lines,
        "stream_bronze_split_lines": stream_bronze_split_lines,
        "generate_shuffled_orders": generated_shuffled_orders,
        "generate_clean_orders": generated_clean_orders,
        "generate_dirty_orders": generated_dirty_orders,
        "generated_gold_summary": generated_gold_summary,
    }

