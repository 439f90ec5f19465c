"""Incremental Silver and Gold: each run processes only what is new.

Recomputing Silver and Gold from the whole Bronze layer on every run costs a
full scan of it each time. Here each step is a Structured Streaming query
with an ``availableNow`` trigger, checkpointed in the shared folder:

* Bronze -> Silver is stateless: new Bronze files (read through the file
  sink's commit log, so only committed files) are filtered and typed, and
  appended to the Silver layer.
* Silver -> Gold is a streaming aggregation whose state holds the parts of the
  summary: one row per province and bin of its amounts, however many orders arrive. After each micro-batch the complete
  Gold table is written as a new build and becomes the current one
  (``foreachBatch``; a replay of the same batch writes the same rows).

A killed run resumes from its checkpoints; re-running with nothing new
changes nothing. State size grows with the number of Gold keys, so a
high-cardinality key belongs in the batch pipeline instead.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from strata.operators.gold import order_gold, summary_of_parts, summary_parts
from strata.operators.quality import (
    REASONS,
    reason_metrics,
    with_reject_reason,
)
from strata.operators.silver import silver
from strata.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from strata.plans.pipeline import stage_counts_of
from strata.sinks.layers import current_build, layer_path, write_layer
from strata.sources.files import MALFORMED_FLAG, is_malformed, read_malformed_lines
from strata.streaming.ingest import checkpoint_for, ingest_bronze, read_raw_stream


SILVER_METRICS = "silver_rule_counts"


def refine_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
) -> tuple[StreamingQuery, dict[str, int]]:
    """Append Silver rows for Bronze files not processed before.

    Returns the finished query and its row counts (all rows, and by reject
    reason). They are added up batch by batch as the batches end, however many
    there are; the query's own progress list keeps only the last ones.
    """
    totals = {"bronze": 0, **{r: 0 for r in REASONS}}
    done = threading.Event()

    class Counter(StreamingQueryListener):
        """Adds up the counts that each batch of this run observed."""

        def onQueryStarted(self, event) -> None:
            pass

        def onQueryIdle(self, event) -> None:
            pass

        def onQueryProgress(self, event) -> None:
            row = event.progress.observedMetrics.get(name)
            if row is not None and event.progress.numInputRows > 0:
                for k in totals:
                    totals[k] += int(row[k])

        def onQueryTerminated(self, event) -> None:
            if str(event.id) in started:
                done.set()

    name, started = f"{SILVER_METRICS}_{uuid.uuid4().hex}", []
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.parquet(bronze_path)
    if MALFORMED_FLAG in rows.columns:
        rows = rows.where(~is_malformed()).drop(MALFORMED_FLAG)
    stream = with_reject_reason(rows)
    counter = Counter()
    spark.streams.addListener(counter)
    try:
        query = (
            silver(stream.observe(name, *reason_metrics()))
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", silver_path)
            .option("checkpointLocation", checkpoint or checkpoint_for(silver_path))
            .trigger(availableNow=True)
            .start()
        )
        started.append(str(query.id))
        query.awaitTermination()
        if not done.wait(60):  # events arrive in order: after this one, none of the run is missing
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(counter)
    return query, totals


def maintain_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    checkpoint: str | None = None,
    state_partitions: int = 8,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Fold new Silver rows into the per-province state; rewrite Gold.

    A stateful aggregation keeps one state store per shuffle partition, and
    that number is fixed in the checkpoint at the first start. Gold has a
    handful of keys, so it gets ``state_partitions`` stores, not the cluster's
    shuffle-partition count (thousands of stores committing every batch).
    New rows are still aggregated map-side first, so a hot key is no
    bottleneck. The number suits Gold's few keys only; a summary by a
    large key belongs in the batch pipeline.
    """
    # a session of its own: the query takes a copy of the settings when it starts
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    reader = own.readStream.schema(SILVER_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(silver_path)

    def publish(batch: DataFrame, batch_id: int) -> None:
        write_layer(order_gold(summary_of_parts(batch)), gold_path, built_from=f"batch-{batch_id}")

    writer = (
        summary_parts(stream)
        .writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint or checkpoint_for(gold_path))
        .trigger(availableNow=True)
    )
    query = writer.start()
    query.awaitTermination()
    return query


@dataclass
class IncrementalPaths:
    bronze: str
    silver: str
    gold: str
    # Rows this run moved from Bronze to Silver, per stage and per reason.
    counts: dict[str, int] | None = None
    rejects: dict[str, int] | None = None
    # Lines with a wrong number of fields that Bronze holds whole, of all runs.
    malformed: int = 0


def run_incremental(
    spark: SparkSession,
    raw_stream: DataFrame | str,
    base: str,
    table: str = "orders",
    gold_table: str = "order_summary",
    load_time_at: dt.datetime | None = None,
    transform=None,
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
) -> IncrementalPaths:
    """Landing -> Bronze -> Silver -> Gold, each step incremental.

    ``raw_stream`` is a streaming raw DataFrame or a landing folder of raw
    CSV files (``archive_dir`` then moves processed files out of it). Safe to
    call repeatedly: every call picks up where the last one stopped.
    ``max_files_per_trigger`` bounds the files of a micro-batch in every step
    (for a landing folder also in the first), so that a backfill runs as many
    batches. A base whose Bronze or Silver the batch pipeline wrote is refused.
    """
    paths = IncrementalPaths(
        bronze=layer_path(base, "bronze", table),
        silver=layer_path(base, "silver", table),
        gold=layer_path(base, "gold", gold_table),
    )
    for path in (paths.bronze, paths.silver):
        if current_build(spark, path) is not None:
            raise ValueError(f"{path} is a layer of the batch pipeline; use another base for incremental layers")
    if isinstance(raw_stream, str):
        raw = read_raw_stream(spark, raw_stream, archive_dir=archive_dir, max_files_per_trigger=max_files_per_trigger)
    else:
        raw = raw_stream
    ingest_bronze(raw, paths.bronze, load_time_at=load_time_at, transform=transform)
    paths.malformed = read_malformed_lines(spark, paths.bronze).count()
    _, totals = refine_silver(spark, paths.bronze, paths.silver, max_files_per_trigger=max_files_per_trigger)
    paths.rejects = {r: totals[r] for r in REASONS}
    paths.counts = stage_counts_of(totals["bronze"], paths.rejects)
    maintain_gold(spark, paths.silver, paths.gold, max_files_per_trigger=max_files_per_trigger)
    return paths
