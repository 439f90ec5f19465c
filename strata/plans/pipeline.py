"""The medallion pipeline: source -> Bronze -> Silver -> Gold, one session.

Each layer is written as Parquet before the next one reads it, so every layer
is a restart point and a lost executor costs at most the tasks of the stage
it was running. Stage counts are collected with ``observe()`` while a layer is
written — no extra scan per count. A failing layer raises, later layers do not
run, and the layers before keep their last complete build.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.bronze import bronze, bronze_lines
from strata.operators.gold import gold
from strata.operators.quality import (
    MISSING_ORDER_ID,
    REASONS,
    reason_metrics,
    with_reject_reason,
)
from strata.operators.silver import silver
from strata.schemas import BRONZE_SCHEMA, BUSINESS_COLUMNS, SILVER_SCHEMA, check_layer_schema
from strata.sinks.layers import (
    LAYERS,
    Build,
    _hadoop_path,
    current_build,
    layer_complete,
    layer_path,
    refuse_foreign,
    take_snapshot,
    write_layer,
)
from strata.sources.files import MALFORMED_COLUMN, MALFORMED_FLAG, read_layer, read_lines


@dataclass
class PipelineResult:
    base: str
    paths: dict[str, str]
    counts: dict[str, int | None] = field(default_factory=dict)
    rejects: dict[str, int | None] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)


def stage_counts_of(bronze_rows: int, rejects: dict[str, int]) -> dict[str, int]:
    """Rows left after each rule, from the rows seen and the rejects by reason."""
    after_id = bronze_rows - rejects[MISSING_ORDER_ID]
    after_amount = after_id - sum(n for reason, n in rejects.items() if reason != MISSING_ORDER_ID)
    return {"bronze": bronze_rows, "after_order_id": after_id, "after_amount": after_amount, "silver": after_amount}


def source_roots(spark: SparkSession, source: DataFrame | str | list[str]) -> list[str] | None:
    """The folders and files a source reads, qualified, with globs expanded; of a
    DataFrame the root paths of its scans (never its file list). None when a
    DataFrame reads anything else (rows in memory, another system)."""
    jvm = spark.sparkContext._jvm
    if isinstance(source, DataFrame):
        roots = []
        for leaf in _scala(source._jdf.queryExecution().analyzed().collectLeaves()):
            if leaf.getClass().getSimpleName() != "LogicalRelation" or not hasattr(leaf.relation(), "location"):
                return None
            roots += _scala(leaf.relation().location().rootPaths())
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        return sorted({_plain(p.getFileSystem(conf), p) for p in roots})  # names already, no patterns
    paths = [jvm.org.apache.hadoop.fs.Path(x) for x in ([source] if isinstance(source, str) else source)]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        fs = path.getFileSystem(conf)
        found += [_plain(fs, s.getPath()) for s in (fs.globStatus(path) or [])]
    return sorted(set(found))


def _scala(seq) -> list:
    return [seq.apply(i) for i in range(seq.length())]


def _plain(fs, path) -> str:
    """A path as scheme, host and decoded path, without . and .. steps."""
    uri = fs.makeQualified(path).toUri().normalize()
    return f"{uri.getScheme() or ''}://{uri.getAuthority() or ''}{uri.getPath().rstrip('/')}"


def source_id(spark: SparkSession, source: DataFrame | str | list[str]) -> str | None:
    """What a source holds now: a digest of path, length and time of change of every
    file, added up in tasks in any order. None when it can't be told."""
    roots = source_roots(spark, source)
    if not roots:
        return None
    escaped = [re.sub(r"([\\{}\[\]*?])", r"\\\1", root) for root in roots]  # names, no patterns
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(escaped)
    # the content is not selected, so no file is opened
    facts = F.sha2(F.concat_ws("\n", "path", "length", F.unix_micros("modificationTime")), 256)
    digits = [F.conv(F.substring(facts, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)") for k in range(4)]
    found = files.agg(F.count(F.lit(1)).alias("n"), *[F.sum(d).alias(f"d{k}") for k, d in enumerate(digits)]).first()
    return hashlib.sha256(json.dumps([roots, *map(str, found)]).encode()).hexdigest()


def _check_no_overlap(spark: SparkSession, source: DataFrame | str | list[str], layer_paths: list[str]) -> None:
    """Refuse a source that is one of the layers, lies in one, or holds one."""
    for layer in layer_paths:
        p, fs = _hadoop_path(spark, layer)
        own = _plain(fs, p)
        for item in source_roots(spark, source) or []:
            if item == own or item.startswith(own + "/") or own.startswith(item + "/"):
                raise ValueError(f"source {item} overlaps layer {own}; write the layers elsewhere")


def _observed(obs: Observation) -> dict[str, int]:
    return {k: int(v) for k, v in obs.get.items()}


@contextmanager
def _files_side_by_side(spark: SparkSession, most: int) -> Iterator[None]:
    """Let a write keep a file open for each of ``most`` partition values instead of
    sorting every task's rows by them."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, "0")
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_pipeline(
    spark: SparkSession,
    source: DataFrame | str | list[str] | None,
    base: str,
    table: str = "orders",
    gold_table: str = "order_summary",
    load_time_at: dt.datetime | None = None,
    resume: bool = False,
    silver_partition_by: list[str] | None = None,
    start_at: str = "bronze",
    stop_after: str = "gold",
) -> PipelineResult:
    """Run the layers under ``base``; returns paths and stage counts.

    ``source`` is a raw DataFrame (all-text business columns, optionally with
    ``source_file``) or a path/glob of raw CSV files. These are scanned once: CSV
    lines with a wrong number of fields are kept whole in a partition of the Bronze
    build (:func:`strata.sources.files.read_malformed_lines`) and counted as
    ``malformed``.

    Every layer records the build it was made from (Bronze: a digest of the
    source's files) and the counts of its write, so a resumed run reports those of the
    layers it keeps. Once all three layers are of one run, a snapshot of the base names
    them together. With ``resume`` a layer is kept only if that is still its
    input, so new raw files are never passed over; a DataFrame source counts as
    unchanged when the paths it scans are. ``start_at`` rebuilds from the named
    layer on, from the layers before it as they are (no source needed), and
    ``stop_after`` ends the run early: a scheduler runs layers as separate
    tasks with either.

    ``silver_partition_by`` (e.g. ``["order_date"]``) writes Silver as a
    partitioned table so date-range readers prune directories. Each task then
    writes one file per partition value it holds, so use it with a coarse key
    and large input splits; off by default. Gold reads Silver back by column
    name, so the partition column's position does not matter.
    """
    paths = {
        "bronze": layer_path(base, "bronze", table),
        "silver": layer_path(base, "silver", table),
        "gold": layer_path(base, "gold", gold_table),
    }
    for name, layer in (("start_at", start_at), ("stop_after", stop_after)):
        if layer not in LAYERS:
            raise ValueError(f"{name} must be one of {LAYERS}")
    wanted = LAYERS[LAYERS.index(start_at) : LAYERS.index(stop_after) + 1]
    if isinstance(source, DataFrame) and source.isStreaming:
        raise ValueError("run_pipeline takes a batch source; use strata.streaming.medallion.run_incremental")
    for layer, path in paths.items():
        if layer_complete(spark, path) and current_build(spark, path) is None:
            check_layer_schema(read_layer(spark, path).schema, layer, ordered=False)
        refuse_foreign(spark, path)
    built_from = None
    if "bronze" in wanted:
        if source is None:
            raise ValueError("a run that starts at bronze needs a source")
        _check_no_overlap(spark, source, list(paths.values()))
        built_from = source_id(spark, source)
    result = PipelineResult(base=base, paths=paths)

    def kept(layer: str, made_from: str | None) -> Build | None:
        """The layer's current build, if this run takes it as it is."""
        build = current_build(spark, paths[layer])
        if layer not in wanted:
            if build is None and LAYERS.index(layer) < LAYERS.index(start_at):
                raise ValueError(f"cannot start at {start_at}: there is no {layer} layer at {paths[layer]}")
            return build
        if resume and build and made_from is not None and build.built_from == made_from:
            check_layer_schema(read_layer(spark, paths[layer]).schema, layer, ordered=False)
            result.skipped.append(layer)
            return build
        return None

    # Bronze: raw rows + lineage.
    bronze_build = kept("bronze", built_from)
    if bronze_build is None:
        obs_b = Observation("bronze")
        if isinstance(source, (str, list)):
            line = F.col(MALFORMED_COLUMN)
            rows = bronze_lines(read_lines(spark, source), load_time_at).observe(
                obs_b, F.count_if(line.isNull()).alias("bronze"), F.count_if(line.isNotNull()).alias("malformed")
            )
            with _files_side_by_side(spark, 2):
                bronze_build = write_layer(
                    rows, paths["bronze"], [MALFORMED_FLAG], built_from, lambda: _observed(obs_b), BRONZE_SCHEMA
                )
        else:
            rows = bronze(source, load_time_at).observe(obs_b, F.count(F.lit(1)).alias("bronze"))
            bronze_build = write_layer(rows, paths["bronze"], None, built_from, lambda: _observed(obs_b))

    # Silver: rules over the Bronze layer. The reject reason is computed once
    # per row; its counts are observed during the write and the Silver filter
    # keeps the rows without one.
    silver_build = kept("silver", bronze_build.id) if stop_after != "bronze" else None
    if stop_after != "bronze" and silver_build is None:
        obs_s = Observation("silver")
        bronze_df = with_reject_reason(read_layer(spark, paths["bronze"], BUSINESS_COLUMNS, schema=BRONZE_SCHEMA))
        silver_build = write_layer(
            silver(bronze_df.observe(obs_s, *reason_metrics())),
            paths["silver"],
            silver_partition_by,
            bronze_build.id,
            lambda: _observed(obs_s),
        )

    # Gold: summary over the Silver layer. Readers order it; a layer is not sorted.
    gold_build = kept("gold", silver_build.id) if stop_after == "gold" else None
    if stop_after == "gold" and gold_build is None:
        obs_g = Observation("gold")
        silver_df = read_layer(spark, paths["silver"], BUSINESS_COLUMNS, schema=SILVER_SCHEMA)
        rows = gold(silver_df, order=False).observe(obs_g, F.count(F.lit(1)).alias("gold"))
        gold_build = write_layer(rows, paths["gold"], None, silver_build.id, lambda: _observed(obs_g))
    one_run = gold_build and (gold_build.built_from, silver_build.built_from) == (silver_build.id, bronze_build.id)
    if one_run and len(result.skipped) < len(LAYERS):
        take_snapshot(spark, base, {"bronze": bronze_build, "silver": silver_build, "gold": gold_build})

    result.rejects = dict.fromkeys(REASONS)
    result.counts = dict.fromkeys(("bronze", "after_order_id", "after_amount", "silver", "gold"))
    if silver_build and silver_build.counts:
        result.rejects = {r: silver_build.counts[r] for r in REASONS}
        result.counts |= stage_counts_of(silver_build.counts["bronze"], result.rejects)
    result.counts |= bronze_build.counts | (gold_build.counts if gold_build else {})
    return result
