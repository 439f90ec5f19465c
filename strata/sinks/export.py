"""One CSV file with a chosen name, for small results (reports, summaries).

Spark writes a directory of part files; a report wants one named file. The
frame is written by a single task into a temporary directory next to the target
and the one part file replaces the target in one step. One file is the feature:
large tables belong in a layer (:mod:`strata.sinks.layers`), which is written in
parallel; nothing is counted or kept in memory for the check of a bound.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.operators.gold import order_gold
from strata.sinks.layers import POINTERS, _hadoop_path, delete_path, path_exists
from strata.sources.files import CSV_KEEP_BLANKS, read_layer


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file onto ``target``, replacing it in one step."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(target).toUri(), conf)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(path(source), path(target), options)


def export_single_csv(df: DataFrame, final_path: str, header: bool = True) -> str:
    """Write ``df`` (row order kept) to exactly one CSV file at ``final_path``."""
    spark = df.sparkSession
    tmp_dir = f"{final_path}__tmp-{uuid.uuid4().hex}"
    (
        df.coalesce(1)
        .write.mode("errorifexists")
        .option("header", "true" if header else "false")
        .options(**CSV_KEEP_BLANKS)
        .csv(tmp_dir)
    )
    tmp, fs = _hadoop_path(spark, tmp_dir)
    parts = [s.getPath() for s in fs.listStatus(tmp) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {tmp_dir}, found {len(parts)}")
    target, _ = _hadoop_path(spark, final_path)
    fs.mkdirs(target.getParent())
    replace_file(spark, parts[0].toString(), final_path)
    delete_path(spark, tmp_dir)
    return final_path


def export_layers_csv(
    spark: SparkSession, paths: dict[str, str], out_base: str, gold_name: str = "order_summary.csv"
) -> dict[str, str]:
    """CSV copies of the layers under ``out_base``.

    Bronze and Silver become directories of part files written in parallel
    (blanks kept; CSV cannot tell an empty string from NULL, so a read-back
    turns '' into NULL); Gold, a handful of rows, becomes one named file. A
    target that is a layer, or lies in one, is refused.
    """
    out = out_base.rstrip("/")
    written: dict[str, str] = {}
    for layer in ("bronze", "silver"):
        if layer in paths:
            target = f"{out}/{layer}/orders"
            if any(path_exists(spark, f"{folder}/{POINTERS}") for folder in (target, f"{out}/{layer}", out)) or path_exists(
                spark, f"{target}/_spark_metadata"
            ):
                raise ValueError(f"{target} is part of a layer; export the CSV copies elsewhere")
            read_layer(spark, paths[layer]).write.mode("overwrite").option("header", "true").options(**CSV_KEEP_BLANKS).csv(target)
            written[layer] = target
    if "gold" in paths:
        gold_df = order_gold(read_layer(spark, paths["gold"]))
        written["gold"] = export_single_csv(gold_df, f"{out}/gold/{gold_name}")
    return written
