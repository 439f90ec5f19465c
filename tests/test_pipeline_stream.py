"""Pipeline with real writes; streaming Bronze ingest; idempotence."""

from __future__ import annotations

import datetime as dt
import os

import pandas as pd

from strata import run_pipeline
from strata.schemas import BRONZE_COLUMNS, BUSINESS_COLUMNS, GOLD_COLUMNS
from strata.session import scratch_path
from strata.sources.files import read_layer
from strata.sources.fixtures import orders_src
from strata.streaming.ingest import ingest_bronze, read_raw_stream
from tests.conftest import SF0001

# Acceptance numbers at sf0.001 (computed in Spark and DuckDB).
GOLD_SF0001 = {
    "CanTho": (275, 10000000065689627, 146, 39),
    "DaNang": (268, 67216666, 153, 42),
    "Hanoi": (270, 65647777, 142, 46),
    "HaiPhong": (251, 62870644, 145, 34),
    "HCM": (237, 58370352, 129, 35),
}


def test_pipeline_counts_layers_and_idempotence(spark):
    base = scratch_path(spark, "lakehouse")
    src = orders_src(spark, SF0001, with_source_file=True)
    res = run_pipeline(spark, src, base, load_time_at=dt.datetime(2026, 1, 1))
    assert res.counts == {"bronze": 1500, "after_order_id": 1411, "after_amount": 1301, "silver": 1301, "gold": 5}
    assert res.rejects == {"missing_order_id": 89, "amount_not_numeric": 20, "amount_not_positive": 88, "amount_out_of_range": 2}
    assert read_layer(spark, res.paths["bronze"]).columns == BRONZE_COLUMNS
    assert read_layer(spark, res.paths["silver"]).columns == BUSINESS_COLUMNS
    gold = read_layer(spark, res.paths["gold"])
    assert gold.columns == GOLD_COLUMNS
    first = {r.province: tuple(r)[1:] for r in gold.collect()}
    assert first == GOLD_SF0001
    silver_rows = sorted(map(tuple, read_layer(spark, res.paths["silver"]).collect()), key=str)

    again = run_pipeline(spark, src, base, load_time_at=dt.datetime(2026, 1, 1))
    assert again.counts == res.counts
    assert sorted(map(tuple, read_layer(spark, res.paths["silver"]).collect()), key=str) == silver_rows
    assert {r.province: tuple(r)[1:] for r in read_layer(spark, res.paths["gold"]).collect()} == first


def test_pipeline_resume_skips_finished_layers(spark):
    base = scratch_path(spark, "lakehouse")
    src = orders_src(spark, SF0001, with_source_file=True)
    run_pipeline(spark, src, base)
    res = run_pipeline(spark, src, base, resume=True)
    assert res.skipped == ["bronze", "silver", "gold"]


def test_pipeline_from_csv_path(spark):
    d = scratch_path(spark, "raw-csv")
    orders_src(spark, SF0001).write.option("header", "true").csv(d)
    res = run_pipeline(spark, d, scratch_path(spark, "lakehouse"))
    # CSV turns '' into NULL, both rejected as missing ids: same Silver and Gold.
    assert res.counts["silver"] == 1301
    got = {r.province: tuple(r)[1:] for r in read_layer(spark, res.paths["gold"]).collect()}
    assert got == GOLD_SF0001


def test_stream_ingest_is_exactly_once(spark):
    src_dir = scratch_path(spark, "landing")
    local = src_dir[len("file:"):] if src_dir.startswith("file:") else src_dir
    os.makedirs(local)
    header = "order_id,customer_id,province,amount,status,order_date\n"
    with open(os.path.join(local, "a.csv"), "w") as f:
        f.write(header + "1,CUS001,Hanoi,100,SUCCESS,2026-01-01\n2,CUS002,HCM,5,failed,2026-01-02\n")
    bronze_path = scratch_path(spark, "bronze")
    ingest_bronze(read_raw_stream(spark, src_dir), bronze_path)
    ingest_bronze(read_raw_stream(spark, src_dir), bronze_path)  # nothing new: no duplicates
    assert read_layer(spark, bronze_path).count() == 2
    with open(os.path.join(local, "b.csv"), "w") as f:
        f.write(header + "3,CUS003,DaNang,7,SUCCESS,2026-01-03\n")
    ingest_bronze(read_raw_stream(spark, src_dir), bronze_path)
    b = read_layer(spark, bronze_path)
    assert b.count() == 3
    assert {r.source_file.rsplit("/", 1)[-1] for r in b.collect()} == {"a.csv", "b.csv"}


def test_incremental_medallion_matches_batch(spark):
    from strata import bronze, gold, silver
    from strata.sources.files import read_raw
    from strata.streaming.medallion import run_incremental

    landing = scratch_path(spark, "landing")
    src = orders_src(spark, SF0001)
    first, second = src.filter("substr(customer_id, 6, 1) < '5'"), src.filter("substr(customer_id, 6, 1) >= '5'")
    first.write.option("header", "true").csv(f"{landing}/part=1")
    base = scratch_path(spark, "lakehouse-incremental")

    def batch_gold():
        return {tuple(r) for r in gold(silver(bronze(read_raw(spark, f"{landing}/*")))).collect()}

    paths = run_incremental(spark, read_raw_stream(spark, f"{landing}/*"), base)
    assert {tuple(r) for r in read_layer(spark, paths.gold).collect()} == batch_gold()
    n_first = first.count()
    assert paths.counts["bronze"] == n_first
    assert paths.counts["silver"] == read_layer(spark, paths.silver).count()

    second.write.option("header", "true").csv(f"{landing}/part=2")
    paths = run_incremental(spark, read_raw_stream(spark, f"{landing}/*"), base)
    assert paths.counts["bronze"] == 1500 - n_first  # only the new file
    assert sum(paths.rejects.values()) + paths.counts["silver"] == 1500 - n_first
    got = {tuple(r) for r in read_layer(spark, paths.gold).collect()}
    assert got == batch_gold()
    assert {r[0]: r[1:] for r in got} == GOLD_SF0001
    assert read_layer(spark, paths.bronze).count() == 1500


def test_pipeline_with_partitioned_silver(spark):
    from pyspark.sql import functions as F

    base = scratch_path(spark, "lakehouse")
    res = run_pipeline(spark, orders_src(spark, SF0001, with_source_file=True), base, silver_partition_by=["order_date"])
    assert {r.province: tuple(r)[1:] for r in read_layer(spark, res.paths["gold"]).collect()} == GOLD_SF0001
    s = read_layer(spark, res.paths["silver"], BUSINESS_COLUMNS)
    assert s.count() == 1301
    one_day = s.filter(F.col("order_date") == F.lit("1995-06-17").cast("date"))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan
    assert s.filter(F.col("order_date").isNull()).count() == 13  # unparseable dates kept


def test_pipeline_refuses_source_inside_a_layer(spark):
    import pytest

    base = scratch_path(spark, "lakehouse")
    res = run_pipeline(spark, orders_src(spark, SF0001, with_source_file=True), base)
    with pytest.raises(ValueError):
        run_pipeline(spark, res.paths["bronze"], base)
    bronze_df = read_layer(spark, res.paths["bronze"], BUSINESS_COLUMNS)
    with pytest.raises(ValueError):
        run_pipeline(spark, bronze_df, base)
    assert read_layer(spark, res.paths["bronze"]).count() == 1500  # untouched


def test_pipeline_rejects_streaming_source(spark):
    import pytest

    landing = scratch_path(spark, "landing")
    orders_src(spark, SF0001).write.option("header", "true").csv(landing)
    with pytest.raises(ValueError, match="run_incremental"):
        run_pipeline(spark, read_raw_stream(spark, landing), scratch_path(spark, "lakehouse"))


def test_pipeline_layer_by_layer_and_contract_on_resume(spark):
    import pytest

    base = scratch_path(spark, "lakehouse")
    src = orders_src(spark, SF0001, with_source_file=True)
    first = run_pipeline(spark, src, base, stop_after="bronze")
    assert first.counts["bronze"] == 1500 and first.counts["silver"] is None
    second = run_pipeline(spark, src, base, resume=True, stop_after="silver")
    assert second.skipped == ["bronze"] and second.counts["silver"] == 1301
    third = run_pipeline(spark, src, base, resume=True)
    assert third.skipped == ["bronze", "silver"]
    assert {r.province: tuple(r)[1:] for r in read_layer(spark, third.paths["gold"]).collect()} == GOLD_SF0001

    # A complete but foreign table at a layer path is not silently reused.
    other = scratch_path(spark, "lakehouse")
    spark.range(3).write.parquet(f"{other}/bronze/orders")
    with pytest.raises(ValueError, match="bronze layer schema mismatch"):
        run_pipeline(spark, src, other, resume=True)


def test_resume_accepts_partitioned_silver(spark):
    base = scratch_path(spark, "lakehouse")
    src = orders_src(spark, SF0001, with_source_file=True)
    run_pipeline(spark, src, base, silver_partition_by=["order_date"], stop_after="silver")
    res = run_pipeline(spark, src, base, resume=True)
    assert res.skipped == ["bronze", "silver"]
    assert {r.province: tuple(r)[1:] for r in read_layer(spark, res.paths["gold"]).collect()} == GOLD_SF0001


def test_incremental_archives_processed_files(spark):
    from strata.streaming.medallion import run_incremental

    root = scratch_path(spark, "archiving")
    local = root[len("file:"):] if root.startswith("file:") else root
    os.makedirs(f"{local}/landing")
    header = "order_id,customer_id,province,amount,status,order_date\n"
    for i in range(3):
        with open(f"{local}/landing/f{i}.csv", "w") as f:
            f.write(header + f"{i + 1},CUS001,Hanoi,100,SUCCESS,2026-01-01\n")
    run_incremental(spark, f"{root}/landing", f"{root}/lake", archive_dir=f"{root}/archive")
    with open(f"{local}/landing/f9.csv", "w") as f:
        f.write(header + "9,CUS001,HCM,5,failed,2026-01-02\n")
    paths = run_incremental(spark, f"{root}/landing", f"{root}/lake", archive_dir=f"{root}/archive")
    assert sorted(os.listdir(f"{local}/landing")) == ["f9.csv"]  # earlier files moved out
    assert read_layer(spark, paths.bronze).count() == 4
    got = {r.province: tuple(r)[1:] for r in read_layer(spark, paths.gold).collect()}
    assert got == {"Hanoi": (3, 300, 3, 0), "HCM": (1, 5, 0, 1)}


def test_stream_ingest_resumes_exactly_once_after_interruption(spark):
    import time

    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def slow(values: pd.Series) -> pd.Series:  # test-only: keep each micro-batch busy
        time.sleep(0.5)
        return values

    root = scratch_path(spark, "interrupt")
    local = root[len("file:"):] if root.startswith("file:") else root
    os.makedirs(f"{local}/landing")
    header = "order_id,customer_id,province,amount,status,order_date\n"
    for i in range(8):
        with open(f"{local}/landing/f{i}.csv", "w") as f:
            f.write(header + "".join(f"{i * 100 + j},CUS001,Hanoi,100,SUCCESS,2026-01-01\n" for j in range(100)))
    bronze_path = f"{root}/bronze"

    def stream():
        return read_raw_stream(spark, f"{root}/landing", max_files_per_trigger=1)

    running = ingest_bronze(
        stream(), bronze_path, transform=lambda df: df.withColumn("status", slow("status")), processing_time="0 seconds"
    )
    deadline = time.time() + 60
    while time.time() < deadline and (running.lastProgress or {}).get("batchId", -1) < 2:
        time.sleep(0.1)
    running.stop()  # interrupted, most likely in the middle of a batch
    partial = read_layer(spark, bronze_path).count()
    assert 0 < partial < 800

    ingest_bronze(stream(), bronze_path)  # resume: everything not committed yet
    b = read_layer(spark, bronze_path)
    assert b.count() == 800
    assert b.select("order_id").distinct().count() == 800  # nothing twice


def test_incremental_and_batch_report_the_same_counts(spark):
    from strata.streaming.medallion import run_incremental

    landing = scratch_path(spark, "landing")
    orders_src(spark, SF0001).write.option("header", "true").csv(landing)
    batch = run_pipeline(spark, landing, scratch_path(spark, "lakehouse"))
    inc = run_incremental(spark, landing, scratch_path(spark, "lakehouse-incremental"))
    assert inc.counts == {k: v for k, v in batch.counts.items() if k not in ("gold", "malformed")}
    assert inc.rejects == batch.rejects
