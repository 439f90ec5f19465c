"""CSV scans, layer round trips, single-file export, publishing."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException

from strata import bronze
from strata.schemas import BUSINESS_COLUMNS, GOLD_SCHEMA, RAW_SCHEMA
from strata.session import scratch_path, shared_dir
from strata.sinks.export import export_single_csv
from strata.sinks.layers import layer_complete, publish_layers, write_layer
from strata.sources.files import read_inferred_csv, read_layer, read_malformed, read_orders_csv, read_raw


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def _write_text(spark, name: str, text: str) -> str:
    d = _local(scratch_path(spark, name))
    os.makedirs(d)
    with open(os.path.join(d, "orders.csv"), "w") as f:
        f.write(text)
    return d


def test_scratch_is_under_checkpoint_dir(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_read_raw_attaches_source_file_and_keeps_padding(spark):
    d = _write_text(
        spark,
        "raw",
        "order_id,customer_id,province,amount,status,order_date\n"
        "1,CUS001,Hanoi, 100 , success ,2026-01-01\n"
        ",CUS002,HCM,abc,FAILED,2026-13-01\n",
    )
    df = read_raw(spark, d)
    assert df.columns == BUSINESS_COLUMNS + ["source_file"]
    rows = df.orderBy("customer_id").collect()
    assert rows[0].amount == " 100 " and rows[0].status == " success "
    assert rows[1].order_id is None  # empty CSV field reads as NULL
    assert rows[0].source_file.endswith("/orders.csv")


def test_read_raw_rejects_swapped_header(spark):
    d = _write_text(
        spark,
        "swapped",
        "customer_id,order_id,province,amount,status,order_date\nCUS001,1,Hanoi,100,SUCCESS,2026-01-01\n",
    )
    with pytest.raises(Exception):
        read_raw(spark, d).collect()


def test_header_only_csv_is_empty(spark):
    d = _write_text(spark, "header-only", "order_id,customer_id,province,amount,status,order_date\n")
    assert read_raw(spark, d).count() == 0
    assert read_raw(spark, d).schema["order_id"].dataType == RAW_SCHEMA["order_id"].dataType


def test_typed_and_inferred_csv(spark):
    d = _write_text(spark, "typed", "order_id,customer_id,province,amount,status\n7,CUS007,Hanoi,950000,SUCCESS\n")
    typed = read_orders_csv(spark, d).collect()[0]
    assert typed.order_id == 7 and typed.amount == 950000
    inferred = read_inferred_csv(spark, d)
    assert inferred.schema["order_id"].dataType.simpleString() == "int"


def test_missing_layer_raises(spark):
    with pytest.raises(AnalysisException):
        read_layer(spark, scratch_path(spark, "nothing-here"))


def test_bronze_parquet_roundtrip_keeps_blanks(spark, raw_rows):
    rows = [("", "C", "P", "  7 ", " x ", "2026-01-01"), (None, "C", "P", None, "s", None)]
    path = scratch_path(spark, "bronze")
    write_layer(bronze(raw_rows(rows), load_time_at=dt.datetime(2026, 1, 1)), path)
    assert layer_complete(spark, path)
    back = read_layer(spark, path, BUSINESS_COLUMNS).orderBy("status").collect()
    assert sorted(map(tuple, back), key=str) == sorted(rows, key=str)


def test_export_single_csv_keeps_order_and_overwrites(spark):
    df = spark.createDataFrame(
        [("b", 2, 30, 1, 0), ("a", 1, 20, 0, 1), ("c", 3, 10, 1, 1)], schema=GOLD_SCHEMA
    ).orderBy("total_amount", ascending=False)
    target = scratch_path(spark, "export") + "/gold/order_summary.csv"
    export_single_csv(df, target)
    export_single_csv(df, target)  # replaces the existing file
    local = _local(target)
    assert os.path.isfile(local)
    visible = [f for f in os.listdir(os.path.dirname(local)) if not f.startswith(".")]
    assert visible == ["order_summary.csv"]  # temp folder removed
    with open(local) as f:
        lines = f.read().splitlines()
    assert lines[0] == "province,total_orders,total_amount,success_orders,failed_orders"
    assert [line.split(",")[0] for line in lines[1:]] == ["b", "a", "c"]


def test_typed_csv_keeps_large_values_and_refuses_bad_ones(spark):
    header = "order_id,customer_id,province,amount,status\n"
    d = _write_text(spark, "large", header + "3000000000,C,P,5000000000,SUCCESS\n")
    assert [tuple(r) for r in read_orders_csv(spark, d).collect()] == [(3000000000, "C", "P", 5000000000, "SUCCESS")]
    bad = _write_text(spark, "bad", header + "x,C,P,1,SUCCESS\n")
    with pytest.raises(Exception, match="MALFORMED|x"):
        read_orders_csv(spark, bad).collect()


def test_malformed_lines_are_kept_whole(spark):
    d = _write_text(
        spark, "malformed", ",".join(BUSINESS_COLUMNS) + "\n1,C,P,5,S,2026-01-01\n2,C,P,5,S,2026-01-01,extra\n3,C,P\n"
    )
    assert [r.order_id for r in read_raw(spark, d, whole_lines=True).collect()] == ["1"]
    lines = read_malformed(spark, d).collect()
    assert sorted(r.malformed_line for r in lines) == ["2,C,P,5,S,2026-01-01,extra", "3,C,P"]
    assert all(r.source_file.endswith("/orders.csv") for r in lines)


def test_export_empty_frame_writes_header_only(spark):
    target = scratch_path(spark, "export") + "/empty.csv"
    export_single_csv(spark.createDataFrame([], GOLD_SCHEMA), target)
    with open(_local(target)) as f:
        assert f.read().splitlines() == ["province,total_orders,total_amount,success_orders,failed_orders"]


def test_publish_layers(spark):
    base = scratch_path(spark, "published")
    paths = publish_layers({"gold": spark.range(3)}, base, tables={"gold": "order_summary"})
    assert paths["gold"] == f"{base}/gold/order_summary"
    assert read_layer(spark, paths["gold"]).count() == 3


def test_crlf_files_parse_like_lf(spark):
    from strata import bronze, silver

    d = _write_text(
        spark,
        "crlf",
        "order_id,customer_id,province,amount,status,order_date\r\n"
        "1,CUS001,Hanoi,100,SUCCESS,2026-01-01\r\n"
        "2,CUS002,HCM,5,failed,2026-02-03\r\n",
    )
    rows = silver(bronze(read_raw(spark, d))).orderBy("order_id").collect()
    assert [str(r.order_date) for r in rows] == ["2026-01-01", "2026-02-03"]
    assert [r.status for r in rows] == ["SUCCESS", "FAILED"]


def test_utf8_bom_header_is_accepted(spark):
    d = _local(scratch_path(spark, "bom"))
    os.makedirs(d)
    with open(os.path.join(d, "orders.csv"), "w", encoding="utf-8-sig") as f:
        f.write("order_id,customer_id,province,amount,status,order_date\n1,CUS001,Hanoi,100,SUCCESS,2026-01-01\n")
    rows = read_raw(spark, d).collect()
    assert rows[0].order_id == "1" and rows[0].order_date == "2026-01-01"
