"""Layers as builds: new input is never passed over, and nothing readable is lost."""

from __future__ import annotations

import os

import pytest

from strata import run_incremental, run_pipeline
from strata.schemas import BUSINESS_COLUMNS
from strata.session import scratch_path
from strata.sinks.export import export_layers_csv
from strata.sinks.layers import ConcurrentWriteError, current_build, publish_layers, write_layer
from strata.sources.files import read_layer, read_malformed_lines, read_raw, read_snapshot

HEADER = ",".join(BUSINESS_COLUMNS) + "\n"


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def _land(folder: str, name: str, text: str) -> str:
    os.makedirs(_local(folder), exist_ok=True)
    with open(f"{_local(folder)}/{name}", "w") as f:
        f.write(text)
    return f"{folder}/{name}"


def _row(i: int, amount: int = 10) -> str:
    return f"{i},CUS001,Hanoi,{amount},SUCCESS,2026-01-01\n"


def _orders(spark, result) -> int:
    return sum(r.total_orders for r in read_layer(spark, result.paths["gold"]).collect())


def test_two_days_layer_by_layer(spark):
    root = scratch_path(spark, "days")
    landing, base = f"{root}/landing", f"{root}/lake"
    _land(landing, "a.csv", HEADER + _row(1))
    for day in (1, 2):
        run_pipeline(spark, landing, base, resume=True, stop_after="bronze")
        run_pipeline(spark, landing, base, resume=True, stop_after="silver")
        last = run_pipeline(spark, landing, base, resume=True)
        assert _orders(spark, last) == day
        if day == 1:  # a second landing of equal text would be a change: its time is new
            _land(landing, "b.csv", HEADER + _row(2) + "3,short\n")
    assert run_pipeline(spark, landing, base, resume=True).skipped == ["bronze", "silver", "gold"]
    assert [r.malformed_line for r in read_malformed_lines(spark, last.paths["bronze"]).collect()] == ["3,short"]
    assert last.counts["malformed"] == 1


def test_rerun_one_layer_from_the_one_before(spark):
    root = scratch_path(spark, "rerun")
    _land(f"{root}/landing", "a.csv", HEADER + _row(1))
    with pytest.raises(ValueError, match="no bronze layer"):
        run_pipeline(spark, None, f"{root}/lake", start_at="silver")
    first = run_pipeline(spark, f"{root}/landing", f"{root}/lake")
    before = {k: current_build(spark, p).id for k, p in first.paths.items()}
    run_pipeline(spark, None, f"{root}/lake", start_at="silver", stop_after="silver")
    run_pipeline(spark, None, f"{root}/lake", start_at="gold")
    after = {k: current_build(spark, p).id for k, p in first.paths.items()}
    assert after["bronze"] == before["bronze"] and after["silver"] != before["silver"] and after["gold"] != before["gold"]
    assert current_build(spark, first.paths["gold"]).built_from == after["silver"]


def test_failed_rerun_keeps_the_last_layers(spark):
    root = scratch_path(spark, "bad")
    _land(f"{root}/landing", "a.csv", HEADER + _row(1))
    first = run_pipeline(spark, f"{root}/landing", f"{root}/lake")
    _land(f"{root}/landing", "b.csv", "customer_id,order_id,province,amount,status,order_date\nC,1,P,1,S,2026-01-01\n")
    with pytest.raises(Exception):
        run_pipeline(spark, f"{root}/landing", f"{root}/lake")
    assert read_layer(spark, first.paths["bronze"]).count() == 1 and _orders(spark, first) == 1
    builds = [x for x in os.listdir(_local(first.paths["bronze"])) if x.startswith("build-")]
    assert len(builds) == 1


def test_sources_inside_a_layer_are_refused_and_kept(spark):
    root = scratch_path(spark, "in side")
    inside = _land(f"{root}/lake/bronze/orders", "raw file.csv", HEADER + _row(1))
    for source in (f"{root}/lake/*/orders", f"{root}/./lake/bronze/orders", inside, f"{root}/lake"):
        with pytest.raises(ValueError):
            run_pipeline(spark, source, f"{root}/lake")
    frame = spark.read.option("header", "true").csv(inside)
    with pytest.raises(ValueError, match="overlaps"):
        run_pipeline(spark, frame, f"{root}/lake")
    assert os.path.exists(_local(inside))


def test_layer_can_be_published_onto_itself_but_not_as_csv(spark):
    root = scratch_path(spark, "publish")
    _land(f"{root}/landing", "a.csv", HEADER + _row(1))
    first = run_pipeline(spark, f"{root}/landing", f"{root}/lake")
    publish_layers({"bronze": read_layer(spark, first.paths["bronze"])}, f"{root}/lake")
    assert read_layer(spark, first.paths["bronze"]).count() == 1
    with pytest.raises(ValueError, match="export the CSV copies elsewhere"):
        export_layers_csv(spark, first.paths, f"{root}/lake")
    assert read_layer(spark, first.paths["bronze"]).count() == 1


def test_old_builds_go_but_the_one_before_stays(spark):
    path = scratch_path(spark, "layer")
    ids = [write_layer(spark.range(n), path).id for n in range(1, 5)]
    found = sorted(x for x in os.listdir(_local(path)) if x.startswith("build-"))
    assert found == sorted(ids[-2:]) and read_layer(spark, path).count() == 4


def test_batch_and_incremental_refuse_each_others_base(spark):
    root = scratch_path(spark, "owners")
    _land(f"{root}/landing", "a.csv", HEADER + _row(1))
    run_pipeline(spark, f"{root}/landing", f"{root}/batch")
    with pytest.raises(ValueError, match="batch pipeline"):
        run_incremental(spark, f"{root}/landing", f"{root}/batch")
    paths = run_incremental(spark, f"{root}/landing", f"{root}/stream")
    with pytest.raises(ValueError, match="incremental run"):
        run_pipeline(spark, f"{root}/landing", f"{root}/stream")
    assert read_layer(spark, paths.bronze).count() == 1


def test_counts_cover_every_batch_of_a_backfill(spark):
    root = scratch_path(spark, "backfill")
    for i in range(12):
        _land(f"{root}/landing", f"f{i}.csv", HEADER + _row(i, amount=i - 2))
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        paths = run_incremental(spark, f"{root}/landing", f"{root}/lake", max_files_per_trigger=2)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert paths.counts == {"bronze": 12, "after_order_id": 12, "after_amount": 9, "silver": 9}
    assert paths.rejects["amount_not_positive"] == 3
    assert sum(r.total_orders for r in read_layer(spark, paths.gold).collect()) == 9


def test_queries_read_a_table_of_part_files(spark, tmp_path):
    from strata.plans import catalogue
    from tests.conftest import SF0001

    spark.read.parquet(f"{SF0001}/orders.parquet").repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("stream_bronze_ingest", "incremental_gold_summary"):
        a, b = (sorted(map(tuple, catalogue.queries()[name](spark, d).collect()), key=str) for d in (SF0001, str(tmp_path)))
        assert a == b and a


@pytest.mark.parametrize("source", ["folder", "glob", "frame"])
def test_a_rewrite_of_equal_size_in_a_subfolder_is_seen(spark, source):
    root = scratch_path(spark, "rewrite")
    landing, base = f"{root}/landing [{source}]", f"{root}/lake"
    file = _land(f"{landing}/day=1", "a.csv", HEADER + _row(1, 5))
    escaped = landing.replace("[", "\\[").replace("]", "\\]")

    def given():
        if source == "frame":
            return read_raw(spark, f"{escaped}/day=1")
        return f"{escaped}/*" if source == "glob" else f"{escaped}/day=1"

    run = lambda: run_pipeline(spark, given(), base, resume=True)
    assert run().skipped == [] and run().skipped == ["bronze", "silver", "gold"]
    folder_time = os.stat(_local(landing)).st_mtime_ns
    _land(f"{landing}/day=1", "a.csv", HEADER + _row(1, 9))
    os.utime(_local(file), ns=(10**18, 10**18))
    assert os.stat(_local(landing)).st_mtime_ns == folder_time
    again = run()
    assert again.skipped == [] and [r.total_amount for r in read_layer(spark, again.paths["gold"]).collect()] == [9]


def test_kept_layers_report_their_counts(spark):
    root = scratch_path(spark, "counts")
    _land(f"{root}/landing", "a.csv", HEADER + _row(1) + _row(2, -1) + "x,y\n")
    first = run_pipeline(spark, f"{root}/landing", f"{root}/lake")
    again = run_pipeline(spark, f"{root}/landing", f"{root}/lake", resume=True)
    assert again.skipped == ["bronze", "silver", "gold"]
    assert (again.counts, again.rejects) == (first.counts, first.rejects)
    assert first.counts == {"bronze": 2, "after_order_id": 2, "after_amount": 1, "silver": 1, "gold": 1, "malformed": 1}
    later = run_pipeline(spark, None, f"{root}/lake", start_at="gold")
    assert later.counts == first.counts


def test_of_two_writers_one_fails_and_leaves_nothing(spark):
    path = scratch_path(spark, "race")
    write_layer(spark.range(1), path)

    def slower():  # another writer finishes while this one is at work
        write_layer(spark.range(2), path)
        return {}

    with pytest.raises(ConcurrentWriteError):
        write_layer(spark.range(3), path, counts=slower)
    assert read_layer(spark, path).count() == 2
    assert len([x for x in os.listdir(_local(path)) if x.startswith("build-")]) == 2


def test_killed_writes_leave_nothing_after_the_next(spark):
    path = scratch_path(spark, "killed")
    first = write_layer(spark.range(1), path)
    spark.range(5).write.parquet(f"{path}/build-00000002-abandoned")  # died before its pointer
    open(f"{_local(path)}/_builds/00000003.json", "w").close()  # died while it wrote the pointer
    assert current_build(spark, path).id == first.id and read_layer(spark, path).count() == 1
    last = write_layer(spark.range(4), path)
    assert last.number == 4 and last.previous == first.id and read_layer(spark, path).count() == 4
    builds = sorted(x for x in os.listdir(_local(path)) if x.startswith("build-"))
    assert builds == sorted([first.id, last.id])


def test_snapshot_readers_see_one_run(spark):
    root = scratch_path(spark, "snapshot")
    lake = f"{root}/lake"
    frames = lambda n: {"bronze": spark.range(n), "silver": spark.range(n), "gold": spark.range(n)}
    publish_layers(frames(1), lake)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):  # a second publish ends after two layers
        publish_layers(frames(2) | {"gold": spark.range(2).selectExpr("1 div id AS id")}, lake)
    sizes = lambda: {layer: df.count() for layer, df in read_snapshot(spark, lake).items()}
    write_layer(spark.range(7), f"{lake}/bronze/orders")
    write_layer(spark.range(8), f"{lake}/bronze/orders")
    assert set(sizes().values()) == {1}
    publish_layers(frames(3), lake)
    assert set(sizes().values()) == {3}


def test_pipeline_takes_a_snapshot_of_each_run(spark):
    root = scratch_path(spark, "runs")
    _land(f"{root}/landing", "a.csv", HEADER + _row(1))
    run_pipeline(spark, f"{root}/landing", f"{root}/lake")
    before = {layer: sorted(map(tuple, df.collect())) for layer, df in read_snapshot(spark, f"{root}/lake").items()}
    _land(f"{root}/landing", "b.csv", HEADER + _row(2))
    run_pipeline(spark, f"{root}/landing", f"{root}/lake", resume=True, stop_after="silver")
    during = {layer: sorted(map(tuple, df.collect())) for layer, df in read_snapshot(spark, f"{root}/lake").items()}
    assert during == before
    run_pipeline(spark, f"{root}/landing", f"{root}/lake", resume=True)
    after = read_snapshot(spark, f"{root}/lake")
    assert (after["bronze"].count(), after["gold"].first().total_orders) == (2, 2)


def test_raw_text_is_scanned_once(spark, monkeypatch):
    from strata.plans import pipeline

    root = scratch_path(spark, "once")
    _land(f"{root}/landing", "a.csv", HEADER + _row(1) + "1,2\n" + "1,2,3,4,5,6,7\n")
    scans = []
    real = pipeline.read_lines
    monkeypatch.setattr(pipeline, "read_lines", lambda *a: scans.append(a) or real(*a))
    written = []
    write = pipeline.write_layer
    monkeypatch.setattr(pipeline, "write_layer", lambda df, *a, **k: written.append(df) or write(df, *a, **k))
    result = run_pipeline(spark, f"{root}/landing", f"{root}/lake", stop_after="bronze")
    assert len(scans) == len(written) == 1
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert read_layer(spark, result.paths["bronze"]).count() == 1
    assert sorted(r.malformed_line for r in read_malformed_lines(spark, result.paths["bronze"]).collect()) == ["1,2", "1,2,3,4,5,6,7"]
    plan = read_malformed_lines(spark, result.paths["bronze"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_incremental_base_keeps_malformed_lines_once(spark):
    root = scratch_path(spark, "stream-lines")
    _land(f"{root}/landing", "a.csv", HEADER + _row(1) + "short\n")
    first = run_incremental(spark, f"{root}/landing", f"{root}/lake")
    assert first.malformed == 1 and first.counts["silver"] == 1
    _land(f"{root}/landing", "b.csv", HEADER + _row(2) + "1,2,3,4,5,6,long\n")
    second = run_incremental(spark, f"{root}/landing", f"{root}/lake")
    again = run_incremental(spark, f"{root}/landing", f"{root}/lake")
    assert second.malformed == again.malformed == 2 and second.counts["bronze"] == 1
    assert sorted(r.malformed_line for r in read_malformed_lines(spark, again.bronze).collect()) == ["1,2,3,4,5,6,long", "short"]
    assert read_layer(spark, again.bronze).count() == 2
    assert sum(r.total_orders for r in read_layer(spark, again.gold).collect()) == 2
