"""The command line runs end to end: once in its own process, else in this one."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

from strata.__main__ import main

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _own_process(*args: str) -> dict:
    out = subprocess.run(
        [sys.executable, "-m", "strata", "--master", "local[2]", *args],
        cwd=ROOT, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()[-1]
    return json.loads(out)


@pytest.fixture()
def _run(spark, capsys):
    def run(*args: str) -> dict:
        assert main(list(args)) == 0
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    return run


def test_generate_pipeline_and_summaries(tmp_path, _run):
    raw = str(tmp_path / "landing")
    _run("generate", "--rows", "2500", "--out", raw)
    res = _run("pipeline", "--source", raw, "--base", str(tmp_path / "lake"), "--export-gold", str(tmp_path / "gold.csv"))
    counts = res["counts"]
    assert counts["bronze"] == 2500 and counts["gold"] == 5
    assert counts["bronze"] == counts["silver"] + sum(res["rejects"].values())
    with open(tmp_path / "gold.csv") as f:
        lines = f.read().splitlines()
    assert lines[0] == "province,total_orders,total_amount,success_orders,failed_orders" and len(lines) == 6
    again = _run("pipeline", "--source", raw, "--base", str(tmp_path / "lake"), "--resume")
    assert again["skipped"] == ["bronze", "silver", "gold"]

    clean = str(tmp_path / "clean")
    _run("generate", "--rows", "500", "--out", clean, "--clean")
    written = _run("summaries", "--orders", clean, "--out", str(tmp_path / "out"))
    with open(written["by_province_all_sql"]) as f:
        rows = f.read().splitlines()[1:]
    assert sum(int(r.split(",")[1]) for r in rows) == 500


def test_sample_and_layer_csv_exports(tmp_path, _run):
    out = _own_process("sample", "--out", str(tmp_path / "sample"))
    with open(out["by_province"]) as f:
        assert f.read().splitlines() == [
            "province,total_orders,total_amount", "Lao Cai,2,3000095500", ",1,610000", "Ben Tre,1,331000", "Nghe An,1,12250",
        ]
    with open(out["success"]) as f:
        assert len(f.read().splitlines()) == 6

    raw = str(tmp_path / "landing")
    _run("generate", "--rows", "800", "--out", raw)
    res = _run("pipeline", "--source", raw, "--base", str(tmp_path / "lake"), "--export-csv", str(tmp_path / "csv"))
    assert sorted(res["csv"]) == ["bronze", "gold", "silver"]
    parts = [p for p in os.listdir(res["csv"]["silver"]) if p.startswith("part-")]
    n = sum(len(open(os.path.join(res["csv"]["silver"], p)).read().splitlines()) - 1 for p in parts)
    assert n == res["counts"]["silver"]
    with open(res["csv"]["gold"]) as f:
        assert len(f.read().splitlines()) == 6


def test_incremental_command(tmp_path, _run):
    landing = str(tmp_path / "landing")
    _run("generate", "--rows", "1200", "--out", landing)
    first = _run("incremental", "--landing", landing, "--base", str(tmp_path / "lake"), "--archive", str(tmp_path / "archive"))
    assert first["counts"]["bronze"] == 1200
    assert first["counts"]["silver"] + sum(first["rejects"].values()) == 1200
    earlier = sorted(f for f in os.listdir(landing) if f.endswith(".csv"))
    with open(os.path.join(landing, "late.csv"), "w") as f:
        f.write("order_id,customer_id,province,amount,status,order_date\n9999,CUS001,Hanoi,5,SUCCESS,2026-01-01\n")
    second = _run("incremental", "--landing", landing, "--base", str(tmp_path / "lake"), "--archive", str(tmp_path / "archive"))
    assert second["counts"]["bronze"] == 1  # only the new file
    # the first run's files were moved out when this run's batch committed
    assert not set(earlier) & set(os.listdir(landing))
