"""Mined hard negatives against brute force over all pairs."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from strata.llm import hard_negatives
from tests.conftest import SF001

SCHEMA = "vec_id long, embedding array<float>, label int, part string, block string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, b, "p", "b", 1) for i, v, b in rows], SCHEMA)


def brute(rows, every=50):
    rows = [
        (i, [math.floor(256 * float(np.float32(c))) for c in v], b)
        for i, v, b in rows
        if i is not None and b is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    dot = lambda p, q: sum(x * y for x, y in zip(p, q, strict=False))
    out = []
    for a, (i, v, b) in enumerate(rows):
        if i % every:
            continue
        scored = sorted(((-dot(v, w), j, c == b) for k, (j, w, c) in enumerate(rows) if k != a))
        for p, j, _ in [s for s in scored if s[2]][:5]:
            near = [s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(i, j, k, m, -p, -n) for k, (n, m, _) in enumerate(near[:3], 1)]
    return sorted(out)


def clustered(n, d, seed, labels=4, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, d))
    at = draw.integers(0, 6, n)
    vectors = np.round(centres[at] + spread * draw.normal(size=(n, d)), 3)
    return [(i, v, int(b)) for i, v, b in zip(range(n), vectors.tolist(), draw.integers(0, labels, n), strict=True)]


@pytest.mark.parametrize(("n", "d", "spread"), [(700, 3, 0.02), (500, 8, 0.5)])
def test_equals_brute_force(spark, monkeypatch, n, d, spread):
    rows = clustered(n, d, n, spread=spread)
    rows += [(n + k, rows[50][1], k % 4) for k in range(200)]  # one very common vector
    rows += rows[:60]  # repeated rows, anchors among them
    for block, part in ((512, 1 << 18), (7, 64)):
        monkeypatch.setattr(hard_negatives, "BLOCK", block)
        monkeypatch.setattr(hard_negatives, "PART_ROWS", part)
        got = hard_negatives.mined(frame(spark, rows).repartition(3)).collect()
        assert sorted(map(tuple, got)) == brute(rows)


def test_table_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    got = hard_negatives.mined(hard_negatives.relabelled(spark.read.parquet(f"{SF001}/embeddings.parquet"))).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(hard_negatives.ORACLE_SQL).fetchall())


def test_zone_maps_keep_blocks_unread(spark, monkeypatch):
    rows = clustered(3000, 3, 5, spread=0.01)
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    index = hard_negatives.Index(frame(spark, rows), "vec_id", "label", "embedding")
    groups = index.anchors(50)
    plan = index.met(
        index.blocks.drop("uids", "ids", "xs"),
        hard_negatives.saved(index.met(index.blocks, groups, hard_negatives.search_home), "t"),
        hard_negatives.plan_part,
    )
    blocks, asked = index.blocks.count(), sum(len(r.wanted) for r in plan.collect())
    assert asked < 0.3 * groups.count() * blocks / index.parts


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_the_curve_visits_neighbours(bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * 3), axis=-1).reshape(-1, 3)
    keys = hard_negatives.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(keys)), key=keys.__getitem__)].astype(int)
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_defined_cases(spark):
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.8], 2), (3, [0.8, 0.0, 0.0], 2), (None, [0.8, 0.0], 2), (5, None, 2),
        (6, [0.8, None], 2), (7, [float("nan"), 0.0], 2), (8, [float("inf"), 0.0], 2), (9, [0.8, 0.0], None), (50, [-1.0, 0.0], 1),
        (100, [0.0, 0.0], 3), (101, [0.0, 0.0], 3),
    ]
    got = sorted(map(tuple, hard_negatives.mined(frame(spark, rows)).collect()))
    pad = [(i, None if v is None else [*v, 0.0, 0.0][:3], b) for i, v, b in rows]
    assert got == brute(pad) and {(0, 1, 1, 2), (0, 1, 2, 3)} <= {r[:4] for r in got}
    for empty in ([], [(0, None, 1)], [(1, [1.0], 1)], [(0, [], 1), (1, [], 2)]):
        assert hard_negatives.mined(frame(spark, empty)).count() == 0
    large = [(0, [3e9, 1.0], 1), (1, [2.9e9, 0.0], 1), (2, [1.5e9, 7.0], 2)]  # scores beyond doubles' exact integers
    with pytest.raises(Exception, match="beyond 64 bits"):
        hard_negatives.mined(frame(spark, large)).collect()
    large = [(i, [c / 1000 for c in v], b) for i, v, b in large]
    assert sorted(map(tuple, hard_negatives.mined(frame(spark, large)).collect())) == brute(large)
