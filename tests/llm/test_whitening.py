"""Whitening against plain numpy and exact fractions."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from strata.llm import whitening
from tests.conftest import SF001

SCHEMA = "vec_id long, embedding array<float>, component string, n string, x int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, "c", "n", 1) for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def by_row(rows):
    out = {}
    for r in rows:
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def integers(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


@pytest.mark.parametrize("d", [1, 2, 3, 7])
def test_polynomial_and_roots(spark, d):
    draw = np.random.default_rng(d)
    m = draw.integers(-9, 9, (d, d + 2))
    cells = (m @ m.T).tolist()
    found = whitening.Scatter(5, [0] * d, cells)
    got = whitening.characteristic_polynomial(spark, found)
    # Faddeev-LeVerrier over fractions
    a = [[Fraction(v) for v in row] for row in cells]
    mul = lambda p, q: [[sum(p[i][k] * q[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
    c, mk = [Fraction(0)] * d + [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        mk = [[x + (c[d - k + 1] if i == j else 0) for j, x in enumerate(row)] for i, row in enumerate(mul(a, mk))]
        c[d - k] = -sum(mul(a, mk)[i][i] for i in range(d)) / k
    assert got == c
    roots = [float(Fraction(r, 1 << whitening.FRACTION)) for r, n in whitening.largest_roots(got, d) for _ in range(n)]
    assert roots == pytest.approx(sorted(np.linalg.eigvalsh(np.array(cells, float)))[::-1], rel=1e-9)


def test_hessenberg_keeps_the_polynomial_with_zero_pivots():
    p = 10_007
    for a in ([[0, 0, 1], [0, 0, 0], [1, 0, 0]], [[1, 2, 3], [0, 4, 5], [7, 0, 6]], [[0] * 4] * 4):
        a = np.array(a, dtype=np.int64)
        want = np.poly(a.astype(float)).round().astype(int)[::-1] % p
        assert whitening.polynomial_modulo(a, p).tolist() == want.tolist()


def test_repeated_and_near_roots():
    one = 1 << whitening.FRACTION
    poly = [1]
    for root in (0, 5, 5, 5, 10**30, 10**30 + 1):
        poly = [b - root * a for a, b in zip([*poly, 0], [0, *poly], strict=True)]
    assert whitening.largest_roots(poly, 6) == [((10**30 + 1) * one, 1), (10**30 * one, 1), (5 * one, 3)]
    got = np.array(whitening.null_vectors([[5, 0, 0], [0, 7, 0], [0, 0, 5]], 5 * one, 2))
    assert np.allclose(got @ got.T, np.eye(2), atol=1e-15) and np.allclose(got[:, 1], 0)


def test_vectors_of_close_eigenvalues_are_exact():
    # eigenvalues 10**20 and 10**20 + 2: doubles cannot tell the matrix from a multiple of I
    cells = [[10**20 + 1, 1], [1, 10**20 + 1]]
    root = (10**20 + 2) << whitening.FRACTION
    assert whitening.null_vectors(cells, root, 1)[0] == pytest.approx([math.sqrt(0.5)] * 2, abs=1e-15)


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    got = by_row(whitening.whitened(table.repartition(3)).collect())
    rows = {r.vec_id: r.embedding for r in table.collect()}
    x = np.array(integers(rows.values()), dtype=object)
    n, sums = len(x), x.sum(axis=0)
    y = (x - sums[0] // n).astype(float)
    y -= y.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = y @ vectors / np.sqrt(values)
    assert set(got) == set(rows)
    mine = np.array([[got[i][k].whitened for k in range(1, 33)] for i in rows])
    signs = np.sign((mine * z[:, :32]).sum(axis=0))
    assert np.abs(mine * signs - z[:, :32]).max() < 1e-7
    for row, i in enumerate(rows):
        r = got[i][7]
        assert r.n == n and r.deviation == int(sum((n * x[row] - sums) ** 2)) == r.deviation_exact
        assert r.explained == pytest.approx(values[6] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9


def test_defined_cases(spark):
    good = [[1.0, 2.0, 3.0], [2.0, 2.0, 3.5], [4.0, -2.0], [4.0, -2.0], [1e6, 0.0, 1.0]]
    bad = [None, [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 0.0]]
    got = whitening.whitened(frame(spark, good + bad, [1, 2, None, None, 5, 6, 7, 8, 9])).collect()
    assert len(got) == 15 and {r.n for r in got} == {5}
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted((i, k) for i in (1, 2, 0, 0, 5) for k in (1, 2, 3))
    assert max(r.identity_error for r in got) < 1e-9
    # one distinct vector: no variance
    got = whitening.whitened(frame(spark, [[1.0, 2.0]] * 3)).collect()
    assert {(r.whitened, r.explained, r.identity_error, r.deviation) for r in got} == {(None, None, 0.0, 0)}
    # two distinct vectors: one component with variance
    got = by_row(whitening.whitened(frame(spark, [[0.0, 0.0], [3.0, 4.0]])).collect())
    assert abs(got[0][1].whitened) == pytest.approx(1) and got[0][1].explained == 1
    assert got[0][2].whitened is None and got[0][2].explained == 0
    # beyond a long
    got = whitening.whitened(frame(spark, [[0.0], [1e10], [2e10]])).collect()
    assert {r.deviation for r in got} == {None, 0} and all(abs(r.whitened) < 2 for r in got)
    assert {int(r.deviation_exact) for r in got} == {0, (3 * 64 * 10**10) ** 2}
    for empty in ([], [None]):
        assert whitening.whitened(frame(spark, empty)).count() == 0


def test_component_number_is_a_parameter(spark):
    draw = np.random.default_rng(1)
    rows = draw.normal(size=(60, 5)).tolist()
    got = whitening.whitened(frame(spark, rows), components=2).collect()
    assert len(got) == 120 and {r.component for r in got} == {1, 2}
