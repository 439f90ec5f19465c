"""Embedding whitening from the exact characteristic polynomial of the scatter.

Entries become integers, so sums and cross products are exact. Tasks add up their
own rows; Spark adds the tasks' cells (as limbs of LIMB bits, so no sum overflows).
With n vectors of sums S the matrix A = n * sum(x x^T) - S S^T is n^2 times the
covariance, in integers. From there on only d x d numbers are handled:

1. A's characteristic polynomial modulo many primes, one task for some primes each:
   reduction to Hessenberg form, then the recurrence of its leading minors. Chinese
   remaindering gives the integer coefficients (their size is bounded by the trace).
2. All roots are real and none is negative, so the sign changes of the polynomial
   shifted to a point count the roots above it exactly. Bisection isolates the
   largest roots and narrows each to 2**-FRACTION (A's own roots are integers' size).
3. Components: inverse iteration on A - root * I in fixed point, one task per distinct
   root; a root of multiplicity m gets m vectors, made orthogonal.

A vector is projected after subtracting the mean. ``identity_error`` is measured on
the whitened rows themselves, in a pass of its own.

Cases: rows with a null vector or null or non-finite entries are dropped; null and
repeated ids are kept as rows; vectors shorter than the longest are filled up with
entries 0; with an eigenvalue 0 (fewer distinct vectors than entries) ``whitened`` is
null and ``explained`` 0, and the component is left out of ``identity_error``; without
any variance ``explained`` is null; a ``deviation`` beyond a long is null and stands in
``deviation_exact`` alone; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import isqrt, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.vectors import integer_entries, largest, matrix, product, usable, widest

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
LIMB = 40  # bits; sums of fewer than 2**22 tasks' limbs fit a long
LIMBS = 6
FRACTION = 160  # bits of a root after the binary point
PRIME_BITS = 31  # a product of two residues fits a long
SLICE = 2048  # vectors expanded to component rows at a time

WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double, deviation_exact decimal(38,0)"
)


@dataclass(frozen=True)
class Scatter:
    """Exact moments of the fit list; ``sums`` and ``cells`` are of entries less SHIFT,
    which changes no difference from the mean."""

    n: int
    sums: list[int]
    cells: list[list[int]]  # n * sum(x x^T) - S S^T

    @property
    def trace(self) -> int:
        return sum(self.cells[i][i] for i in range(len(self.sums)))


def integer_rows(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): usable vectors as integers, less SHIFT."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("v")).where(usable(F.col("v")))
    return rows.select("vec_id", integer_entries(F.col("v"), SCALE).alias("x"))


def _limbs(value: int) -> list[int]:
    """value as LIMBS signed digits to the base 2**LIMB; the last takes the rest."""
    out = []
    for _ in range(LIMBS - 1):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                x = matrix(batch.column(0).slice(lo, SLICE), width)
                exact = x if largest(x) < 2**50 else x.astype(object)
                n, sums, squares = n + len(x), sums + exact.sum(axis=0), squares + product(np.ascontiguousarray(x.T), x)
        if n:
            cells = [n, *sums.tolist(), *[squares[i, j] for i in range(width) for j in range(i, width)]]
            limbs = np.array([_limbs(int(v)) for v in cells], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(cells))), *[pa.array(limbs[:, k].copy()) for k in range(LIMBS)]],
                names=["cell", *[f"l{k}" for k in range(LIMBS)]],
            )

    return run


def scatter(rows: DataFrame) -> Scatter | None:
    """Exact moments of ``x``; None without rows. Only the cells' sums, about half
    the square of the vectors' width in number, come to the driver."""
    width = widest(rows, "x")
    names = [f"l{k}" for k in range(LIMBS)]
    parts = rows.select("x").mapInArrow(_moments(width), "cell long, " + ", ".join(f"{k} long" for k in names))
    found = parts.groupBy("cell").agg(*[F.sum(k).alias(k) for k in names]).collect()
    if not found:
        return None
    values = {r.cell: sum(r[k + 1] << (LIMB * k) for k in range(LIMBS)) for r in found}
    n, sums = values[0], [values[1 + i] for i in range(width)]
    cells, at = [[0] * width for _ in range(width)], 1 + width
    for i in range(width):
        for j in range(i, width):
            cells[i][j] = cells[j][i] = n * values[at] - sums[i] * sums[j]
            at += 1
    return Scatter(n, sums, cells)


# --- characteristic polynomial -------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 2**32."""
    if n < 2 or n % 2 == 0:
        return n == 2
    d, twos = n - 1, 0
    while d % 2 == 0:
        d, twos = d // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if base % n and x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes(bits: float) -> list[int]:
    """Primes below 2**PRIME_BITS, largest first, whose product has ``bits`` bits at least."""
    found, candidate, have = [], 1 << PRIME_BITS, 0.0
    while have <= bits:
        candidate -= 1
        if is_prime(candidate):
            found.append(candidate)
            have += log2(candidate)
    return found


def hessenberg_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo p with zeros below its subdiagonal."""
    h, d = a.copy(), len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            h[[m, i]] = h[[i, m]]
            h[:, [m, i]] = h[:, [i, m]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor % p).sum(axis=1)) % p
    return h


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (constant first) of det(x I - a) modulo p."""
    h, d = hessenberg_modulo(a, p), len(a)
    minors = np.zeros((d + 1, d + 1), dtype=np.int64)  # row k: polynomial of the leading k x k block
    minors[0, 0] = 1
    for k in range(1, d + 1):
        weight = np.zeros(k, dtype=np.int64)  # of minors 0 to k - 1
        below = 1
        for i in range(k - 1, -1, -1):
            weight[i] = h[i, k - 1] * below % p
            if i:
                below = below * int(h[i, i - 1]) % p
                if not below:
                    break
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - (weight[:, None] * minors[:k] % p).sum(axis=0)) % p
    return minors[d]


def characteristic_polynomial(spark: SparkSession, found: Scatter) -> list[int]:
    """Integer coefficients, constant first; residues are worked out in tasks."""
    d = len(found.sums)
    # elementary symmetric functions of d non-negative roots of sum t are at most (1 + t / d) ** d
    moduli = primes(d * log2(1 + found.trace // max(1, d) + 1) + 2)
    cells = [[str(v) for v in row] for row in found.cells]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array([[int(v) for v in row] for row in cells], dtype=object).reshape(d, d)
        for batch in batches:
            own = batch.column(0).to_pylist()
            residues = [polynomial_modulo((exact % p).astype(np.int64), p).tolist() for p in own]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(residues, pa.list_(pa.int64()))], names=["p", "residues"])

    tasks = min(len(moduli), spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks)
    rows = dealt.mapInArrow(run, "p long, residues array<long>").collect()
    modulus = 1
    for r in rows:
        modulus *= r.p
    out = [0] * (d + 1)
    for r in rows:
        rest = modulus // r.p
        unit = rest * pow(rest, -1, r.p)
        out = [c + unit * x for c, x in zip(out, r.residues, strict=True)]
    out = [c % modulus for c in out]
    return [c - modulus if c > modulus // 2 else c for c in out]


# --- roots ---------------------------------------------------------------------


def roots_above(coefficients: list[int], point: int) -> int:
    """Roots above ``point``, by multiplicity, of a polynomial with real roots only:
    the sign changes of its coefficients around that point."""
    c = list(coefficients)
    d = len(c) - 1
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += point * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def value_at(coefficients: list[int], point: int) -> int:
    total = 0
    for c in reversed(coefficients):
        total = total * point + c
    return total


def largest_roots(coefficients: list[int], most: int) -> list[tuple[int, int]]:
    """(root * 2**FRACTION, multiplicity), falling, of the ``most`` largest positive
    roots (by multiplicity; the last may go beyond). The polynomial is monic with real,
    non-negative roots; roots closer than 2**-FRACTION count as one."""
    zeros = next(i for i, c in enumerate(coefficients) if c)
    c = coefficients[zeros:]
    d = len(c) - 1
    scaled = [x << (FRACTION * (d - i)) for i, x in enumerate(c)]
    top = -scaled[d - 1] + 1 if d else 0  # the sum of all roots
    found: list[tuple[int, int]] = []
    spans = [(0, top, d, 0)] if d else []  # (low, high, roots above low, roots above high)
    while spans and sum(m for _, m in found) < most:
        low, high, above_low, above_high = spans.pop()
        if above_low - above_high == 1:
            found.append((narrowed(scaled, low, high), 1))
        elif high - low <= 1:
            found.append((high, above_low - above_high))
        else:
            middle = (low + high) // 2
            above = roots_above(scaled, middle)
            spans += [s for s in ((low, middle, above_low, above), (middle, high, above, above_high)) if s[2] > s[3]]
    return found


def narrowed(coefficients: list[int], low: int, high: int) -> int:
    """The one simple root in (low, high], rounded up."""
    at_high = value_at(coefficients, high)
    if at_high == 0:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        value = value_at(coefficients, middle)
        if value == 0:
            return middle
        low, high = (low, middle) if (value > 0) == (at_high > 0) else (middle, high)
    return high


# --- components ----------------------------------------------------------------


def null_vectors(cells: list[list[int]], root: int, multiplicity: int) -> list[list[float]]:
    """Orthonormal eigenvectors of the integer matrix for root / 2**FRACTION."""
    d, one = len(cells), 1 << FRACTION
    m = [[(v << FRACTION) - (root if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(cells)]
    factors, swaps = [], []
    for k in range(d):  # elimination with row exchanges, kept for several right sides
        i = max(range(k, d), key=lambda r: abs(m[r][k]))
        m[k], m[i] = m[i], m[k]
        swaps.append(i)
        if m[k][k] == 0:
            m[k][k] = 1
        own = []
        for r in range(k + 1, d):
            f = (m[r][k] << FRACTION) // m[k][k]
            own.append(f)
            if f:
                m[r] = m[r][: k + 1] + [x - (f * y >> FRACTION) for x, y in zip(m[r][k + 1 :], m[k][k + 1 :], strict=True)]
        factors.append(own)

    def solved(b: list[int]) -> list[int]:
        b = list(b)
        for k in range(d):
            b[k], b[swaps[k]] = b[swaps[k]], b[k]
            for r, f in enumerate(factors[k], k + 1):
                b[r] -= f * b[k] >> FRACTION
        for k in range(d - 1, -1, -1):
            rest = b[k] - (sum(m[k][j] * b[j] for j in range(k + 1, d)) >> FRACTION)
            b[k] = (rest << FRACTION) // m[k][k]
        return b

    def unit(v: list[int]) -> list[int]:
        size = isqrt(sum(x * x for x in v))
        return [(x << FRACTION) // size for x in v]

    def across(v: list[int]) -> list[int]:
        for u in found:
            dot = sum(x * y for x, y in zip(u, v, strict=True)) >> FRACTION
            v = [y - (dot * x >> FRACTION) for x, y in zip(u, v, strict=True)]
        return v

    found: list[list[int]] = []
    draws = np.random.default_rng(d)
    for _ in range(multiplicity):
        v = [int(x) * one for x in draws.integers(1, 1000, d)]
        for _ in range(3):
            v = unit(across(unit(solved(v))))
        found.append(v)
    out = []
    for v in found:
        sign = -1 if max(v, key=abs) < 0 else 1
        out.append([sign * (x / one) for x in v])
    return out


@dataclass(frozen=True)
class Whitening:
    """What a task needs to whiten rows: bounded by the square of the vectors' width."""

    n: int
    sums: list[int]
    mean: np.ndarray
    vectors: np.ndarray  # a row per component
    eigenvalues: np.ndarray
    explained: list[float | None]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows by components; components without variance are NaN."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return (x - self.mean) @ self.vectors.T / np.sqrt(np.where(self.eigenvalues > 0, self.eigenvalues, np.nan))

    def deviations(self, x: np.ndarray) -> list[int] | np.ndarray:
        """Exact sum over entries of (n * x - S)^2."""
        bound = self.n * largest(x) + max((abs(s) for s in self.sums), default=0)
        if bound * bound * max(1, x.shape[1]) < 2**63:
            off = self.n * x - np.array(self.sums, dtype=np.int64)
            return (off * off).sum(axis=1)
        off = self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return [int(v) for v in (off * off).sum(axis=1)]


def fitted(spark: SparkSession, found: Scatter, components: int = COMPONENTS) -> Whitening:
    """Mean, largest eigenvalues and unit eigenvectors of the fit list's covariance."""
    d = len(found.sums)
    roots = largest_roots(characteristic_polynomial(spark, found), components)
    cells = [[str(v) for v in row] for row in found.cells]
    order = [(i, str(root), m) for i, (root, m) in enumerate(roots)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = [[int(v) for v in row] for row in cells]
        for batch in batches:
            for i, root, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * m), pa.array(null_vectors(exact, int(root), m), pa.list_(pa.float64()))], names=["i", "v"]
                )

    rows = []
    if order:
        dealt = spark.createDataFrame(order, "i long, root string, m long")
        dealt = dealt.repartition(min(len(order), spark.sparkContext.defaultParallelism))
        rows = sorted(dealt.mapInArrow(run, "i long, v array<double>").collect(), key=lambda r: r.i)[:components]
    scale = found.n * found.n << FRACTION
    exact = [roots[r.i][0] for r in rows]
    count = min(components, d)
    vectors = np.zeros((count, d))
    vectors[: len(rows)] = np.array([r.v for r in rows]).reshape(len(rows), d)
    eigenvalues = np.zeros(count)
    eigenvalues[: len(rows)] = [float(Fraction(e, scale)) for e in exact]
    whole = found.trace << FRACTION
    explained = [float(Fraction(e, whole)) for e in exact] + [0.0 if whole else None] * (count - len(exact))
    mean = np.array([float(Fraction(s, found.n)) for s in found.sums])
    return Whitening(found.n, found.sums, mean, vectors, eigenvalues, explained)


def identity_error(rows: DataFrame, by: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    live = np.flatnonzero(by.eigenvalues > 0)
    width = by.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(live), len(live)))
        for batch in batches:
            z = by.project(matrix(batch.column(0), width))[:, live]
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "v"])

    if not len(live):
        return 0.0
    sums = rows.select("x").mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    covariance = np.zeros(len(live) ** 2)
    covariance[[r.cell for r in sums]] = [r.v / by.n for r in sums]
    return float(np.abs(covariance.reshape(len(live), -1) - np.eye(len(live))).max())


def whitened(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per usable vector and component (see the module's text)."""
    spark = embeddings.sparkSession
    rows = integer_rows(embeddings, id_col, vector_col)
    found = scatter(rows)
    if found is None:
        return spark.createDataFrame([], WHITENED)
    by = fitted(spark, found, components)
    error, width, count = identity_error(rows, by), len(found.sums), len(by.eigenvalues)
    explained = pa.array(by.explained, pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                x, n = matrix(part.column(1), width), part.num_rows
                deviation = by.deviations(x)
                fits = [v if v < 2**63 else None for v in deviation] if isinstance(deviation, list) else deviation
                row = pa.array(np.repeat(np.arange(n), count))
                column = np.tile(np.arange(count), n)
                exact = pa.array(deviation, pa.decimal128(38)) if isinstance(deviation, list) else pa.array(deviation).cast(pa.decimal128(38))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), pa.array((column + 1).astype(np.int32)), pa.array(np.full(n * count, by.n)),
                     pa.array(fits, pa.int64()).take(row), pa.array(by.project(x).ravel(), from_pandas=True),
                     explained.take(pa.array(column)), pa.array(np.full(n * count, error)), exact.take(row)],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
                )

    return rows.mapInArrow(run, WHITENED)
