"""Deterministic pseudo-random draws keyed by (seed, row id, slot).

A draw is a pure function of the row id, so generated data does not depend
on partitioning, task order or retries (``rand(seed)`` does: it changes with
the partition count). Each row gets ``md5(seed:group:id)`` digests; a digest
is cut into 32-bit words, and a slot takes a whole word (32-bit draw) or half
of one (16-bit draw, enough for small domains and weights). ``md5`` is a
built-in of both Spark SQL and DuckDB with the same hex output, so the same
expression templates render in either dialect and a generated table can be
checked row for row against an independent engine.

Each digest references the id once and each draw references one word, so the
optimizer can push filters through generated columns without the expression
growing; the hex-to-integer conversion is the costly part, hence the packing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

WORDS_PER_DIGEST = 4  # 128-bit digest = four 32-bit words


@dataclass(frozen=True)
class Dialect:
    """How a few operators are spelled in one SQL dialect."""

    name: str
    string_type: str

    def hex32(self, hex_text: str) -> str:
        """8 hex digits -> BIGINT."""
        if self.name == "spark":
            return f"CAST(conv({hex_text}, 16, 10) AS BIGINT)"
        return f"CAST(('0x' || {hex_text}) AS BIGINT)"

    def high16(self, word: str) -> str:
        return f"shiftright({word}, 16)" if self.name == "spark" else f"({word} >> 16)"

    def add_days(self, date_literal: str, days: str) -> str:
        if self.name == "spark":
            return f"date_add(DATE '{date_literal}', CAST({days} AS INT))"
        return f"(DATE '{date_literal}' + CAST({days} AS INTEGER))"

    def to_text(self, expr: str) -> str:
        return f"CAST({expr} AS {self.string_type})"


SPARK = Dialect("spark", "STRING")
DUCKDB = Dialect("duckdb", "VARCHAR")


def _layout(slots: dict[str, int]) -> list[tuple[str, int, str]]:
    """(slot, word index, part) with part 'all', 'lo' or 'hi'; 16-bit slots pair up."""
    out, word, half_open = [], 0, None
    for name, bits in slots.items():
        if bits == 32:
            out.append((name, word, "all"))
            word += 1
        elif bits == 16:
            if half_open is None:
                half_open = word
                out.append((name, word, "lo"))
                word += 1
            else:
                out.append((name, half_open, "hi"))
                half_open = None
        else:
            raise ValueError(f"slot {name}: draws are 16 or 32 bits, not {bits}")
    return out


def hash_stages(d: Dialect, id_col: str, seed: int, slots: dict[str, int]) -> list[list[tuple[str, str]]]:
    """Projection stages: digests, 32-bit words, then one ``h_<slot>`` per slot."""
    layout = _layout(slots)
    n_words = max(w for _, w, _ in layout) + 1
    n_digests = (n_words + WORDS_PER_DIGEST - 1) // WORDS_PER_DIGEST
    digests = [
        (f"_md5_{g}", f"md5(concat('{int(seed)}:{g}:', {d.to_text(id_col)}))") for g in range(n_digests)
    ]
    words = [
        (f"_w{w}", d.hex32(f"substr(_md5_{w // WORDS_PER_DIGEST}, {1 + 8 * (w % WORDS_PER_DIGEST)}, 8)"))
        for w in range(n_words)
    ]
    parts = {"all": lambda w: w, "lo": lambda w: f"({w} & 65535)", "hi": d.high16}
    draws = [(f"h_{name}", parts[part](f"_w{w}")) for name, w, part in layout]
    return [digests, words, draws]


def with_hashes(df: DataFrame, id_col: str, seed: int, slots: dict[str, int]) -> DataFrame:
    """Spark: ``df`` plus ``h_<slot>`` (uniform on [0, 2^bits)) for every slot."""
    for stage in hash_stages(SPARK, id_col, seed, slots):
        df = df.selectExpr("*", *[f"{expr} AS {name}" for name, expr in stage])
    return df


def hashes_sql(source_sql: str, id_col: str, seed: int, slots: dict[str, int]) -> str:
    """DuckDB: the same hash columns over ``source_sql`` (nested projections)."""
    sql = source_sql
    for stage in hash_stages(DUCKDB, id_col, seed, slots):
        cols = ", ".join(f"{expr} AS {name}" for name, expr in stage)
        sql = f"SELECT *, {cols} FROM ({sql})"
    return sql


# --- draws over a hash column (dialect-neutral SQL text) ---------------------


def randint(h: str, lo: int, hi: int) -> str:
    """Uniform integer in [lo, hi]."""
    return f"({lo} + {h} % {hi - lo + 1})"


def uniform(h: str, lo: float, hi: float, bits: int = 32) -> str:
    """Uniform double in [lo, hi): ``lo + u * (hi - lo)`` with ``u = h / 2^bits``.

    Every operand is an explicit DOUBLE: a literal like ``4294967296.0`` is a
    DECIMAL in both SQL dialects, and decimal arithmetic rounds differently.
    """

    def dbl(x: float | str) -> str:
        return f"CAST({x} AS DOUBLE)"

    return f"({dbl(lo)} + ({dbl(h)} / {dbl(1 << bits)}) * {dbl(hi - lo)})"


def pick(h: str, values: list[str]) -> str:
    """Uniform choice among string literals."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {h} % {len(values)} {whens} END)"


def weighted(h: str, values: list[str], weights: list[float], bits: int = 16) -> str:
    """Choice with the given weights, by integer thresholds on a ``bits``-bit draw."""
    total = float(sum(weights))
    cum, whens = 0.0, []
    for v, w in zip(values[:-1], weights[:-1]):
        cum += w
        whens.append(f"WHEN {h} < {round(cum / total * (1 << bits))} THEN '{v}'")
    return f"(CASE {' '.join(whens)} ELSE '{values[-1]}' END)"


def below(h: str, p: float, bits: int = 16) -> str:
    """True with probability ``p`` (to ``2^-bits``)."""
    return f"({h} < {round(p * (1 << bits))})"
