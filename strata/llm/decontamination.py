"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of lower-cased words. Windows of
MIN_RUN words are hashed in one rolling pass (Karp-Rabin, by prefix sums) and joined; equal
windows that follow each other in both texts form the common runs of a document
and an item. The longest run is marked as a tile again and again, cut where its
words are already covered, until none of MIN_RUN words is left. An item is
found in a document when its tiles cover at least COVERAGE of its words, in
whatever order the document has them.

A bitmap of fixed size over the benchmark's window hashes (complete, whatever
the benchmark's size) drops almost all windows inside the scan; those that pass
are joined on the hash by Spark, which picks the join by size. Nothing else is
shuffled, and a document's text never is.

Cases: null or blank texts match nothing; items of fewer than MIN_RUN words
match nothing (too short to tell from chance); repeated documents and repeated
items are reported each; an empty benchmark or table gives an empty result;
texts are read whole; other columns pass through ``uncontaminated``.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from strata.llm.tables import free_name, numbered, saved
from strata.llm.words import mix, slices, split_words, text_buffer

MIN_RUN = 5
COVERAGE = 0.5
BITMAP_BITS = 22
SLICE_BYTES = 4 << 20
BASE = 0x9E3779B97F4A7C15  # odd


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``width`` words, whatever the width in
    constant work each: prefix sums of word * BASE**place modulo 2**64, where the
    difference of two is a window's sum, moved back to place 0 (BASE is odd, so
    it has an inverse). Words are 64-bit hashes and the sum is mixed at the end."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = np.full(len(words), BASE, np.uint64)
    back = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    power[0] = back[0] = 1
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * np.multiply.accumulate(power), out=sums[1:])
    return mix((sums[width:] - sums[:n]) * np.multiply.accumulate(back))


def _starts(hashes: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window hash, text, place in the text) of all windows inside one text."""
    rolled = _rolled(hashes, width)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    if not len(rolled):
        return rolled, text[:0], text[:0]
    inside = np.flatnonzero(text[: len(rolled)] == text[width - 1 :])
    owner = text[inside]
    return rolled[inside], owner, inside - at[owner]


def _windows(width: int, bitmap: np.ndarray | None):
    """(uid, id, n_words, seed, at) of each window (that the bitmap has)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column(0).to_numpy()
            data, offsets = text_buffer(batch.column(2))
            for lo, hi in slices(offsets, SLICE_BYTES):
                words, _, at = split_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                seed, owner, place = _starts(words, at, width)
                if bitmap is not None:
                    low = (seed & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
                    hit = np.flatnonzero(bitmap[low >> 3] >> (low & 7).astype(np.uint8) & 1)
                    seed, owner, place = seed[hit], owner[hit], place[hit]
                if len(seed):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(uid[lo:hi][owner]), batch.column(1).slice(lo, hi - lo).take(pa.array(owner)),
                         pa.array(np.diff(at)[owner]), pa.array(seed.view(np.int64)), pa.array(place)],
                        names=["uid", "id", "n_words", "seed", "at"],
                    )

    return run


_WINDOW = "uid long, id long, n_words long, seed long, at long"


def _rows(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return numbered(table, id_col, text_col).select(
        "uid", F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )


def tiles(hits: list[tuple[int, int]], width: int = MIN_RUN) -> list[tuple[int, int, int]]:
    """Greedy tiling from places of equal windows: hits are (place in the
    document, place in the item). Tiles are (document start, item start, words);
    of equally long runs, the first in the document and then in the item wins."""
    diagonals = defaultdict(list)
    for d, i in set(hits):
        diagonals[d - i].append(d)
    runs: list[tuple[int, int, int]] = []
    for shift, places in diagonals.items():
        places.sort()
        start = last = places[0]
        for d in [*places[1:], None]:
            if d is None or d != last + 1:
                runs.append((start - last - width, start, start - shift))
                start = d
            last = d
    heapq.heapify(runs)
    in_doc, in_item, found = set(), set(), []
    while runs:
        minus, d, i = heapq.heappop(runs)
        free = [k for k in range(-minus) if d + k not in in_doc and i + k not in in_item]
        if len(free) == -minus:
            found.append((d, i, -minus))
            in_doc.update(range(d, d - minus))
            in_item.update(range(i, i - minus))
            continue
        begin = 0
        for k in range(1, len(free) + 1):  # what is left of the run, in unbroken parts
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - begin >= width:
                    heapq.heappush(runs, (begin - k, d + free[begin], i + free[begin]))
                begin = k
    return found


_TILES = ArrayType(StructType([StructField(name, LongType()) for name in ("doc_at", "item_at", "words")]))


@F.pandas_udf(_TILES)
def _tiled(hits: pd.Series, width: pd.Series) -> pd.Series:
    return pd.Series(
        [
            [{"doc_at": d, "item_at": i, "words": n} for d, i, n in tiles([(h["d"], h["i"]) for h in own], int(w))]
            for own, w in zip(hits, width, strict=True)
        ],
        dtype=object,
    )


def _found(docs: DataFrame, benchmark: DataFrame, width: int, coverage: float, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    spark = docs.sparkSession
    items = saved(_rows(benchmark, item_col, item_text).mapInArrow(_windows(width, None), _WINDOW), "item-windows")
    items = items.select(
        "seed", F.col("uid").alias("item_uid"), F.col("id").alias("item_id"), F.col("n_words").alias("item_words"), F.col("at").alias("i")
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), dtype=np.uint8)
    low = items.select(F.col("seed").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).alias("low")).distinct().toArrow()["low"].to_numpy()
    np.bitwise_or.at(bitmap, low >> 3, np.left_shift(1, low & 7).astype(np.uint8))  # at most 2**BITMAP_BITS numbers
    shared = spark.sparkContext.broadcast(bitmap)
    own = lambda batches: _windows(width, shared.value)(batches)
    seeds = _rows(docs, id_col, text_col).mapInArrow(own, _WINDOW).select("uid", F.col("id").alias("doc_id"), "seed", F.col("at").alias("d"))
    pairs = seeds.join(items, "seed").groupBy("uid", "doc_id", "item_uid", "item_id", "item_words").agg(
        F.collect_list(F.struct("d", "i")).alias("hits")  # of one document and one item
    )
    covered = F.aggregate("tiles", F.lit(0).cast("long"), lambda n, t: n + t["words"])
    return (
        # distinct hits of a pair give at least this share only if enough of the item is hit at all
        pairs.where(F.size(F.array_distinct("hits.i")) * width >= F.col("item_words") * coverage)
        .withColumn("tiles", _tiled("hits", F.lit(width)))
        .withColumn("covered", covered)
        .withColumn("coverage", F.col("covered") / F.col("item_words"))
        .where(F.col("coverage") >= coverage)
    )


def contaminations(
    docs: DataFrame, benchmark: DataFrame, width: int = MIN_RUN, coverage: float = COVERAGE,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, item_words,
    covered (words), coverage, tiles."""
    found = _found(docs, benchmark, width, coverage, id_col, text_col, item_col, item_text)
    return found.select("doc_id", "item_id", "item_words", "covered", "coverage", "tiles")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those in which an item is found; same columns. As docs is
    scanned twice and its rows are known by their place, it must be a stored table."""
    uid = free_name(docs.columns, "row_number")
    rows = numbered(docs, *docs.columns, uid=uid)
    found = _found(rows, benchmark, MIN_RUN, COVERAGE, uid, text_col, "item_id", "text")
    gone = saved(found.select(F.col("doc_id").alias(uid)).distinct(), "contaminated")
    return rows.join(gone, uid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
