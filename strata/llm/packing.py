"""Packing by power-of-two decomposition.

A document's ids (with an end id) are cut into pieces whose lengths are powers
of two: as many of the context length as fit, then the binary digits of the
rest, longest first. Each piece is a sequence of its own, so no sequence holds
two documents and none needs padding; sequences of equal length form a bucket
(column ``length``), from which batches are drawn. One pass, no shuffle.

Cases: null or empty text is the end id alone; repeated rows are packed each;
texts are encoded whole; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tokens import RANKS, encoded, sliced

CONTEXT = 1024  # a power of two
END_ID = 0

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
)


def binary_lengths(total: int, context: int = CONTEXT) -> list[int]:
    """Powers of two, at most ``context``, that add up to ``total``; longest first."""
    rest = total % context
    return [context] * (total // context) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(context: int, end_id: int, ranks: str):
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, texts in sliced(batch.column(1)):
                owner, start, length, total, ids = [], [], [], [], []
                for i, got in enumerate(encoded(texts, ranks)):
                    raw = np.concatenate([got, end]).astype("<u4", copy=False).tobytes()
                    at = 0
                    for n in binary_lengths(len(raw) // 4, context):
                        owner.append(lo + i)
                        start.append(at)
                        length.append(n)
                        total.append(len(raw) // 4)
                        ids.append(raw[4 * at : 4 * (at + n)])
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(total, pa.int64()),
                     pa.array(np.arange(sequence, sequence + len(owner))), pa.array(np.zeros(len(owner), np.int64)),
                     pa.array(ids, pa.binary())],
                    schema=_ARROW,
                )
                sequence += len(owner)

    return run


def packed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", context: int = CONTEXT, end_id: int = END_ID, ranks: str = RANKS
) -> DataFrame:
    """One row per piece; ``ids`` are its token ids as little-endian unsigned 32-bit
    numbers. sequence_id is unique in the result; offset is 0, as each sequence
    holds one piece."""
    if context < 1 or context & (context - 1):
        raise ValueError(f"the context length must be a power of two, not {context}")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_pieces(context, end_id, ranks), PIECES)


def packed_digests(docs: DataFrame) -> DataFrame:
    """``packed`` with a checksum in place of the ids."""
    return packed(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Pieces as Parquet in one folder per length, ready for batches of equal length."""
    pieces.write.partitionBy("length").parquet(path)
