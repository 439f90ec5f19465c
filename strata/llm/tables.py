"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here,
    and a lost executor costs only the tasks it was running."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_by(df: DataFrame, name: str, key: str, buckets: int) -> tuple[DataFrame, str]:
    """(table, its name in the catalogue, to be dropped after use). Like ``saved``, as a table bucketed by ``key``: later joins on it move only
    the other side. ``df`` should be dealt by :func:`bucket_of` already, so that
    each task writes one file."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).sortBy(key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table), table


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Spark's bucket of each long key (Murmur3 of the two halves, seed 42)."""
    rotate = lambda x, n: (x << np.uint32(n)) | (x >> np.uint32(32 - n))
    raw = keys.astype(np.int64).view(np.uint64)
    h = np.full(len(raw), 42, dtype=np.uint32)
    for half in ((raw & np.uint64(0xFFFFFFFF)).astype(np.uint32), (raw >> np.uint64(32)).astype(np.uint32)):
        k = rotate(half * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = rotate(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(factor)
    h ^= h >> np.uint32(16)
    return h.view(np.int32).astype(np.int64) % buckets


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(docs: DataFrame, *columns: str, uid: str = "uid") -> DataFrame:
    """``columns`` of docs with a row number unique over the frame. Repeated or
    null ids stay separate rows; numbers are consecutive within a partition."""
    return docs.select(F.monotonically_increasing_id().alias(uid), *[F.col(f"`{c}`") for c in columns])


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: the size from which partition counts follow."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0)


def parts_for(spark: SparkSession, size: int, per_part: int) -> int:
    """Partitions for ``size`` bytes, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // per_part))


def grouped_rows(
    batches: Iterator[pa.RecordBatch], keys: list[str], handle: Callable[[tuple, list[pa.RecordBatch]], pa.RecordBatch | None]
) -> Iterator[pa.RecordBatch]:
    """Call ``handle`` once per run of equal integer ``keys`` in a partition
    sorted by them; only one group is held at a time."""
    key, held = None, []
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(int(c[lo]) for c in cols)
            if held and now != key:
                if (out := handle(key, held)) is not None:
                    yield out
                held = []
            key = now
            held.append(batch.slice(lo, hi - lo))
    if held and (out := handle(key, held)) is not None:
        yield out


def binary_list(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, type=pa.binary())
