"""Connected components of an edge table by alternating star contractions.

Each round goes over the edges twice (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014): every node hangs its larger, then its smaller
neighbours on the smallest node it sees. Minima are added up in tasks before they
are shuffled, and a node with a large part of all edges (a hub) never has them in
one task: the few hubs there can be are broadcast, the other nodes are joined.
Before each round every task hangs what its own edges connect on the smallest node
of that part, a bounded block of edges at a time: paths whose edges lie together go
before any shuffle, and few rounds are left. Rounds end as soon as all edges lead to
a root. Each half ends in a written table, so the plan never grows and a lost
executor costs only its tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import saved

HUB = 1 << 10  # edges of a node that is joined
HUBS = 1000  # or this part of all edges, if that is more: so there are fewer hubs than this
HELD = 1 << 20  # edges that a task connects at a time


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what edges (u, v) connect."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(nodes))
    while True:
        x, y = low[a], low[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))  # the larger root on the smaller
        while (low[low] != low).any():
            low = low[low]
    hung = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[hung], nodes[low[hung]]


def _task_stars(most: int):
    """The edges (u, v) of a task as stars, about ``most`` edges at a time."""

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = stars(*(np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, most):
                held.append(batch.slice(lo, most))
                n += held[-1].num_rows
                if n >= most:
                    yield made(held)
                    held, n = [], 0
        if n:
            yield made(held)

    return run


def with_lowest(edges: DataFrame, rows: int) -> DataFrame:
    """edges(u, v, ...), ``rows`` of them at most, with low, the smallest v of their u
    (null if all are). No u brings more than HUB rows or a HUBS-th of all to one task."""
    lows = edges.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n"))
    most = max(HUB, rows // HUBS)
    if rows <= most:  # too few for a hub
        return edges.join(lows.drop("n"), "u")
    lows = saved(lows, "cc-lows")
    hubs = F.broadcast(lows.where(F.col("n") > most).drop("n"))
    others = edges.join(hubs, "u", "left_anti").join(lows.where(F.col("n") <= most).drop("n"), "u")
    return edges.join(hubs, "u").unionAll(others)


def _large_star(work: DataFrame, rows: int) -> DataFrame:
    """Each node's larger neighbours hang on the smallest of it and its neighbours."""
    both = work.unionAll(work.select(F.col("v").alias("u"), F.col("u").alias("v")))
    star = with_lowest(both, 2 * rows).where("v > u")
    return star.select(F.col("v").alias("u"), F.least("u", "low").alias("v"))


def _small_star(work: DataFrame, rows: int) -> DataFrame:
    """Each node and its smaller neighbours hang on the smallest of these: the edge to that
    one stays, of the other edges the smaller end is hung anew."""
    end = F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v"))
    return with_lowest(work, rows).select(end.alias("u"), F.col("low").alias("v"))


def _connected(edges: DataFrame, name: str) -> DataFrame:
    return saved(edges.mapInArrow(_task_stars(HELD), "u long, v long"), name)


def _state(work: DataFrame) -> tuple[int, int]:
    """(edges, nodes that hang on another one and have a further neighbour)."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("up")),
                             F.struct(F.col("v").alias("node"), F.lit(None).cast("long").alias("up"))))
    nodes = work.select(ends.alias("end")).groupBy("end.node").agg(
        F.min("end.up").alias("lo"), F.max("end.up").alias("hi"), F.count("end.up").alias("ups"), F.count("*").alias("n")
    )
    loose = (F.col("ups") > 0) & ((F.col("lo") < F.col("hi")) | (F.col("ups") < F.col("n")))
    return tuple(nodes.agg(F.coalesce(F.sum("ups"), F.lit(0)), F.count_if(loose)).first())


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) long -> (uid, root) for every node of an edge between two
    different nodes; root is the smallest uid of its component. Repeated edges
    count once; empty edges give an empty table."""
    work = _connected(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "cc")
    rows, loose = _state(work)
    while loose:
        large = saved(_large_star(work, rows), "cc-large")
        work = _connected(saved(_small_star(large, rows), "cc-small"), "cc")
        rows, loose = _state(work)
    # every edge leads to a root
    return saved(work.unionAll(work.select(F.col("v").alias("u"), "v")).distinct().toDF("uid", "root"), "cc-roots")
