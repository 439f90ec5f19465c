"""Hard negatives by zone maps over Hilbert-curve-ordered candidate blocks.

Vectors become integers and are put in the order of a Hilbert curve through all
dimensions. Ranges of the curve are *parts*; the rows of a part are cut, label by label,
into blocks of BLOCK rows, stored as Parquet rows with the block's vectors and, apart
from them, its zone map: the smallest and largest entry in each dimension. Interval
arithmetic on a zone map bounds the inner product of an anchor with any row of the
block from both sides.

The anchors of a block form a group. Two phases, first for the anchors' positives and
then for the windows below their scores, are each:

* home: a group searches its own part. What it finds there bounds what can still count.
* plan: only zone maps are read. In every other part a group keeps the blocks whose
  interval can beat what it has (positives) or meet an open window (negatives).
* read: the planned blocks, and no others, are read and searched by the groups that
  asked for them; the partial results of a group are merged.

Groups stream past one part at a time, whose size is bounded by PART_ROWS, so memory
depends on neither the anchors, a label nor a repeated vector. Bounds drop only what
cannot count, so the result is exact. Where the vectors have no structure the intervals
are wide and the work is that of all anchors against all rows, in blocks.

Cases: rows with a null id, label or vector, or with null or non-finite entries, take no
part; shorter vectors are filled up with entries 0; repeated rows are rows of their own
(a copy of an anchor may be its positive, and a repeated anchor gives its rows twice);
equal scores come by smaller id; an anchor without positives, or a window without
negatives, gives no row; scores beyond 64 bits raise OverflowError; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import parts_for, saved
from strata.llm.vectors import exact_kind, integer_entries, matrix, usable

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # per cent of a positive's score
ANCHOR_EVERY = 50
BLOCK = 512  # rows
PART_ROWS = 1 << 18
CURVE_BITS = 4  # of each dimension
SCORES = 1 << 22  # inner products held at a time

_BLOCK = "part int, block long, label long, lo binary, hi binary, uids binary, ids binary, xs binary"
_GROUP = "part int, block long, label long, uids binary, ids binary, xs binary, found binary, windows binary, wanted array<long>"
_ROW = "part int, kind int, block long, label long, lo binary, hi binary, uids binary, ids binary, xs binary, found binary, windows binary, wanted array<long>"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


# --- the curve -----------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int = CURVE_BITS) -> list[bytes]:
    """Place of each row of grid cells on the Hilbert curve through all columns, as
    bytes that sort along it (Skilling's transform, a few array steps per bit and column)."""
    x = cells.astype(np.uint32).T.copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        top, low = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for i in range(d):
            inverted = (x[i] & top) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(inverted, low, swapped)
            x[i] ^= swapped
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[d - 1] & np.uint32(1 << b)) != 0, np.uint32((1 << b) - 1), np.uint32(0))
    x ^= turn
    planes = np.stack([(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)])  # bits, columns, rows
    packed = np.packbits(planes.reshape(bits * d, -1).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _keyed(width: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), width).astype(np.float64)
            cells = ((x - low) / max(1.0, float(high) - low) * ((1 << CURVE_BITS) - 1)).round().clip(0, (1 << CURVE_BITS) - 1)
            keys = pa.array(hilbert_keys(cells) if len(x) else [], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "key"])

    return run


# --- blocks --------------------------------------------------------------------


def packed(x: np.ndarray) -> bytes:
    """Entries in 16 bits where they fit, else in 64."""
    fits = not x.size or (x.min() >= -(2**15) and x.max() < 2**15)
    return x.astype("<i2" if fits else "<i8").tobytes()


def unpacked(raw: bytes, width: int, rows: int) -> np.ndarray:
    kind = "<i2" if len(raw) == 2 * width * rows else "<i8"
    return np.frombuffer(raw, kind).astype(np.int64).reshape(rows, width)


def longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


def _blocks(width: int):
    """Rows sorted by label and curve -> one row a block."""
    names = _arrow(_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0

        def block(label: int, uids: np.ndarray, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            nonlocal count
            count += 1
            values = [part, part << 32 | count, label, packed(x.min(axis=0)), packed(x.max(axis=0)), uids.tobytes(), ids.tobytes(), packed(x)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, names, strict=True)], schema=names)

        held: list[tuple] = []  # rows of the current label, fewer than BLOCK
        label = None
        for batch in batches:
            labels = batch.column("label").to_numpy()
            uids, ids = batch.column("uid").to_numpy(), batch.column("vec_id").to_numpy()
            x = matrix(batch.column("x"), width)
            cuts = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if held and labels[lo] != label:
                    yield block(label, *map(np.concatenate, zip(*held, strict=True)))
                    held = []
                label = int(labels[lo])
                while lo < hi:
                    room = BLOCK - sum(len(h[0]) for h in held)
                    upto = min(hi, lo + room)
                    held.append((uids[lo:upto], ids[lo:upto], x[lo:upto]))
                    if upto - lo == room:
                        yield block(label, *map(np.concatenate, zip(*held, strict=True)))
                        held = []
                    lo = upto
        if held:
            yield block(label, *map(np.concatenate, zip(*held, strict=True)))

    return run


def _anchors(width: int, every: int):
    """Blocks -> the anchors of each, as a group."""
    names = _arrow(_GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids = longs(r["ids"])
                own = ids % every == 0
                if own.any():
                    x = unpacked(r["xs"], width, len(ids))[own]
                    rows.append(r | {"uids": longs(r["uids"])[own].tobytes(), "ids": ids[own].tobytes(), "xs": packed(x)}
                                | {"found": b"", "windows": b"", "wanted": None})
            if rows:
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in names.names} for r in rows], schema=names)

    return run


# --- search --------------------------------------------------------------------


def best(score: np.ndarray, ids: np.ndarray, uids: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` candidates as rows (score, id, uid): higher scores first, then
    smaller ids. Many equal scores are not sorted, only searched for the smallest ids."""
    if len(score) > most:
        least = np.partition(score, -most)[-most]
        above, ties = np.flatnonzero(score > least), np.flatnonzero(score == least)
        need = most - len(above)
        if len(ties) > need:
            ties = ties[ids[ties] <= np.partition(ids[ties], need - 1)[need - 1]]
        at = np.concatenate([above, ties])
        score, ids, uids = score[at], ids[at], uids[at]
    order = np.lexsort([uids, ids, -score])[:most]
    return np.stack([score[order], ids[order], uids[order]], axis=1)


def as_lists(raw: bytes, anchors: int, windows: int, most: int) -> np.ndarray:
    """(anchors, windows, most, 3): what a group found so far; free places have uid -1."""
    if not raw:
        out = np.zeros((anchors, windows, most, 3), dtype=np.int64)
        out[..., 2] = -1
        return out
    return longs(raw).reshape(anchors, windows, most, 3).copy()


def merge(into: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Lists of the same windows, cut to their length again; both may hold the same row."""
    both = np.concatenate([into, other], axis=2)
    for a in range(both.shape[0]):
        for w in range(both.shape[1]):
            rows = both[a, w]
            put(into[a, w], np.unique(rows[rows[:, 2] >= 0], axis=0))
    return into


def put(places: np.ndarray, rows: np.ndarray) -> None:
    kept = best(rows[:, 0], rows[:, 1], rows[:, 2], len(places))
    places[: len(kept)] = kept
    places[len(kept) :] = (0, 0, -1)


def window(positive: int) -> tuple[int, int]:
    """Lowest and highest score of a negative below a positive of this score."""
    return -(-positive * WINDOW[0] // 100), positive * WINDOW[1] // 100


class Group:
    """A group row with its arrays; ``kind`` is the type in which scores are exact."""

    def __init__(self, row: dict, width: int, kind: type):
        self.row, self.label = row, row["label"]
        self.uids = longs(row["uids"])
        self.x = unpacked(row["xs"], width, len(self.uids)).astype(kind)
        self.negatives = bool(row["windows"])  # the phase: positives are known
        m = len(self.uids)
        self.windows, self.most = (POSITIVES, NEGATIVES) if self.negatives else (1, POSITIVES)
        self.found = as_lists(row["found"], m, self.windows, self.most)
        self.positives = as_lists(row["windows"], m, 1, POSITIVES)[:, 0]

    def span(self, a: int, w: int) -> tuple[float, float] | None:
        """Lowest and highest score that anchor a's window w can still take."""
        low, high = -inf, inf
        if self.negatives:
            if self.positives[a, w, 2] < 0:
                return None
            low, high = window(int(self.positives[a, w, 0]))
        last = self.found[a, w, -1]
        if last[2] >= 0:
            low = max(low, int(last[0]))
        return (low, high) if low <= high else None

    def wants(self, part: Part) -> np.ndarray:
        """Which blocks of the part some window must read, by their zone maps."""
        out = (part.labels != self.label) if self.negatives else (part.labels == self.label)
        at = np.flatnonzero(out)
        if not len(at):
            return out
        up, down = np.maximum(self.x, 0), np.minimum(self.x, 0)
        lo, hi = part.lo[at].T, part.hi[at].T
        most, least = up @ hi + down @ lo, up @ lo + down @ hi
        need = np.zeros(len(at), dtype=bool)
        for a in range(len(self.uids)):
            for w in range(self.windows):
                if span := self.span(a, w):
                    need |= (most[a] >= span[0]) & (least[a] <= span[1])
        out[at] = need
        return out

    def search(self, part: Part, chosen: np.ndarray) -> None:
        """Put the rows of the chosen blocks that count into ``found``."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], chosen.astype(np.int8), [0]])))
        runs = [(part.ends[lo], part.ends[hi]) for lo, hi in zip(edges[::2], edges[1::2], strict=True)]
        if not runs:
            return
        uids = np.concatenate([part.uids[lo:hi] for lo, hi in runs])
        ids = np.concatenate([part.ids[lo:hi] for lo, hi in runs])
        step = max(1, SCORES // len(uids))
        for first in range(0, len(self.uids), step):
            x = self.x[first : first + step]
            scores = np.concatenate([x @ part.x[lo:hi].T for lo, hi in runs], axis=1)
            if scores.dtype == object and max(map(abs, scores.ravel())) >= 2**63:
                raise OverflowError("inner products beyond 64 bits")
            for a, score in enumerate(scores.astype(np.int64), first):
                self.take(a, score, ids, uids)

    def take(self, a: int, score: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        spans = {w: s for w in range(self.windows) if (s := self.span(a, w))}
        if not spans:
            return
        low, high = min(s[0] for s in spans.values()), max(s[1] for s in spans.values())
        near = np.flatnonzero((score >= low) & (score <= high) & (uids != self.uids[a]))
        score, ids, uids = score[near], ids[near], uids[near]
        for w, (low, high) in spans.items():
            own = np.flatnonzero((score >= low) & (score <= high))
            if len(own):
                lists = self.found[a, w]
                put(lists, np.concatenate([lists[lists[:, 2] >= 0], best(score[own], ids[own], uids[own], self.most)]))

    def out(self, wanted: list[int] | None) -> dict:
        return self.row | {"found": self.found.tobytes(), "wanted": wanted}


class Part:
    """The blocks (or zone maps alone) of one part, in the order of their numbers."""

    def __init__(self, rows: list[dict], width: int, kind: type):
        self.blocks = np.array([r["block"] for r in rows], dtype=np.int64)
        self.labels = np.array([r["label"] for r in rows], dtype=np.int64)
        self.lo, self.hi = (np.concatenate([unpacked(r[k], width, 1) for r in rows]).astype(kind) for k in ("lo", "hi"))
        if rows[0]["uids"] is not None:
            uids = [longs(r["uids"]) for r in rows]
            self.uids, self.ids = np.concatenate(uids), np.concatenate([longs(r["ids"]) for r in rows])
            self.x = np.concatenate([unpacked(r["xs"], width, len(u)).astype(kind) for r, u in zip(rows, uids, strict=True)])
            self.ends = np.cumsum([0, *map(len, uids)])


Meet = Callable[[Part, Group], dict | None]


def search_home(part: Part, group: Group) -> dict | None:
    group.search(part, group.wants(part))
    return group.out(None)


def plan_part(part: Part, group: Group) -> dict | None:
    wanted = part.blocks[group.wants(part)]
    return group.out(wanted.tolist()) if len(wanted) else None


def search_planned(part: Part, group: Group) -> dict | None:
    group.search(part, np.isin(part.blocks, group.row["wanted"]))
    return group.out(None)


class Index:
    """The blocks, and the widths and types that every task needs."""

    def __init__(self, embeddings: DataFrame, id_col: str, label_col: str, vector_col: str):
        spark = embeddings.sparkSession
        vec_id, label, vector = F.col("vec_id"), F.col("label"), F.col("v")
        rows = embeddings.select(
            F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
            F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
        ).where(vec_id.isNotNull() & label.isNotNull() & usable(vector))
        rows = rows.select("vec_id", "label", integer_entries(vector, SCALE).alias("x"))
        rows = rows.withColumn("uid", F.monotonically_increasing_id())
        n, width, low, high = rows.agg(
            F.count("*"), F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x"))
        ).first()
        self.empty = not n
        self.width, low, high = max(1, width or 0), low or 0, high or 0
        self.kind = exact_kind(max(-low, high, 1) ** 2 * self.width)
        if self.empty:
            return
        keyed = rows.mapInArrow(_keyed(self.width, low, high), "vec_id long, label long, x array<long>, uid long, key binary")
        parts = parts_for(spark, n, PART_ROWS)
        # the row number splits a vector that many rows share over parts and blocks
        dealt = keyed.repartitionByRange(parts, "key", "uid").sortWithinPartitions("label", "key", "uid")
        self.blocks = saved(dealt.mapInArrow(_blocks(self.width), _BLOCK), "mining-blocks")
        self.parts = self.blocks.agg(F.max("part")).first()[0] + 1

    def met(self, blocks: DataFrame, groups: DataFrame, meet: Meet) -> DataFrame:
        """``meet`` of every group with the blocks of the part it is sent to. A task
        holds one part's blocks at a time; the groups stream past it."""
        names, width, kind = _arrow(_GROUP), self.width, self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, rows, part = None, [], None
            for batch in batches:
                for lo in range(0, batch.num_rows, 64):
                    out = []
                    for r in batch.slice(lo, 64).to_pylist():
                        if r["part"] != at:
                            at, rows, part = r["part"], [], None
                        if r["kind"] == 0:
                            rows.append(r)
                            continue
                        if rows:
                            part, rows = Part(rows, width, kind), []
                        if got := meet(part, Group({k: r[k] for k in names.names}, width, kind)):
                            out.append(got)
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema=names)

        columns = [f.split() for f in _ROW.split(", ")]
        one = lambda df, number: df.select(
            *[(F.lit(number) if c == "kind" else F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns]
        )
        both = one(blocks, 0).unionByName(one(groups, 1)).repartition(self.parts, "part")
        return both.sortWithinPartitions("part", "kind", "block").mapInArrow(run, _GROUP)

    def anchors(self, every: int) -> DataFrame:
        return self.blocks.mapInArrow(_anchors(self.width, every), _GROUP)

    def searched(self, groups: DataFrame) -> DataFrame:
        """Groups with the exact lists of their phase: home, plan, read, merge."""
        home = saved(self.met(self.blocks, groups, search_home), "mining-home")
        others = F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1)))
        away = home.withColumn("to", others).where("`to` <> part").withColumn("part", F.col("to").cast("int")).drop("to")
        zones = self.blocks.drop("uids", "ids", "xs")
        plan = saved(self.met(zones, away, plan_part), "mining-plan")
        chosen = plan.select("wanted").mapInArrow(_distinct, "chosen long").distinct()
        read = self.met(self.blocks.join(chosen, F.col("block") == F.col("chosen"), "left_semi"), plan, search_planned)
        return saved(merged(home.unionByName(read), self.parts), "mining-found")


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block numbers that any group wants, each once a batch: plans lie together by part,
    so few blocks come twice."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0).flatten().unique()], names=["chosen"])


def merged(rows: DataFrame, count: int) -> DataFrame:
    """One row a group, with the lists of all its rows merged; its part is not kept."""
    names = _arrow(_GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, lists = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([row | {"found": lists.tobytes()}], schema=names)

        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for r in batch.slice(lo, 64).to_pylist():
                    shape = (len(r["uids"]) // 8, *((POSITIVES, NEGATIVES) if r["windows"] else (1, POSITIVES)))
                    own = as_lists(r["found"], *shape)
                    if row is not None and r["block"] == row["block"]:
                        lists = merge(lists, own)
                        continue
                    if row is not None:
                        yield done()
                    row, lists = r, own
        if row is not None:
            yield done()

    return rows.repartition(count, "block").sortWithinPartitions("block").mapInArrow(run, _GROUP)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups after both phases -> mined rows."""
    names = _arrow(MINED)
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            ids = longs(r["ids"])
            positives = as_lists(r["windows"], len(ids), 1, POSITIVES)[:, 0]
            negatives = as_lists(r["found"], len(ids), POSITIVES, NEGATIVES)
            for a, w, k in np.argwhere(negatives[..., 2] >= 0).tolist():
                p, n = positives[a, w].tolist(), negatives[a, w, k].tolist()
                out.append((int(ids[a]), p[1], k + 1, n[1], p[0], n[0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(names), names, strict=True)], schema=names
        )


def mined(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    anchor_every: int = ANCHOR_EVERY,
) -> DataFrame:
    """A row per anchor, positive and hard negative (see the module's text). Anchors are
    the rows whose id ``anchor_every`` divides."""
    index = Index(embeddings, id_col, label_col, vector_col)
    if index.empty:
        return embeddings.sparkSession.createDataFrame([], MINED)
    positives = index.searched(index.anchors(anchor_every))
    home_part = (F.col("block") / F.lit(1 << 32)).cast("int")  # a block's number begins with its part
    windows = positives.withColumns({"part": home_part, "windows": F.col("found"), "found": F.lit(b"")})
    return index.searched(windows).mapInArrow(_rows, MINED)


def relabelled(embeddings: DataFrame) -> DataFrame:
    """The rows as the query mines them: where 7 divides the id, the label is the next of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.withColumn("label", label)


ORACLE_SQL = """
WITH r AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), p AS (
  SELECT a.uid, a.vec_id AS anchor_id, b.uid AS other, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM r a JOIN r b ON a.uid <> b.uid WHERE a.vec_id % 50 = 0
), pos AS (
  SELECT * FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, other_id, other) <= 5
), neg AS (
  SELECT pos.anchor_id, pos.other_id AS positive_id, p.other_id AS negative_id, pos.score AS positive_score,
    p.score AS negative_score,
    row_number() OVER (PARTITION BY pos.uid, pos.other ORDER BY p.score DESC, p.other_id, p.other) AS rank
  FROM pos JOIN p ON p.uid = pos.uid AND NOT p.same
    AND 50 * pos.score <= 100 * p.score AND 100 * p.score <= 95 * pos.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 3
"""
