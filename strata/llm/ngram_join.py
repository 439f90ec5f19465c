"""Exact Jaccard self-join of word n-gram sets by prefix trees, and its components.

Every document's set is put into one global order, rare n-grams first. Sets are
joined inside groups of documents that share an n-gram of their prefixes (two
sets with Jaccard >= t share one among their first ``n - ceil(t*n) + 1``). In a
group the sets are stored in a trie of shared paths; each set walks it once,
adding up overlaps node by node, and leaves a subtree as soon as no set below
can still reach the threshold.

The answer is the components of the link relation, so links inside a component
that is already known are skipped; every link between two components is found.

Flow (tables written to the shared folder end each lineage):

1. n-gram hashes of each whole text, packed by hash range; per range, hashes of
   one document only are dropped (they can match nothing) and the others get
   their global rank (document frequency first).
2. Each document's remaining sorted set; where less than t of its set is left,
   no partner can exist and it leaves the join. The sets are bucketed by document,
   so that the joins below move them once, to their group.
3. Exact copies collapse to one representative.
4. Trie join in bounded groups around each document's best hub (the smallest
   document sharing most of its prefix); components of the links.
5. Trie join of the documents that still share a prefix n-gram with a document
   of another component: the largest component of a group is cut into blocks,
   each met by all others of the group; when those others fill several blocks,
   every pair of blocks meets. Groups are bounded by the n-grams they hold.

Hashes keep 48 bits besides the frequency class; two n-grams of a pair of
documents collide with probability about 1e-9.

Cases: null or blank text has an empty set, links with nothing and is its own
component; fewer than ``width`` words make one n-gram of the whole sequence;
repeated rows link with each other; null ids are rows like others and count as
the largest; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import components, with_lowest
from strata.llm.tables import (
    binary_list,
    bucket_of,
    free_name,
    grouped_rows,
    numbered,
    parts_for,
    saved,
    saved_by,
    text_bytes,
)
from strata.llm.words import slices, split_words, text_buffer, whole_sequence, windows

WIDTH = 5
THRESHOLD = (75, 100)  # links where 100 * intersection >= 75 * union
SLICE_BYTES = 4 << 20  # text hashed at a time in a task
PART_BYTES = 8 << 20  # text whose n-grams share a partition
MOST_PARTS = 50_000  # Spark bounds the buckets of a table; beyond it partitions grow
GROUP_GRAMS = 400_000  # n-grams of the sets in one trie join

# --- 1. n-gram sets ----------------------------------------------------------


def gram_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 48-bit n-gram hashes text by text, set sizes)."""
    data, offsets = text_buffer(texts)
    words, _, at = split_words(data, offsets)
    grams = windows(words, width) >> np.uint64(16)
    sets = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if hi - lo >= width:
            sets.append(np.unique(grams[lo : hi - width + 1]))
        elif hi > lo:
            sets.append(np.array([whole_sequence(words[lo:hi]) >> np.uint64(16)], dtype=np.uint64))
        else:
            sets.append(words[:0])
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    return (np.concatenate(sets) if sets else words[:0]), sizes


PACKED = "part int, uid long, doc_id long, n long, first long, owners binary, grams binary"
PACKED_ARROW = pa.schema(
    [("part", pa.int32()), ("uid", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("first", pa.int64()),
     ("owners", pa.binary()), ("grams", pa.binary())]
)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _batch(schema: pa.Schema, rows: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema
    )


def _pack_grams(parts: int, width: int):
    """Per slice of documents: one row a document, and one row a hash range with
    the n-grams that fall there, with (document of the slice, n-grams) for each of
    their owners. Time and memory follow the slice, not the number of ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column(0).to_numpy()
            _, offsets = text_buffer(batch.column(2))
            for lo, hi in slices(offsets, SLICE_BYTES):
                grams, sizes = gram_sets(batch.column(2).slice(lo, hi - lo), width)
                docs = hi - lo
                # uids are consecutive within a partition (monotonically_increasing_id)
                assert uid[hi - 1] - uid[lo] == docs - 1
                part = (grams % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")  # of a range, text by text
                part, owner = part[order], np.repeat(np.arange(docs), sizes)[order]
                runs = _changes(part, owner)
                lens = np.diff(np.append(runs, len(part)))
                owners = np.stack([owner[runs], lens], axis=1).astype("<u4")
                packed = grams[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                used = _changes(part)
                ends = np.append(used[1:], len(part))
                cuts = np.searchsorted(runs, np.append(used, len(part)))
                yield _batch(
                    PACKED_ARROW, docs,
                    part=pa.array(uid[lo:hi] % parts, pa.int32()), uid=pa.array(uid[lo:hi]),
                    doc_id=batch.column(1).slice(lo, docs), n=pa.array(sizes),
                )
                yield _batch(
                    PACKED_ARROW, len(used),
                    part=pa.array(part[used], pa.int32()), first=pa.array([int(uid[lo])] * len(used), pa.int64()),
                    owners=binary_list([owners[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]),
                    grams=binary_list([packed[a:b].tobytes() for a, b in zip(used, ends, strict=True)]),
                )

    return run


SHARED = "dest int, uid long, doc_id long, n long, uids binary, grams binary"
SHARED_ARROW = pa.schema(
    [("dest", pa.int32()), ("uid", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
     ("uids", pa.binary()), ("grams", pa.binary())]
)


def _rank_shared(parts: int):
    """One hash range: keep n-grams of two or more documents, led by their
    frequency class, and send them to their document's partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, uids = [], []
        for batch in batches:
            cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            docs = batch.filter(cols["uid"].is_valid())
            if docs.num_rows:
                yield _batch(
                    SHARED_ARROW, docs.num_rows,
                    dest=pa.array(bucket_of(docs.column(1).to_numpy(), parts), pa.int32()),
                    uid=docs.column(1), doc_id=docs.column(2), n=docs.column(3),
                )
            packs = batch.filter(cols["grams"].is_valid())
            for first, owner, gram in zip(
                *(packs.column(packs.schema.get_field_index(k)).to_pylist() for k in ("first", "owners", "grams")), strict=True
            ):
                wide = np.zeros((len(gram) // 6, 8), dtype=np.uint8)
                wide[:, :6] = np.frombuffer(gram, dtype=np.uint8).reshape(-1, 6)
                owner = np.frombuffer(owner, dtype="<u4").reshape(-1, 2)
                grams.append(wide.view("<u8").ravel())
                uids.append(np.repeat(first + owner[:, 0].astype(np.int64), owner[:, 1]))
        if not grams:
            return
        gram, uid = np.concatenate(grams), np.concatenate(uids)
        del grams, uids
        order = np.argsort(gram)
        ordered = gram[order]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        df = np.diff(np.append(begins, len(ordered)))
        keep = np.repeat(df > 1, df)
        rank = np.minimum(255, np.round(8 * np.log2(df))).astype(np.uint64) << np.uint64(48)
        key = (np.repeat(rank, df) | ordered)[keep]
        uid = uid[order][keep]
        dest = bucket_of(uid, parts)
        order = np.lexsort((uid, dest))
        key, uid, dest = key[order], uid[order], dest[order]
        used = _changes(dest)
        ends = np.append(used[1:], len(dest))
        for i in range(0, len(used), 64):
            some = used[i : i + 64]
            cut = [slice(a, b) for a, b in zip(some, ends[i : i + 64], strict=True)]
            yield _batch(
                SHARED_ARROW, len(some),
                dest=pa.array(dest[some], pa.int32()), uids=binary_list([uid[c].astype("<i8").tobytes() for c in cut]),
                grams=binary_list([key[c].astype("<u8").tobytes() for c in cut]),
            )

    return run


# --- 2. documents that can have a partner ------------------------------------

SETS = "uid long, n long, shared long, digest binary, grams binary"
SETS_ARROW = pa.schema(
    [("uid", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("digest", pa.binary()), ("grams", pa.binary())]
)


def _ceil_part(n: int, num: int, den: int) -> int:
    return -(-num * n // den)


def _gather_sets(num: int, den: int):
    """Of the documents of a partition: shared n-grams in the global order, where enough are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, size, uids, keys = [], [], [], []
        for batch in batches:
            one, n, many, grams = (batch.column(i) for i in range(4))
            doc.append(one.drop_null().to_numpy())
            size.append(n.drop_null().to_numpy())
            uids += [np.frombuffer(x, dtype="<i8") for x in many.drop_null().to_pylist()]
            keys += [np.frombuffer(x, dtype="<u8") for x in grams.drop_null().to_pylist()]
        if not uids:
            return
        doc, size, uid, key = (np.concatenate(x) for x in (doc, size, uids, keys))
        order = np.argsort(doc)
        doc, size = doc[order], size[order]
        order = np.lexsort((key, uid))
        uid, key = uid[order], key[order]
        begins = np.flatnonzero(np.concatenate([[True], uid[1:] != uid[:-1]]))
        ends = np.append(begins[1:], len(uid))
        n = size[np.searchsorted(doc, uid[begins])]
        fits = np.flatnonzero((ends - begins) * den >= num * n)
        for i in range(0, len(fits), 1000):
            some = fits[i : i + 1000]
            sets = [key[begins[d] : ends[d]].tobytes() for d in some]
            whole = [int(ends[d] - begins[d]) == int(n[d]) for d in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid[begins[some]]), pa.array(n[some]), pa.array((ends - begins)[some]),
                 binary_list([hashlib.blake2b(s, digest_size=16).digest() if w else None for s, w in zip(sets, whole, strict=True)]),
                 binary_list(sets)],
                schema=SETS_ARROW,
            )

    return run


def _prefix_grams(num: int, den: int):
    """(gram, uid) of each set's shared n-grams within its prefix. Its n-grams
    of one document come first in the global order and match nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, owners = [], []
            for uid, n, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = np.frombuffer(raw, dtype="<i8")
                take = own[: max(0, n - _ceil_part(n, num, den) + 1 - (n - len(own)))]
                grams.append(take)
                owners.append(np.full(len(take), uid, dtype=np.int64))
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(grams)), pa.array(np.concatenate(owners))], names=["gram", "uid"]
                )

    return run


# --- trie join ----------------------------------------------------------------


class _Node:
    """A path of n-grams shared by all sets below. ``best`` bounds what a set
    below can still reach; ``alike`` is a set below if all are of one component."""

    __slots__ = ("alike", "best", "children", "ends", "grams", "last")

    def __init__(self, grams: np.ndarray, best: int, alike: int) -> None:
        self.grams, self.best, self.alike = grams, best, alike
        self.last = int(grams[-1]) if len(grams) else -1
        self.children: dict[int, _Node] = {}
        self.ends: list[int] = []


class PrefixTree:
    """Sets of n-gram numbers (ascending in the global order) as a radix tree.

    ``sizes`` are whole set sizes, n-grams that no other set has included; they
    count as missed from the start. With sizes a and b, an overlap i passes when
    den * i >= num * (a + b - i).
    """

    def __init__(self, sizes: list[int], universe: int, num: int, den: int, parent: list[int]) -> None:
        self.sizes, self.num, self.den, self.parent = sizes, num, den, parent
        self.root = _Node(np.zeros(0, np.int64), -(1 << 60), -1)
        self.present = np.zeros(universe, dtype=bool)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def insert(self, doc: int, grams: np.ndarray) -> None:
        both = self.num + self.den
        # a set b below with m missed n-grams overlaps at most b - m; times both,
        # less its own share of the threshold:
        best = both * len(grams) - self.num * self.sizes[doc]
        root, node, at = self.find(doc), self.root, 0
        while True:
            node.best = max(node.best, best)
            if node.alike >= 0 and self.find(node.alike) != root:
                node.alike = -2  # of several components
            elif node.alike == -1:
                node.alike = doc
            if at == len(grams):
                node.ends.append(doc)
                return
            child = node.children.get(int(grams[at]))
            if child is None:
                leaf = _Node(grams[at:], best, doc)
                leaf.ends.append(doc)
                node.children[int(grams[at])] = leaf
                return
            m = min(len(child.grams), len(grams) - at)
            differ = child.grams[:m] != grams[at : at + m]
            same = int(differ.argmax()) if differ.any() else m
            if same < len(child.grams):  # split the path where the sets part
                upper = _Node(child.grams[:same], child.best, child.alike)
                child.grams = child.grams[same:]
                upper.children[int(child.grams[0])] = child
                node.children[int(upper.grams[0])] = upper
                child = upper
            node, at = child, at + same

    def link(self, doc: int, grams: np.ndarray) -> list[int]:
        """Union doc with the sets in the tree that pass; one link is returned
        for each component met."""
        num, both = self.num, self.num + self.den
        need, links, parent = num * self.sizes[doc], [], self.parent
        present = self.present
        present[grams] = True
        stack = [(self.root, 0, 0)]
        mine = self.find(doc)
        while stack:
            node, overlap, missed = stack.pop()
            if node.alike >= 0 and self.find(node.alike) == mine:
                continue
            for other in node.ends:
                theirs = self.find(other)
                if theirs != mine and both * overlap >= need + num * self.sizes[other]:
                    links.append(other)
                    parent[theirs] = mine
            for child in node.children.values():
                if child.best - both * missed < need:
                    continue
                if child.alike >= 0 and self.find(child.alike) == mine:
                    continue
                hit = int(np.count_nonzero(present[child.grams]))
                over, miss = overlap + hit, missed + len(child.grams) - hit
                if child.best - both * miss < need:
                    continue
                # what doc has left beyond this path must reach its own share
                if (over + len(grams) - int(np.searchsorted(grams, child.last, side="right"))) * both < need:
                    continue
                stack.append((child, over, miss))
        present[grams] = False
        return links


def tree_join(sizes: list[int], sets: list[np.ndarray], labels: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """Links (positions) that connect all components of the sets' link relation,
    given that sets of equal label are connected already."""
    keys, counts = np.unique(np.concatenate(sets), return_counts=True)
    first: dict[int, int] = {}
    parent = [first.setdefault(x, i) for i, x in enumerate(labels)]
    shared = counts > 1
    number = np.cumsum(shared) - 1
    tree = PrefixTree(sizes, int(shared.sum()), num, den, parent)
    links = []
    for doc in sorted(range(len(sets)), key=lambda i: sizes[i]):
        at = np.searchsorted(keys, sets[doc])
        grams = number[at[shared[at]]]  # n-grams of one set of the group are missed by all others
        if len(grams) * den < num * sizes[doc]:
            continue
        links += [(doc, other) for other in tree.link(doc, grams)]
        tree.insert(doc, grams)
    return links


def _join_groups(num: int, den: int):
    def one(_key: tuple, held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(held)
        uid = table["uid"].to_pylist()
        if len(uid) < 2:
            return None
        sets = [np.frombuffer(x, dtype="<u8") for x in table["grams"].to_pylist()]
        links = tree_join(table["n"].to_pylist(), sets, table["label"].to_pylist(), num, den)
        if not links:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([uid[i] for i, _ in links], pa.int64()), pa.array([uid[j] for _, j in links], pa.int64())],
            names=["a", "b"],
        )

    return lambda batches: grouped_rows(batches, ["g1", "g2", "g3"], one)


def _tree_links(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """members(g1, g2, g3, uid, label): trie join inside each group."""
    full = members.join(sets.select("uid", "n", "grams"), "uid").select("g1", "g2", "g3", "uid", "label", "n", "grams")
    dealt = full.repartition("g1", "g2", "g3").sortWithinPartitions("g1", "g2", "g3", "n", "uid")
    return dealt.mapInArrow(_join_groups(num, den), "a long, b long")


def _hub_members(grams: DataFrame, sets: DataFrame) -> DataFrame:
    """Each document in the group of the hub it shares most prefix n-grams with;
    groups above GROUP_GRAMS are cut, and the hub is in every piece."""
    hubs = grams.groupBy("gram").agg(F.min("uid").alias("hub"), F.count("*").alias("df")).where("df > 1")
    pairs = (
        grams.join(hubs, "gram").where("uid <> hub")
        .groupBy("uid", "hub").agg(F.count("*").alias("common"))
        .groupBy("uid").agg(F.max_by("hub", F.struct("common", -F.col("hub"))).alias("hub"))
    )
    pairs = saved(pairs.join(sets.select("uid", "shared"), "uid"), "hub-pairs")
    cut = pairs.groupBy("hub").agg(F.ceil(F.sum("shared") / GROUP_GRAMS).alias("pieces"))
    own = cut.select(F.col("hub").alias("uid"), "hub", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    rest = pairs.join(cut, "hub").select("uid", "hub", F.pmod(F.xxhash64("uid"), "pieces").alias("piece"))
    return rest.unionAll(own.select("uid", "hub", "piece")).select(
        F.col("hub").alias("g1"), F.col("piece").alias("g2"), F.lit(0).cast("long").alias("g3"), "uid", F.col("uid").alias("label")
    )


def _cross_members(grams: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Groups of documents that share a prefix n-gram across components."""
    named = grams.join(labels, "uid", "left").select("gram", "uid", F.coalesce("root", "uid").alias("label"))
    mixed = (
        named.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("uid").alias("g1"))
        .where("lo <> hi").select("gram", "g1")
    )
    found = named.join(mixed, "gram").select("g1", "uid", "label").distinct()
    found = saved(found.join(sets.select("uid", "shared"), "uid"), "cross")
    per_label = found.groupBy("g1", "label").agg(F.sum("shared").alias("grams"))
    groups = per_label.groupBy("g1").agg(
        F.max_by("label", F.struct("grams", -F.col("label"))).alias("major"),
        F.max("grams").alias("major_grams"),
        F.sum("grams").alias("all_grams"),
    ).select(
        "g1", "major",
        F.ceil(F.col("major_grams") / GROUP_GRAMS).alias("k"),
        F.greatest(F.lit(1), F.ceil((F.col("all_grams") - F.col("major_grams")) / GROUP_GRAMS)).alias("m"),
    )
    rows = found.join(groups, "g1").withColumn("salt", F.xxhash64("uid"))
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    key = lambda a, b: F.struct(a.cast("long").alias("g2"), b.cast("long").alias("g3"))
    major = rows.where("label = major").withColumn("i", F.pmod("salt", "k")).withColumn(
        "keys", F.transform(upto("m"), lambda j: key(F.col("i"), j))
    )
    # others meet every block of the major component; and each other, in blocks
    # numbered below zero when they fill more than one
    others = rows.where("label <> major").withColumn("j", F.pmod("salt", "m")).withColumn(
        "keys",
        F.concat(
            F.transform(upto("k"), lambda i: key(i, F.col("j"))),
            F.when(
                F.col("m") > 1,
                F.transform(upto("m"), lambda o: key(-1 - F.least(o, F.col("j")), -1 - F.greatest(o, F.col("j")))),
            ).otherwise(F.array().cast("array<struct<g2:bigint,g3:bigint>>")),
        ),
    )
    cols = ["g1", "uid", "label", F.explode("keys").alias("key")]
    return major.select(*cols).unionAll(others.select(*cols)).select("g1", "key.g2", "key.g3", "uid", "label")


# --- the operator ---------------------------------------------------------------


def ngram_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """Row by row of docs (uid as ``numbered`` gives it): uid, doc_id, n_shingles
    and root, the smallest uid of its component (null: linked with nothing)."""
    spark = docs.sparkSession
    num, den = threshold
    parts = min(MOST_PARTS, parts_for(spark, text_bytes(docs, text_col), PART_BYTES))
    rows = numbered(docs, id_col, text_col).select("uid", F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = rows.mapInArrow(_pack_grams(parts, width), PACKED).repartitionById(parts, F.col("part"))
    ranked = saved(packed.mapInArrow(_rank_shared(parts), SHARED), "grams")
    metas = ranked.where("uid IS NOT NULL").select("uid", "doc_id", F.col("n").alias("n_shingles"))
    dealt = ranked.select("dest", "uid", "n", "uids", "grams").repartitionById(parts, F.col("dest"))
    sets, sets_name = saved_by(dealt.drop("dest").mapInArrow(_gather_sets(num, den), SETS), "sets", "uid", parts)
    copies = sets.where("digest IS NOT NULL").select("uid", "digest")
    first = copies.groupBy("digest").agg(F.min("uid").alias("b"))
    same = saved(copies.join(first, "digest").where("uid <> b").select(F.col("uid").alias("a"), "b"), "copies")
    # exact copies of the first leave here; the wide rows of n-grams are not moved for it
    grams = sets.select("uid", "n", "grams").mapInArrow(_prefix_grams(num, den), "gram long, uid long")
    grams = saved(grams.join(same.select(F.col("a").alias("uid")), "uid", "left_anti"), "prefixes")
    near = components(saved(_tree_links(_hub_members(grams, sets), sets, num, den), "links"))
    far = saved(_tree_links(_cross_members(grams, sets, near), sets, num, den), "links")
    spark.sql(f"DROP TABLE {sets_name}")  # the catalogue entry; files go with the shared folder
    roots = components(same.unionAll(near.select(F.col("uid").alias("a"), F.col("root").alias("b"))).unionAll(far))
    return metas.join(roots, "uid", "left")


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    rows = saved(ngram_classes(docs, id_col, text_col, width, threshold), "classes")
    linked = rows.where("root IS NOT NULL").select(F.col("root").alias("u"), F.col("doc_id").alias("v"), "n_shingles")
    named = with_lowest(linked, rows.count()).select(F.col("v").alias("doc_id"), "n_shingles", F.col("low").alias("component_id"))
    alone = rows.where("root IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionAll(alone)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component (smallest id, then first row); same columns.

    docs is scanned twice and its rows are known by their place in the scan, so it
    must be a stored table (as between pipeline stages), not a plan that may
    deliver rows in another order; ``tables.saved`` makes one of any frame.
    """
    uid = free_name(docs.columns, "row_number")
    kept = numbered(docs, *docs.columns, uid=uid)
    rows = saved(ngram_classes(kept, uid, text_col).where("root IS NOT NULL").select("root", F.col("doc_id").alias(uid)), "classes")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", uid)
    members = rows.join(kept.select(uid, F.col(id_col).alias("id")), uid)
    best = members.groupBy("root").agg(F.min(order)[uid].alias(uid))
    gone = saved(rows.join(best, uid, "left_anti").select(uid), "gone")
    return kept.join(gone, uid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
