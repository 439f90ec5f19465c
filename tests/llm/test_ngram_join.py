"""The trie join against brute force over all pairs."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import components as components_module
from strata.llm import ngram_join as nj
from strata.llm.components import components

SCHEMA = "doc_id long, text string"


def words(text):
    return (text or "").encode().lower().split()


def grams(text, width=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def brute(rows):
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def mutate(rng, text, k):
    w = text.split(" ")
    for _ in range(k):
        w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
    return " ".join(w)


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocab) for _ in range(70))
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.2:
            text = rng.choice(rows)[1]
        elif rows and kind < 0.65:
            text = mutate(rng, rng.choice(rows)[1], rng.randrange(1, 8))
        else:
            text = " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 120)))
            if rng.random() < 0.5:
                text = passage + " " + text if rng.random() < 0.5 else passage
        rows.append((i, text))
    return rows


def result(spark, rows):
    out = nj.ngram_components(spark.createDataFrame(rows, SCHEMA).repartition(5)).select("doc_id", "n_shingles", "component_id")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_components_equal_brute_force(spark):
    rows = corpus(1)
    assert result(spark, rows) == brute(rows)


def test_cut_groups_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(nj, "GROUP_GRAMS", 300)  # hub groups and cross groups in many pieces
    rows = corpus(2)
    assert result(spark, rows) == brute(rows)


def test_special_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "A b"), (5, "a  B"), (6, "a b c"), (7, "one two three four five"),
            (7, "ONE two three four five"), (None, "one two three four five"), (None, None), (9, "é\x0bé É"), (10, "é é É"),
            (11, "long " * 30000 + "end"), (12, "long " * 20000 + "end")]
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_threshold_is_inclusive(spark):
    # 8 and 8 n-grams, 7 shared of 9: above; 7 of 10 below
    base = [f"t{i}" for i in range(12)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1] + ["z"])), (3, " ".join(base[:-3] + ["u", "v", "w"]))]
    assert result(spark, rows) == brute(rows)
    # exactly 3/4: 7 n-grams against 6 + 1 ... |I| = 6, |U| = 8
    rows = [(1, " ".join(base[:11])), (2, " ".join(base[:10] + ["z"]))]
    assert brute(rows)[1][2] == 1
    assert result(spark, rows) == brute(rows)


def test_one_of_each_keeps_columns_and_smallest_id(spark):
    rows = corpus(3, 80)
    docs = spark.createDataFrame([(i, t, i, "a") for i, t in rows] + [(0, rows[0][1], 5, "b")], "doc_id long, text string, row_number int, uid string")
    out = nj.one_of_each(docs)
    assert out.columns == docs.columns
    want = brute(rows)
    assert sorted(r[0] for r in out.collect()) == sorted(d for d, _, c in want if d == c)


def test_tree_join_prunes_but_finds_all():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 40, size=rng.integers(1, 30))).astype(np.uint64) for _ in range(120)]
    sizes = [len(s) for s in sets]
    links = nj.tree_join(sizes, sets, list(range(120)), 75, 100)
    parent = list(range(120))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        i = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * i >= 75 * (sizes[a] + sizes[b] - i)
        parent[find(a)] = find(b)
    for a in range(120):
        for b in range(a):
            i = len(np.intersect1d(sets[a], sets[b]))
            if 100 * i >= 75 * (sizes[a] + sizes[b] - i):
                assert find(a) == find(b)


def test_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.uid: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_buckets_are_those_of_spark(spark):
    from strata.llm.tables import bucket_of

    keys = [0, 1, -1, 7, 2**31, 2**33 + 5, -(2**62), 2**63 - 1]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", F.expr("pmod(hash(k), 37)").alias("b")).collect()
    assert bucket_of(np.array([r.k for r in rows]), 37).tolist() == [r.b for r in rows]


@pytest.mark.parametrize("hub", [1 << 10, 3])
def test_components_with_hubs(spark, monkeypatch, hub):
    """A star of half of all edges, repeated edges and loops; with the hubs broadcast and with all nodes joined."""
    monkeypatch.setattr(components_module, "HUB", hub)
    monkeypatch.setattr(components_module, "HUBS", 20)
    rng = random.Random(21)
    edges = [(5000, rng.randrange(400)) for _ in range(300)] + [(rng.randrange(1000, 1600), rng.randrange(1000, 1600)) for _ in range(250)]
    edges += edges[:40] + [(7, 7), (9000, 9000)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.uid, r.root) for r in got) == sorted((x, find(x)) for x in list(root))


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_components_take_few_rounds(spark, monkeypatch, held):
    """Long paths and deep trees whose edges lie together, in few written tables."""
    monkeypatch.setattr(components_module, "HELD", held, raising=False)
    written, saved = [], components_module.saved
    monkeypatch.setattr(components_module, "saved", lambda df, name: written.append(name) or saved(df, name))
    rng = random.Random(8)
    path = list(range(900))
    rng.shuffle(path)
    edges = list(zip(path[:-1], path[1:], strict=True)) + [(1000 + i, 1000 + rng.randrange(max(0, i - 4), i)) for i in range(1, 600)]
    got = sorted((r.uid, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == [(x, 0) for x in range(900)] + [(x, 1000) for x in range(1000, 1600)]
    assert len(written) <= 22


def test_stars_connect_what_the_edges_connect():
    u, v = components_module.stars(np.array([5, 9, 9, 3, 20]), np.array([4, 5, 3, 9, 20]))
    assert sorted(zip(u.tolist(), v.tolist(), strict=True)) == [(4, 3), (5, 3), (9, 3)]


def test_packing_by_ranges_follows_the_slice(monkeypatch):
    """Every n-gram keeps its owner; memory does not grow with the number of ranges."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(rng.choice([0, 3, 200]))) for _ in range(400)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(100, 500)), pa.array(range(400)), pa.array(texts)], names=["uid", "doc_id", "text"])
    grams, sizes = nj.gram_sets(rows.column(2), 5)
    want = sorted(zip(np.repeat(np.arange(100, 500), sizes).tolist(), grams.tolist(), strict=True))
    peaks = []
    for parts in (7, 4_000, 4_000_000):
        tracemalloc.start()
        docs, packs = nj._pack_grams(parts, 5)(iter([rows]))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert docs.num_rows == 400 and packs.num_rows <= min(parts, len(grams))
        got = []
        for r in packs.to_pylist():
            wide = np.frombuffer(r["grams"], np.uint8).reshape(-1, 6)
            gram = [int.from_bytes(g.tobytes(), "little") for g in wide]
            assert {g % parts for g in gram} == {r["part"]}
            owner = np.frombuffer(r["owners"], "<u4").reshape(-1, 2)
            got += zip((r["first"] + np.repeat(owner[:, 0], owner[:, 1])).tolist(), gram, strict=True)
        assert sorted(got) == want
    assert peaks[2] < 4 * peaks[0] + (8 << 20)


def test_one_component_of_most_rows(spark, monkeypatch):
    """A hub component of copies, with null and repeated ids: the smallest id reaches every row."""
    monkeypatch.setattr(components_module, "HUB", 3)
    text = "one two three four five six seven"
    rows = [(i, text) for i in range(40, 10, -1)] + [(None, text), (12, text), (1, "other words here"), (None, "alone"), (2, None)]
    got = nj.ngram_components(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted((r.component_id, r.n_shingles) for r in got if r.component_id is not None) == sorted([(11, 3)] * 32 + [(1, 1), (2, 0)])
    assert sum(r.component_id is None for r in got) == 1
