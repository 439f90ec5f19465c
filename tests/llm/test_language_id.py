"""Language identification: n-grams against plain slicing, held-out accuracy."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from strata.llm import language_id as li
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, lang string, score int"


def test_grams_stay_inside_their_text():
    texts = ["", "a", "Ab", "abc d", "é1ü", "", "zzzz"]
    table = li._letters()
    for order, (buckets, counts) in zip(li.ORDERS, li.grams(texts), strict=True):
        want = []
        for t in texts:
            points = table[np.array([32, *map(ord, t), 32], dtype=np.uint32)]
            n = len(points) - order + 1 - (order == 1)  # the trailing space is the next text's first
            want.append(li._hashes(points, order)[: max(0, n)].tolist())
        assert counts.tolist() == [len(w) for w in want]
        assert buckets.tolist() == [b for w in want for b in w]


def test_naive_bayes_by_hand(spark):
    rows = [(i, t, g, 1) for i, (t, g) in enumerate([("aa", "x"), ("ab", "x"), ("bb", "y"), (None, "y"), ("cc", None)])]
    model = li.fit(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == ["x", "y"] and np.allclose(np.exp(model.prior), [2 / 3, 1 / 3])
    assert np.allclose(np.exp(model.matrix).sum(axis=1), 1)
    langs, scores = li.scored(model, ["aa", "b b", "", "123 !"])
    assert langs == ["x", "y", "und", "und"] and scores[2:].tolist() == [0, 0]
    logs = model.prior.copy()
    for buckets, _ in li.grams(["aa"]):
        logs += model.matrix[:, buckets].sum(axis=1)
    assert scores[0] == pytest.approx(math.exp(logs[0]) / np.exp(logs).sum())


def test_held_out_accuracy_and_folds(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = li.held_out_languages(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_special_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", 1), (2, "the cat", "en", 1), (2, "the cat", "en", 1), (None, "das Haus", None, 1), (5, "x" * 100_000, "en", 2)], SCHEMA)
    got = {(r.doc_id, r.lang_pred) for r in li.held_out_languages(docs).collect()}
    assert {d for d, _ in got} == {1, 2, None, 5} and (1, "und") in got
    assert li.held_out_languages(docs.limit(0)).count() == 0
    unlabelled = docs.drop("lang").selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {(r.lang_pred, r.score) for r in li.held_out_languages(unlabelled).collect()} == {("und", 0.0)}
