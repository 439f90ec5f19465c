"""Byte-pair ids and decoded texts against the tokenizers library itself."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from strata.llm import bpe  # noqa: E402
from tests.conftest import SF001  # noqa: E402

EVERY = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
TEXTS = [
    None, "", " ", "a", "Hello  World\n\n", "it's I'LL 'S 't's", "<|endoftext|><|startoftext|>x<|endoftext", "a <|ENDOFTEXT|> b",
    "ΣΑΣ İstanbul ǅ ﬀ Ⅷ ½ é 각", "日本語 🙂🙂 한국어 עברית", "\x1c\x85\xa0 a　b\0", "same", "same",
    "a" * 70_001, "ab" * 30_000, "the of and " * 9000, "x" * 64, "x" * 65, "=" * 5000,
]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))


def encoded(texts):
    return bpe.Words(bpe.vocabulary()).encode([t or "" for t in texts])


def same(reference, texts):
    want = reference.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for text, got, e in zip(texts, encoded(texts), want, strict=True):
        assert got.tolist() == e.ids, repr((text or "")[:60])


def test_ids_equal_the_tokenizers_library(reference):
    same(reference, TEXTS)


def test_ids_of_every_character(reference):
    same(reference, [EVERY[lo : lo + 1500] for lo in range(0, len(EVERY), 1500)])
    same(reference, [" ".join(EVERY[lo : lo + 3000]) for lo in range(0, 0x30000, 3000)])


def test_ids_of_random_texts(reference):
    draw = random.Random(5)
    letters = "aAbé ŉ'sSΣ́ͅİıẞ1٣<|endoftext|>!?=- "
    same(reference, ["".join(draw.choice(letters) for _ in range(draw.randint(0, 90))) for _ in range(3000)])
    same(reference, ["".join(draw.choice("abcdeinrst") for _ in range(n)) for n in (63, 64, 65, 66, 500, 20_000)])


def test_long_and_short_words_merge_alike(monkeypatch):
    draw = random.Random(6)
    words = ["".join(draw.choice("ainrst=!") for _ in range(draw.randint(1, 120))) for _ in range(800)]
    vocab = bpe.vocabulary()
    out = []
    for long in (0, 10**9):
        monkeypatch.setattr(bpe, "LONG", long)
        ids, size = bpe.word_ids(vocab, words)
        out.append((ids.tolist(), size.tolist()))
    assert out[0] == out[1]


def test_words_are_forgotten_without_effect(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    words = bpe.Words(bpe.vocabulary())
    texts = [f"w{i} the {i} house" for i in range(40)] * 2
    got = [words.encode([t])[0].tolist() for t in texts]
    assert got == [x.tolist() for x in encoded(texts)]


def test_digests_of_documents(spark, reference):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").repartition(3)
    rows = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    got = bpe.round_trip_digests(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = reference.encode(rows[r.doc_id], add_special_tokens=False).ids
        decoded = reference.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_defined_cases(spark, reference):
    schema = "doc_id long, text string, n_tokens string, ids int, decoded long"  # clashing names
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(TEXTS)] + [(None, "null id", None, None, None)]
    got = {r.doc_id: r for r in bpe.round_trips(spark.createDataFrame(rows, schema).repartition(2)).collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(TEXTS):
        ids = reference.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids
        assert got[i].decoded == reference.decode(ids, skip_special_tokens=False)
    assert got[None].n_tokens == 2
    assert bpe.round_trips(spark.createDataFrame([], schema)).count() == 0


def test_unordered_merges_are_refused(tmp_path, monkeypatch):
    import json

    path = public_tokenizers.path(bpe.TOKENIZER)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["merges"].reverse()
    other = tmp_path / "reversed.json"
    other.write_text(json.dumps(spec), encoding="utf-8")
    monkeypatch.setattr(public_tokenizers, "path", lambda name: str(other))
    with pytest.raises(ValueError, match="comes before"):
        bpe.Vocabulary("reversed.json")
