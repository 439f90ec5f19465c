"""Token ids, packing and token counts against the tokenizers library itself."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from strata.llm import packing, token_counts, tokens  # noqa: E402
from tests.conftest import SF001  # noqa: E402

TEXTS = [None, "", "a", " ", "Hello  world\n\n", "<|endoftext|> é 日本 🙂\x0b", "a <|endoftext|> b", "<|endoftext|><|endoftext|>x<|endoftext", "\n <|endoftext|>\n\n", "x" * 70_000, "the of and " * 9000, "word " * 1023, "same", "same"]
SCHEMA = "doc_id long, text string, length string, ids int"


@pytest.fixture(scope="module")
def reference():
    loaded = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    return lambda t: loaded.encode(t or "", add_special_tokens=False).ids


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)


def test_ids_equal_the_tokenizers_library(spark, reference):
    texts = [t or "" for t in TEXTS] + [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    assert list(tokens.encoded(["a <|endoftext|> b"]))[0].tolist() == [64, 220, 50256, 275]
    for text, got in zip(texts, tokens.encoded(texts), strict=True):
        assert got.tolist() == reference(text)


@pytest.mark.parametrize("total", [0, 1, 5, 1023, 1024, 1025, 2048, 5000])
def test_binary_lengths(total):
    got = packing.binary_lengths(total)
    assert sum(got) == total and got == sorted(got, reverse=True)
    assert all(n <= 1024 and n & (n - 1) == 0 for n in got)
    assert all(got.count(n) == 1 for n in got if n < 1024)


def test_pieces_hold_every_id_once(spark, reference):
    docs = frame(spark, TEXTS).repartition(3)
    pieces = packing.packed(docs).collect()
    digests = {(r.sequence_id, r.ids_crc32, r.length) for r in packing.packed_digests(docs).collect()}
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        assert p.offset == 0 and p.length <= 1024 and p.length & (p.length - 1) == 0
        assert (p.sequence_id, zlib.crc32(p.ids), p.length) in digests
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    for i, text in enumerate(TEXTS):
        own = sorted(by_doc[i], key=lambda p: p.start)
        want = [*reference(text), 0]
        assert np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist() == want
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own][:-1]]).tolist()
        assert all(p.doc_tokens == len(want) for p in own)
    assert packing.packed(frame(spark, [])).count() == 0


def test_buckets_on_disk(spark, tmp_path):
    packing.write_buckets(packing.packed(frame(spark, TEXTS)), str(tmp_path / "out"))
    assert all(p.name.startswith("length=") for p in (tmp_path / "out").iterdir() if p.is_dir())


def test_counts_and_any_limit(spark, reference):
    texts = [*TEXTS, *[f"w{i} " * (i * 7 % 300) for i in range(150)]]
    lengths = np.array([len(reference(t)) for t in texts])
    sums = token_counts.with_sums(token_counts.length_histogram(frame(spark, texts)))
    rows = sums.collect()
    assert sorted(r.length for r in rows) == sorted(set(lengths.tolist()))
    for r in rows:
        longer = lengths[lengths > r.length]
        assert r.n_docs == (lengths == r.length).sum()
        assert (r.docs_longer, r.tokens_longer) == (len(longer), longer.sum())
        assert r.truncated_tokens == np.minimum(lengths, r.length).sum()
        assert (r.docs_total, r.tokens_total) == (len(lengths), lengths.sum())
        assert r.quantile == pytest.approx((lengths <= r.length).mean())
    limits = [0, 1, 2, 17, 512, 1000, 1024, 20_000, 10**6]
    for r in token_counts.at_limits(sums, limits).collect():
        assert r.docs_longer == (lengths > r.context_limit).sum()
        assert r.truncated_tokens == np.minimum(lengths, r.context_limit).sum()
    assert token_counts.length_at(sums, 0.5) == np.quantile(lengths, 0.5, method="inverted_cdf")
    assert token_counts.with_sums(token_counts.length_histogram(frame(spark, []))).count() == 0
