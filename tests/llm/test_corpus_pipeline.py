"""The corpus pipeline against a plain re-statement of its stages on planted documents."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid string, q_text int"


def prose(seed: int, n: int = 120) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeioulnrst") for _ in range(draw.randint(3, 8))) for _ in range(n))


ITEM = prose(10_000, 40)
CLEAN = list(range(40))
TEXTS = {
    **{i: prose(i) for i in CLEAN},
    100: None, 101: "", 102: "too short to keep",
    103: " ".join(["the same eight words come again and again"] * 30),  # repeats: a base rule
    104: " ".join(f"$${w}##" for w in prose(104).split()),  # symbols: a rule of the method
    110: prose(110), 111: prose(110), 112: prose(110) + " and a little more", 113: prose(110),  # copies
    120: prose(120, 50) + " " + ITEM + " " + prose(121, 50),  # a benchmark passage
    130: prose(130) + " password = hunter2hunter2 " + prose(131, 20),
}
GONE = {100, 101, 102, 103, 104, 120}


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", f"s{i % 4}", None if t is None else len(t), "u", 1) for i, t in TEXTS.items()]
    rows.append(rows[0])  # a repeated row
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_in_their_order():
    want = ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "packing"]
    assert [name for name, _ in corpus_pipeline.STAGES] == want


def test_every_row_is_accounted_for(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    copies = [110, 111, 112, 113]
    after_quality = sorted([0, *(i for i in TEXTS if i not in GONE | {120}), 120])
    assert kept["quality_rules"] == after_quality
    one_left = [i for i in kept["ngram_jaccard_join"] if i in copies]
    assert len(one_left) == 1
    assert kept["ngram_jaccard_join"] == sorted(set(after_quality) - set(copies) | set(one_left))
    assert kept["benchmark_decontamination"] == sorted(set(kept["ngram_jaccard_join"]) - {120})
    assert kept["secret_scans"] == kept["benchmark_decontamination"]
    texts = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    masked = TEXTS[130].replace("password = hunter2hunter2", "[REDACTED]")
    assert texts[130] == (masked, len(masked))
    assert all(texts[i] == (TEXTS[i], len(TEXTS[i])) for i in texts if i != 130)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
    assert sorted(pieces) == kept["secret_scans"]
    for i, own in pieces.items():
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in sorted(own, key=lambda p: p.start)]).tolist()
        assert ids == [*tokenizer.encode(texts[i][0], add_special_tokens=False).ids, 0]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
