"""Quality rules against a plain re-statement, and the DuckDB form."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

from strata.llm import quality_rules as qr

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    t = text or ""
    ws = WORD.findall(t)
    seen = {}
    for i in range(len(ws) - 7):
        seen.setdefault(tuple(ws[i : i + 8]), []).append(i)
    covered = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(ws)
    return (
        n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


def texts():
    rng = random.Random(4)
    v = [f"é{i}" if i % 3 else f"w{i}" for i in range(40)]
    some = lambda n: " ".join(rng.choice(v) for _ in range(n))
    a = some(12)
    return [
        None, "", " \t\n\x0b\x0c\r", "one", some(19), some(20), some(8), a + " x " + a, a + " " + a + "\n" + a,
        "go " * 500, "\n".join([some(10)] * 3 + ["", " "] + [some(4)] * 2), some(4000) + " " + a + some(50) + " " + a,
        "# * $ % & | < >" * 9, "a b   c\x0bd\x0ce\rf", some(60), some(60).replace(" ", "\t\n"), ("😀 " * 30),
    ]


def frame(spark):
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, "x", i) for i, t in enumerate(texts())]
    rows.append(rows[7])
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words string, q_words int")


def test_base_columns_equal_plain_python(spark):
    got = qr.judged(frame(spark)).collect()
    assert len(got) == len(texts()) + 1
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts()[r.doc_id]), r.doc_id
        assert not (r.kept and r.base_failed)


def test_oracle_sql(spark):
    docs = frame(spark)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas())
    want = con.sql(qr.ORACLE_SQL).fetchall()
    got = [tuple(r) for r in qr.judged(docs).collect()]
    assert sorted(got) == sorted(want)


def test_bad_host_is_rejected_and_small_host_shrinks(spark):
    good, bad = " ".join(f"a{i}" for i in range(40)), "#### " * 3 + " ".join(f"$${i}" for i in range(40))
    rows = [(i, good, f"h{i % 9}") for i in range(900)] + [(1000 + i, bad, "spam") for i in range(95)]
    rows += [(2000 + i, good, "spam") for i in range(5)] + [(3000, bad, "tiny"), (3001, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in qr.judged(docs).where("kept").collect()}
    assert kept == set(range(900))  # a single bad page of a small host goes, the host is not condemned
    assert not any(2000 <= d < 2005 for d in kept)
    out = qr.passing(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == kept


def test_a_trusted_host_keeps_its_odd_pages_and_others_do_not(spark):
    good, odd = " ".join(f"a{i}" for i in range(40)), "#### " * 3 + " ".join(f"$${i}" for i in range(40))
    rows = [(i, good, "clean") for i in range(900)] + [(900, odd, "clean"), (901, "short", "clean")]
    rows += [(1000 + i, good if i % 3 else odd, f"m{i % 5}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in qr.judged(docs).where("kept").collect()}
    assert kept == set(range(901)) | {1000 + i for i in range(600) if i % 3}
    assert {r.doc_id for r in qr.passing(docs).collect()} == kept


def test_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(200_000))
    docs = spark.createDataFrame([(0, text, "a"), (1, text + " " + text, "a")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in qr.judged(docs).collect()}
    assert (got[0].n_words, got[0].n_repeat_words, got[0].kept) == (200_000, 0, True)
    assert (got[1].n_words, got[1].n_repeat_words, got[1].kept) == (400_000, 400_000, False)


def test_clashing_columns_and_empty_table(spark):
    docs = frame(spark)
    out = qr.passing(docs)
    assert out.schema == docs.schema
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in qr.judged(docs).where("kept").collect())
    assert qr.judged(docs.limit(0)).count() == 0 and qr.passing(docs.limit(0)).count() == 0


def test_main_path_runs_no_python(spark):
    plan = qr.judged(frame(spark).limit(0))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize(
    ("hosts", "want"),
    [([(100, 10)] * 5, "strong"), ([(100, 0)] * 3 + [(100, 90)], "weak"), ([], "none")],
)
def test_beta_prior(hosts, want):
    docs, failed = sum(n for n, _ in hosts), sum(k for _, k in hosts)
    p, strength = qr.beta_prior(len(hosts), docs, failed, sum(n * n for n, _ in hosts), sum(k * k / n for n, k in hosts))
    assert {"strong": strength > 900, "weak": strength < 3, "none": (p, strength) == (0.0, 1.0)}[want]
