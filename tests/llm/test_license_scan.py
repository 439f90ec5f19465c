"""License scans: cosines by hand, inheritance, and the DuckDB form on given documents."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import pytest

from strata.llm import license_scan as ls
from strata.llm import license_templates as lt
from tests.conftest import SF001

SCHEMA = "doc_id long, path string, text string, license int, uid string"


def plain_terms(text):
    return [t for t in (re.sub(r"^[.+-]+|[.+-]+$", "", x) for x in re.split(r"[^a-z0-9.+-]+", text.lower())) if t]


def plain_cosine(passage, name):
    docs = [Counter(plain_terms(t)) for _, t in ls.TEMPLATES]
    df = Counter(t for c in docs for t in c)
    idf = lambda t: math.log((1 + len(docs)) / (1 + df[t])) + 1
    vec = lambda c: {t: n * idf(t) for t, n in c.items()}
    a = vec(Counter(plain_terms(passage)))
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    own = [vec(c) for (n, _), c in zip(ls.TEMPLATES, docs, strict=True) if n == name]
    return max(sum(w * b.get(t, 0) for t, w in a.items()) / (norm(a) * norm(b)) for b in own)


def run(spark, files):
    docs = spark.createDataFrame([(i, p, t, 0, "u") for i, (p, t) in enumerate(files)], SCHEMA)
    return {r.doc_id: r for r in ls.licenses(docs).collect()}


def test_best_template_and_cosine(spark):
    mit, gpl = "Released under the MIT License.", "some prose\nThis work is licensed under the GNU General Public License, version 2.\nmore"
    got = run(spark, [("a.txt", mit), ("b.txt", gpl), ("c.txt", "the word license in a long line of other prose about many things"), ("d", mit + "\n" + gpl)])
    assert (got[0].license, got[0].origin, got[0].score) == ("MIT", "own", 1.0)
    assert got[1].license == "GPL-2.0" and got[1].score == pytest.approx(plain_cosine(gpl.split("\n")[1], "GPL-2.0"), abs=1e-6)
    assert (got[2].license, got[2].origin) == (None, "none")
    assert got[3].license == "GPL-2.0"  # cosines tie at 1: the first by name


def test_nearest_ancestor_directory(spark):
    text = dict(ls.TEMPLATES)
    files = [
        ("LICENSE", text["MIT"]), ("a/LICENSE.md", text["ISC"]), ("a/b/c/COPYING", text["GPL-3.0"]), ("a/b/c/LICENCE", "license unknown to all"),
        ("x.py", "x"), ("a/x.py", None), ("a/b/x.py", ""), ("a/b/c/x.py", "x"), ("a/b/c/d/e/x.py", "x"), ("ab/x.py", text["Apache-2.0"]),
        (None, "x"), (None, text["MIT"]), ("a/b/c/x.py", "x"),
    ]
    got = run(spark, files)
    assert [got[i].license for i in range(13)] == [
        "MIT", "ISC", "GPL-3.0", "GPL-3.0", "MIT", "ISC", "ISC", "GPL-3.0", "GPL-3.0", "Apache-2.0", None, "MIT", "GPL-3.0",
    ]
    assert [got[i].from_directory for i in (4, 6, 8, 9, 10)] == ["", "a", "a/b/c", None, None]


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_oracle_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    key = lambda r: tuple(str(x) for x in r)
    got = sorted((tuple(r) for r in ls.licenses(ls.as_files(docs)).collect()), key=key)
    assert got == sorted(con.sql(ls.ORACLE_SQL).fetchall(), key=key)
    assert {r[4] for r in got} == {"own", "inherited", "none"}


def test_main_path_runs_no_python(spark):
    docs = spark.createDataFrame([], SCHEMA)
    plan = ls.licenses(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


GPL_3 = """ * Copyright 2020 Somebody
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details."""
HASH_LINES = lambda text: "#!/bin/sh\n\n# " + "\n# ".join(text.split(". ")) + "\n\necho hello to all of these many other words\n"


@pytest.mark.parametrize("kind", ["x.c", "LICENSE"])
def test_usual_statements_headers_and_whole_texts(spark, kind):
    cases = [
        ("SPDX-License-Identifier: MIT", "MIT"),
        ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("# SPDX-License-Identifier: GPL-2.0-or-later\nimport os", "GPL-2.0"),
        ("Mozilla Public License Version 2.0", "MPL-2.0"),
        ("BSD 3-Clause License", "BSD-3-Clause"),
        (lt.MIT_GRANT, "MIT"),
        ("MIT License\n\nCopyright (c) 2021 Somebody\n\n" + lt.MIT_GRANT + "\n\n" + lt.MIT_REST, "MIT"),
        ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-3.0"),
        ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "GPL-2.0"),
        ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "LGPL-3.0"),
        ("GNU GENERAL PUBLIC LICENSE", "GPL-1.0-or-later"),
        (GPL_3, "GPL-3.0"),
        ("# some code\n# GNU General Public License,\n# version 2\n# more code in many other words", "GPL-2.0"),
        ("Copyright 2020\n\n" + lt.BSD_TWO.replace(": 1.", ":\n\n1.").replace(". 2.", ".\n\n2.") + "\n\n" + lt.BSD_THREE + "\n\n" + lt.BSD_REST, "BSD-3-Clause"),
        ("Copyright 2020\n\n" + lt.BSD_TWO.replace(": 1.", ":\n\n1.").replace(". 2.", ".\n\n2.") + "\n\n" + lt.BSD_REST, "BSD-2-Clause"),
        (HASH_LINES(lt.APACHE_GRANT + "\n#\n" + lt.APACHE_LIMITS), "Apache-2.0"),
        ("This project is licensed under the terms of the MIT license.", "MIT"),
        ("All rights reserved.", None),
        ("Copyright (c) 2020 Somebody. All rights reserved.", None),
        ("SPDX-License-Identifier: LicenseRef-Own", None),
        ("see the license of the other house", None),
        ("permission is hereby refused\n\n\n\nno redistribution\n\n", None),
        ("word " * 40_000 + "\nReleased under the MIT License.\n" + "licence word " * 20_000, "MIT"),
    ]
    got = run(spark, [(f"{i}/{kind}", text) for i, (text, _) in enumerate(cases)])
    assert [(i, got[i].license) for i in range(len(cases))] == [(i, want) for i, (_, want) in enumerate(cases)]


def test_every_template_is_its_own_license(spark):
    rows = ls.TEMPLATES
    got = run(spark, [(f"{i}.txt", text + "\n") for i, (_, text) in enumerate(rows)])
    for i, (name, text) in enumerate(rows):
        if re.search(ls.CUE, text):
            assert got[i].license == name and got[i].score == pytest.approx(1), text


def test_oracle_on_headers_of_many_blocks(spark):
    texts = [GPL_3, "a\n\n\n\nlicense b\n\ncopyright\nc\n\nd\n\nspdx e", lt.MIT_GRANT + "\n \n" + lt.MIT_REST, None, "", "license\r\n\r\nlicense"]
    rows = [(2 * i + j, t, f"s{i % 2}") for i, t in enumerate(texts) for j in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    key = lambda r: tuple(str(x) for x in r)
    got = sorted((tuple(r) for r in ls.licenses(ls.as_files(docs)).collect()), key=key)
    assert got == sorted(con.sql(ls.ORACLE_SQL).fetchall(), key=key)
