"""HTML rendering on small pages, one rule each, and on the given pages."""

from __future__ import annotations

import html as entities
import random
import re
import time

import pytest

from strata.llm import html_text
from strata.llm.html_text import extracted, html_to_text
from tests.conftest import SF001

CASES = {
    "implied paragraphs": ("<p>One<p>two<div>three</div>four", "One\n\ntwo\n\nthree\nfour"),
    "white space": ("  a \n b <b> c</b>d <i>e</i> ", "a b cd e"),
    "break": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "head is unseen": ("<head><title>t</title><style>p{}</style><script>x</p></script><body>y", "y"),
    "head ends by a block": ("<head><title>t</title><p>y", "y"),
    "hidden": ('<p hidden>a</p><p style="x:1; display : none">b</p><input type=hidden><div>c<span style="visibility:hidden">d</span></div>', "c"),
    "comment and entity": ("a<!-- b -->c &amp; &copy; &#x41; &bogus;", "ac & © A &bogus;"),
    "bullets": ("<ul><li>a<li>b<ul><li>c</ul></ul>d", "* a\n* b\n  * c\n\nd"),
    "numbers": ('<ol start="9"><li>a<li>b<p>c</ol>', "9. a\n10. b\n\n    c"),
    "definitions": ("<dl><dt>a<dd>b<dt>c</dl>", "a\n    b\nc"),
    "preformatted": ("x<pre>\na  b\n  c\n</pre>y", "x\n\na  b\n  c\n\ny"),
    "aligned cells": ("<table><tr><th>ab<th>c<tr><td>d<td>ef<td>g</table>z", "ab  c\nd   ef  g\n\nz"),
    "cell lines": ("<table><tr><td>a<br>bb<td>c</table>", "a   c\nbb"),
    "spanned columns": ("<table><tr><td colspan=2>long one<td>x<tr><td>a<td>b<td>c</table>", "long one  x\na  b      c"),
    "spanned rows": ("<table><tr><td rowspan=2>aa<td>b<td>c<tr><td>d<td>e<tr><td>f</table>", "aa  b  c\n    d  e\nf"),
    "broken spans": ("<table><tr><td colspan=x rowspan=-1>a<td colspan=0>b<tr><td>c<td>d</table>", "a  b\nc  d"),
    "table in a cell": ("<table><tr><td><table><tr><td>a<td>b</table><td>c</table>", "a  b  c"),
    "stray end tags": ("</p></table>a</b><td>b", "ab"),
    "alt text": ('<img alt="a  b">c', "a bc"),
    "empty": ("", ""),
    "open tag at the end": ("a <b", "a"),
    "open tags at the end": ("1 < 2 <i>a</i> <b x <c", "1 < 2 a"),
}


@pytest.mark.parametrize("name", CASES)
def test_rule(name):
    html, want = CASES[name]
    assert html_to_text(html) == want


def test_null_and_rows(spark):
    pages = spark.createDataFrame([(1, None, "t"), (2, "<p>a", "t"), (2, "<p>a", "t"), (None, "", "t")], "page_id long, html string, text string")
    assert sorted(((r.page_id, r.text) for r in extracted(pages).collect()), key=repr) == [(1, None), (2, "a"), (2, "a"), (None, "")]
    assert extracted(pages.limit(0)).count() == 0


def test_deep_and_long_pages_stay_linear():
    begin = time.time()
    assert html_to_text("<div>" * 20_000 + "x") == "x"
    assert html_to_text("<li>" * 20_000 + "x").endswith("x")
    assert html_to_text("<b>" * 20_000 + "</i>" * 20_000 + "x") == "x"
    assert len(html_to_text("word " * 400_000)) == 1_999_999
    assert time.time() - begin < 60


def test_given_pages_keep_every_visible_word(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in extracted(pages).collect():
        body = html[r.page_id].partition("</head>")[2]
        words = re.sub(r"<!--.*?-->", "", body, flags=re.S)
        words = entities.unescape(re.sub(r"<[^<>]*(>|$)", " ", words)).split()
        assert [w for w in r.text.split() if w != "*"] == [w for w in words if w != "*"]


SHAPES = {
    "inline around items": lambda n: "<b>" * n + "<li>x" * n,
    "deep quotes": lambda n: "<blockquote>w" * n,
    "one wide cell": lambda n: "<table><tr><td>" + "x" * 4 * n + "<tr><td>a<td>b" * n,
    "deep tables": lambda n: "<table><tr><td>a" * n,
    "wide row, many lines": lambda n: "<table><tr>" + "<td>a" * n + "b<br>" * n,
    "spans": lambda n: "<table>" + "<tr><td colspan=1000 rowspan=1000>a<td>b" * n,
    "unfinished tags": lambda n: "x" + "<a " * n,
}


@pytest.mark.parametrize("name", SHAPES)
def test_time_and_text_stay_proportional(name):
    """No shape makes text of more than MOST_LINE columns a tag, and none is quadratic."""
    page = SHAPES[name](100_000)
    begin = time.time()
    text = html_to_text(page)
    assert time.time() - begin < 40
    assert len(text) < html_text.MOST_LINE * page.count("<") + len(page)
    letters = re.sub(r"<[^>]*(>|$)", "", page)
    assert sum(map(text.count, "abwx")) == sum(map(letters.count, "abwx"))


class PlainBuilder(html_text.Builder):
    """The same rules by scans of all open elements, innermost first."""

    def _close(self, to):
        del self.open[to:]

    def _outermost(self, tags, stop):
        found = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                found = i
            elif self.open[i].tag in stop:
                break
        return found

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                return self._close(i)
            if self.open[i].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                return None


def tree(node):
    return node if isinstance(node, str) else (node.tag, [tree(c) for c in node.children])


def soup(rng):
    tags = "p li ul ol div b table tr td th tbody dl dt dd select option head body a blockquote".split()
    parts = []
    for i in range(rng.randrange(60)):
        tag = rng.choice(tags)
        parts.append(rng.choice([f"<{tag}>", f"<{tag}>", f"</{tag}>", f"w{i} ", f"<{tag} colspan={rng.randrange(4)} rowspan={rng.randrange(4)}>"]))
    return "".join(parts)


def test_tree_equals_plain_scans_and_every_word_is_shown():
    rng = random.Random(5)
    for _ in range(3000):
        page = soup(rng)
        fast, plain = html_text.Builder(), PlainBuilder()
        fast.feed(page), plain.feed(page)
        fast.close(), plain.close()
        assert tree(fast.root) == tree(plain.root), page
        if "<head" not in page:
            shown = re.findall(r"w\d+", html_to_text(page))
            assert sorted(shown) == sorted(re.findall(r"w\d+", page)), page


def plain_grid(rows):
    """(row, column) of each cell by marking every slot of the table."""
    taken, out = set(), []
    for r, row in enumerate(rows):
        c, line = 0, []
        for cell in row:
            while (r, c) in taken:
                c += 1
            line.append(c)
            taken |= {(y, x) for y in range(r, r + cell.rows) for x in range(c, c + cell.columns)}
            c += cell.columns
        out.append(line)
    return out


def test_columns_equal_a_marked_grid():
    rng = random.Random(6)
    for _ in range(500):
        rows = [[html_text.Cell(["x"], rng.randrange(1, 4), rng.randrange(1, 4)) for _ in range(rng.randrange(5))] for _ in range(rng.randrange(6))]
        assert [[at for at, _ in line] for line in html_text._placed(rows)] == plain_grid(rows)
