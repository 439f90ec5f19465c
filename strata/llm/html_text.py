"""Visible text of HTML pages, laid out as a text browser shows it.

A small tree builder on the standard tokenizer closes implied tags (``<p>``
before a block, ``<li>``, table cells and rows, options, definition lists) and
drops what is never shown: scripts, styles, the head, elements hidden by an
attribute or an inline style. Rendering walks the tree once: blocks start new
lines, paragraphs and headings keep a blank line between them, lists are
indented and numbered or bulleted, preformatted text keeps its spaces, and the
cells of a table are padded to common columns, which ``colspan`` and ``rowspan``
fill as the standard says. All visible text is emitted, navigation and footers
included; choosing the main content is another task.

Padding is bounded, text never is: a block is indented by MOST_INDENT columns at
most; a cell wider than MOST_CELL does not widen its column; what would begin
beyond MOST_LINE, or beyond the first MOST_COLUMNS columns, follows two spaces
after the text before it; tables nested deeper than MOST_TABLES show each cell on
lines of its own. So the text stays proportional to the page.

Both passes run without recursion; open elements are found by tag, so time is
linear in the page but for a logarithm. Cases: null html gives null; empty,
text-only or broken markup renders what a browser would show; unclosed elements
end with their parent; repeated rows are rendered each; an empty table gives an
empty result; very long pages are read whole; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values of the HTML standard: which elements have no end tag, are never
# shown, break the line, or keep a blank line around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript title iframe object svg canvas audio video datalist".split())
RAW = frozenset("script style".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tr ul".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
ENDS_PARAGRAPH = BLOCK - {"body", "html", "legend", "li", "optgroup", "option", "tr", "dd", "dt", "summary"}
# An open element of the second group ends when the first begins, up to the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
CELL_ENDS = frozenset("table tr tbody thead tfoot".split())  # end tags that reach out of a table cell
MOST_INDENT = 40
MOST_CELL = 80
MOST_LINE = 200
MOST_COLUMNS = 100
MOST_TABLES = 8
SPACE = re.compile(r"[ \t\n\r\f]+")
TAG_BEGINS = re.compile(r"<[a-zA-Z/!?]")
HIDDEN_STYLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str | None]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []

    def seen(self) -> bool:
        a = self.attrs
        return not (
            self.tag in UNSEEN
            or "hidden" in a
            or (a.get("type") or "").lower() == "hidden"
            or HIDDEN_STYLE.search(a.get("style") or "")
        )


class Builder(HTMLParser):
    """The tree of a page; children are nodes and strings."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # places of the open elements by tag

    def _close(self, to: int) -> None:
        for node in self.open[to:]:
            self.places[node.tag].pop()
        del self.open[to:]

    def _innermost(self, tags: set[str] | frozenset[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _outermost(self, tags: set[str] | frozenset[str], stop: set[str]) -> int | None:
        """Outermost open element of ``tags`` above the innermost of ``stop``."""
        floor = self._innermost(stop)
        own = [self.places[t] for t in tags if self.places.get(t)]
        return min((at[bisect_right(at, floor)] for at in own if at[-1] > floor), default=None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            self.root.attrs.update(attrs)
            return
        if tag in IMPLIED and (at := self._outermost(*IMPLIED[tag])) is not None:
            self._close(at)
        if tag in ENDS_PARAGRAPH and (at := self._outermost({"p"}, {"td", "th", "li", "div", "button", "table"})) is not None:
            self._close(at)
        if tag in BLOCK and (at := self._outermost({"head"}, set())) is not None:
            self._close(at)
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def handle_endtag(self, tag: str) -> None:
        if self.places.get(tag):
            at = self.places[tag][-1]
            if tag in CELL_ENDS or self._innermost({"td", "th", "table"}) <= at:
                self._close(at)

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


class Page:
    """Lines of a block; white space between words is kept once."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = False  # a space waits for the next word
        self.blank = False  # an empty line waits for the next line
        self.prefix = ""
        self.mark = ""  # bullet or number of the next line

    def text(self, data: str) -> None:
        for i, word in enumerate(SPACE.split(data)):
            self.gap = self.gap or i > 0
            if word:
                if self.gap and self.parts:
                    self.parts.append(" ")
                self.parts.append(word)
                self.gap = False

    def line(self, raw: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        mark, self.mark = self.mark, ""
        lead = self.prefix[: max(0, len(self.prefix) - len(mark))] + mark if mark else self.prefix
        self.lines.append((lead + raw).rstrip())

    def end_line(self) -> None:
        if self.parts:
            self.line("".join(self.parts))
            self.parts = []
        self.gap = False

    def space(self) -> None:
        self.end_line()
        self.blank = True


class Cell(NamedTuple):
    lines: list[str]
    columns: int
    rows: int


def _span(value: str | None, most: int) -> int:
    """A span attribute; a missing or broken one is 1, and 0 is as many as there are."""
    value = (value or "").strip()
    if not re.fullmatch(r"\d{1,9}", value):
        return 1
    return min(int(value), most) or most


def _placed(rows: list[list[Cell]]) -> list[list[tuple[int, Cell]]]:
    """Each cell with its column: the first one that no cell of an earlier row still fills."""
    busy = [0] * MOST_COLUMNS  # rows for which a column is filled from above
    out = []
    for row in rows:
        at, line, fresh = 0, [], {}
        for cell in row:
            while at < MOST_COLUMNS and busy[at]:
                at += 1
            line.append((at, cell))
            end = min(at + cell.columns, MOST_COLUMNS)
            fresh.update((c, max(busy[c], cell.rows)) for c in range(at, end) if cell.rows > 1)
            at = end
        for c, many in fresh.items():
            busy[c] = many
        busy = [max(0, many - 1) for many in busy]
        out.append(line)
    return out


def _column_places(rows: list[list[tuple[int, Cell]]]) -> list[int]:
    """Where each column begins; one that no cell begins in takes no room."""
    width: dict[int, int] = {}
    spanning = []
    for row in rows:
        for at, cell in row:
            longest = max(map(len, cell.lines))
            used = longest if longest <= MOST_CELL else 0
            width[at] = max(width.get(at, 0), used if cell.columns == 1 else 0)
            if cell.columns > 1 and used:
                spanning.append((at, cell.columns, used))
    for at, columns, used in spanning:
        inside = [c for c in range(at, min(at + columns, MOST_COLUMNS)) if c in width]
        if inside:
            room = sum(width[c] + 2 for c in inside) - 2
            width[inside[-1]] += max(0, used - room)
    places = [0]
    for c in range(MOST_COLUMNS):
        places.append(min(MOST_LINE, places[-1] + (width[c] + 2 if c in width else 0)))
    return places


def _table_lines(rows: list[list[Cell]]) -> list[str]:
    """Cells from the places of their columns on; a cell's own lines share its column."""
    placed = _placed(rows)
    begins = _column_places(placed)
    lines = []
    for row in placed:
        k, left = 0, row
        while left:
            parts, length = [], 0
            for at, cell in left:
                if cell.lines[k]:
                    pad = max(begins[at] - length, 2 if length else 0)
                    parts += [" " * pad, cell.lines[k]]
                    length += pad + len(cell.lines[k])
            lines.append("".join(parts).rstrip())
            k += 1
            left = [(at, cell) for at, cell in left if len(cell.lines) > k]
    return lines


def render(root: Node) -> str:
    """Text of the tree. Work items are nodes, strings and closing actions; a
    table cell is rendered on a page of its own."""
    page = Page()
    pages, tables, lists = [], [], []
    todo: list = [root]

    def opened(node: Node) -> list:
        """Enter an element; the actions that leave it, to run after its children."""
        nonlocal page
        tag, after = node.tag, []
        if tag == "br":
            if page.parts:
                page.end_line()
            else:
                page.line("")
        elif tag == "hr":
            page.end_line()
            page.line("---")
        elif tag == "img":
            page.text(node.attrs.get("alt") or "")
        elif tag in ("td", "th") and tables and tables[-1] is None:
            page.end_line()
            after = [lambda: page.end_line()]
        elif tag in ("td", "th") and tables:
            pages.append(page)
            page = Page()
            after = [lambda: cell(node)]
        elif tag in BLOCK:
            (page.space if tag in SPACED and not (tag in ("ul", "ol") and lists) else page.end_line)()
            old = page.prefix
            if tag in ("ul", "ol"):
                start = (node.attrs.get("start") or "1").strip()
                lists.append(int(start) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", start) else 1 if tag == "ol" else None)
                after.append(lists.pop)
            elif tag == "li":
                mark = "* "
                if lists and lists[-1] is not None:
                    mark = f"{lists[-1]}. "
                    lists[-1] += 1
                page.prefix, page.mark = (old + " " * len(mark))[:MOST_INDENT], mark
            elif tag in ("blockquote", "dd"):
                page.prefix = (old + "    ")[:MOST_INDENT]
            elif tag == "table":
                tables.append([] if len(tables) < MOST_TABLES else None)
                after.append(lambda: table())
            elif tag == "tr" and tables and tables[-1] is not None:
                tables[-1].append([])
            spaced = tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1)
            after.append(lambda: leave(old, spaced))
        return after

    def leave(old: str, spaced: bool) -> None:
        (page.space if spaced else page.end_line)()
        page.prefix, page.mark = old, ""

    def cell(node: Node) -> None:
        nonlocal page
        page.end_line()
        lines, page = page.lines or [""], pages.pop()
        if not tables[-1]:
            tables[-1].append([])
        spans = _span(node.attrs.get("colspan"), MOST_COLUMNS), _span(node.attrs.get("rowspan"), 1 << 16)
        tables[-1][-1].append(Cell(lines, *spans))

    def table() -> None:
        page.end_line()
        for line in _table_lines(tables.pop() or []):
            page.line(line)

    while todo:
        item = todo.pop()
        if isinstance(item, str):
            page.text(item)
        elif isinstance(item, Node):
            if not item.seen():
                continue
            after = opened(item)
            if item.tag == "pre":
                todo += after[::-1]
                raw = [c for c in _strings(item)]
                for line in "".join(raw).removeprefix("\n").removesuffix("\n").split("\n"):
                    page.line(line)
                continue
            todo += after[::-1]
            todo += item.children[::-1]
        else:
            item()
    page.end_line()
    return "\n".join(page.lines).strip("\n")


def _strings(node: Node) -> list[str]:
    """All visible strings below a node, in order."""
    out, todo = [], [*node.children[::-1]]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.tag == "br":
            out.append("\n")
        elif item.seen():
            todo += item.children[::-1]
    return out


def html_to_text(html: str | None) -> str | None:
    if html is None:
        return None
    builder = Builder()
    cut_off = TAG_BEGINS.search(html, html.rfind(">") + 1)  # by the end of the page: never shown
    builder.feed(html[: cut_off.start()] if cut_off else html)
    builder.close()
    return render(builder.root)


@F.pandas_udf(StringType())
def visible_text(html: pd.Series) -> pd.Series:
    return pd.Series([html_to_text(x) for x in html], dtype=object)


def extracted(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text): one row per page."""
    return pages.select(F.col(f"`{id_col}`").alias("page_id"), visible_text(F.col(f"`{html_col}`").cast("string")).alias("text"))
