"""Pages to plain lines: headings and paragraphs as text, tables as prose. One Python kernel over Arrow batches.

A table becomes ``Bảng [h1 | h2]:`` and a line ``h1: v1, h2: v2`` per row. Merged cells are spread over the grid; header rows
over several columns give ``Parent > Child`` names. Layout tables (with tables inside) are read as their inner tables.
Tables without any word, and image tables of word-processor forms, vanish.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import count, groupby, starmap, takewhile, zip_longest

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"\w")
_FORM = re.compile(r"file:///[^\s\"')]*(?:clip_image|msohtmlclip)", re.I)
_LINK = re.compile(r"!?\[([^\]]*)\]\([^)]*\)")
_BR = re.compile(r"<br\s*/?>", re.I)
_STRAY = re.compile(r"(?:\|\s*[-=: ]{2,}\s*)+\|")
_DOTS = re.compile(r"\.{4,}")
_SPACE = re.compile(r"[ \t\r\f\n]+")
_HIDDEN = {"script", "style", "head", "title", "template", "noscript"}
_VOID = {"br", "hr", "img", "input", "col", "meta", "link", "area", "base", "source", "wbr"}
_BLOCK = set("address article aside blockquote body caption center dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
#: What closes an element of the same kind that was left open.
_ENDS = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict | None = None) -> None:
        self.tag, self.attrs, self.kids = tag, attrs or {}, []

    def find(self, *tags: str) -> Iterator["Node"]:
        for k in self.kids:
            if isinstance(k, Node):
                if k.tag in tags:
                    yield k
                yield from k.find(*tags)

    def text(self) -> str:
        """All text below, the pieces of inner elements joined by spaces."""
        out: list[str] = []

        def go(n: Node) -> None:
            for k in n.kids:
                if isinstance(k, str):
                    out.append(k)
                elif k.tag not in _HIDDEN:
                    if k.tag in _BLOCK or k.tag == "br":
                        out.append(" ")
                    go(k)

        go(self)
        return _SPACE.sub(" ", "".join(out)).strip()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if ends := _ENDS.get(tag):
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in ends:
                    del self.open[i:]
                    break
                if self.open[i].tag in ("table", "ul", "ol", "dl", "div", "body"):
                    break
        n = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].kids.append(n)
        if tag not in _VOID:
            self.open.append(n)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].kids.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1].kids.append(data)


def parse(page: str) -> Node:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


def rows(table: Node) -> list[Node]:
    """The table's own rows, not those of tables within it."""
    out = []
    for k in table.kids:
        if isinstance(k, Node):
            out += [k] if k.tag == "tr" else [x for x in k.kids if isinstance(x, Node) and x.tag == "tr"] if k.tag in ("tbody", "thead", "tfoot") else []
    return out


def _span(cell: Node, name: str) -> int:
    got = cell.attrs.get(name) or "1"
    return max(1, int(got)) if re.fullmatch(r"\s*[+-]?\d+\s*", got) else 0


def laid_out(table: Node) -> Iterator[tuple[list[str], bool]]:
    """Each row of the table as texts by column, and whether one of its cells is over several columns.

    One sweep down the rows: ``hanging`` holds, by column, what cells above still reach into the rows to come.
    """
    hanging: dict[int, tuple[str, int]] = {}
    for tr in rows(table):
        now = {c: t for c, (t, _) in hanging.items()}
        hanging = {c: (t, n - 1) for c, (t, n) in hanging.items() if n > 1}
        free = (c for c in count() if c not in now)
        spread = False
        for cell in (k for k in tr.kids if isinstance(k, Node) and k.tag in ("td", "th")):
            over, down = _span(cell, "colspan"), _span(cell, "rowspan")
            if 0 in (over, down):  # not a number: neither counts
                over = down = 1
            text, first = cell.text(), next(free)
            reach = dict.fromkeys(range(first, first + over), text)
            now |= reach
            spread |= over > 1
            if down > 1:
                hanging |= dict.fromkeys(reach, (text, down - 1))
        yield [now.get(c, "") for c in range(max(now, default=-1) + 1)], spread


def grid(table: Node) -> list[list[str]]:
    """The table's texts by row and column, merged cells repeated, header rows folded into one row of names.

    Rows with a cell over several columns at the top are header parents, the row after them their leaves. Without such rows
    the first row is the header; a single row, or a table where every row has wide cells, stays as it is.
    """
    lines = list(laid_out(table))
    wide = list(takewhile(lambda x: x[1], lines))
    while lines and not lines[-1][0]:
        lines.pop()
    width = max((len(t) for t, _ in lines), default=0)
    flat = [t + [""] * (width - len(t)) for t, _ in lines]
    head, body = flat[: len(wide) + 1], flat[len(wide) + 1 :]
    if len(flat) < 2 or (wide and not body):
        return flat
    # a name is what stands in its column from the top down, neighbours that say the same once
    return [[" > ".join(t for t, _ in groupby(filter(None, map(str.strip, column)))) for column in zip(*head)], *body]


def shown(cell: str) -> str:
    """A cell without markdown links, images and line breaks."""
    return _BR.sub(" ", _LINK.sub(r"\1", cell)).strip()


def _told(name: str, value: str) -> str:
    """A value under its name; a name with words but without a value keeps its place."""
    if _WORD.search(value):
        return f"{name}: {value}" if name else value
    return f"{name}: " if _WORD.search(name) else ""


def prose(head: list[str], body: list[list[str]]) -> list[str]:
    """Lines of a table: its header, then each row with words in it. A table without any word has none."""
    names = [shown(h) for h in head]
    title = " | ".join(filter(_WORD.search, names))
    said = [row for row in ([shown(x) for x in cells] for cells in body) if any(map(_WORD.search, row))]
    lines = [", ".join(filter(None, starmap(_told, zip_longest(names, row, fillvalue="")))) for row in said]
    return [f"Bảng [{title}]:", *lines] if title else lines


def pipe_prose(block: list[str]) -> list[str]:
    """Lines of a markdown table, given as lines that begin with a pipe; none for the image table of a form."""
    if _FORM.search("\n".join(block)):
        return []
    head, *body = ([x.strip() for x in line.split("|")[1:-1]] for line in block)
    ruled = bool(body) and not "".join(body[0]).strip(" -:")
    return prose(head, body[ruled:])


def tables_to_prose(md: str) -> str:
    """Markdown with every run of table lines turned into prose."""
    runs = groupby(md.split("\n"), key=lambda line: line.startswith("|"))
    return "\n".join(x for is_table, lines in runs for x in (pipe_prose(list(lines)) if is_table else lines))


def post_clean(md: str) -> str:
    return _DOTS.sub("", _STRAY.sub("", _BR.sub(" ", md)))


def _lines(n: Node, out: list[str]) -> None:
    buf: list[str] = []

    def flush() -> None:
        for line in "".join(buf).split("\n"):
            if x := _SPACE.sub(" ", line).strip():
                out.append(x)
        buf.clear()

    def go(k) -> None:
        if isinstance(k, str):
            buf.append(_SPACE.sub(" ", k))
        elif k.tag in _HIDDEN:
            return
        elif k.tag == "br":
            buf.append("\n")
        elif k.tag == "table":
            flush()
            if next(k.find("table"), None) is not None:
                _lines(k, out)
            elif not any(_FORM.search(i.attrs.get("src", "")) for i in k.find("img")):
                g = grid(k)
                out.extend(prose(g[0], g[1:]) if g else [])
        elif k.tag in _BLOCK:
            flush()
            for x in k.kids:
                go(x)
            flush()
        else:
            for x in k.kids:
                go(x)

    for k in n.kids:
        go(k)
    flush()


def convert(page: str | None) -> str:
    """The text of a page; '' for null and empty ones."""
    if not page:
        return ""
    out: list[str] = []
    _lines(parse(page), out)
    return post_clean(tables_to_prose("\n".join(out)))


def converted(df: DataFrame, html_col: str = "content_html") -> DataFrame:
    """``df`` with ``markdown`` and ``convert_error``: a page that cannot be read gives '' and says why."""
    names = [f.name for f in df.schema.fields]
    schema = df.drop("markdown", "convert_error").select(*names).schema.add("markdown", "string").add("convert_error", "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            md, err = [], []
            for h in p[html_col]:
                try:
                    md.append(convert(h))
                    err.append(None)
                except Exception as e:
                    md.append("")
                    err.append(f"{type(e).__name__}: {e}"[:200])
            yield p.assign(markdown=md, convert_error=err)

    return df.mapInPandas(run, schema)


def post_cleaned(c: Column) -> Column:
    """The same cleaning as an expression, for markdown already in a table."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", " "), r"(?:\|\s*[-=: ]{2,}\s*)+\|", ""), r"\.{4,}", "")
