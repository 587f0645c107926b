"""Whole Markdown and AsciiDoc documents as tree nodes.

Lines are classed by column functions; a walk over each document's lines keeps what is open: lists by indent,
a fence, a table, a paragraph. Nodes are those of ``operators.tree``, with ``format`` (b, i or c for bold, italic and code) and ``href``.
A table's text is its rows, cells between bars, which ``table_cells`` takes apart.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import shortened_underscores
from vellum.operators.grouped import each_group

NODES = "doc_id bigint, node_id bigint, parent_id bigint, child_ix bigint, label string, layer string, level bigint, page_no bigint, text string, format string, href string"


class Nodes:
    """The nodes of one document, numbered as they come."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, label: str, text: str = "", parent: int | None = None, level: int = 0, format: str | None = None, href: str | None = None) -> int:  # noqa: A002
        at = len(self.rows)
        self.rows.append((at, parent, at, label, "body", level, 1, text, format, href))
        return at


#: Spans within a line: picture, link, code, bold, italic.
SPANS = re.compile(r'!\[([^\]]*)\]\(\s*([^)\s]*)(?:\s+"([^"]*)")?\s*\)|\[([^\]]*)\]\(\s*([^)\s]*)[^)]*\)|(`+)(.+?)\6|\*\*(?=\S)(.+?)\*\*|__(?=\S)(.+?)__|\*(?=[^\s*])([^*]+)\*|(?<![\w\\])_(?=[^\s_])([^_]+)_(?!\w)')


def plain(text: str) -> str:
    """Text without backslash escapes and entities."""
    return html.unescape(re.sub(r"\\([!-/:-@\[-`{-~])", r"\1", text))


def spans(line: str) -> list[tuple]:
    """(label, text, format, href) of the spans of a line; a picture's text is its title."""
    out, at = [], 0
    for m in SPANS.finditer(line):
        if before := line[at : m.start()].strip():
            out.append(("text", plain(before), None, None))
        at = m.end()
        if m[0].startswith("!"):
            out.append(("picture", plain(m[3] or ""), None, m[2]))
        elif m[0].startswith("["):
            out.append(("text", plain(m[4]), None, m[5]))
        elif m[6]:
            out.append(("code", m[7].strip(), "c", None))
        else:
            out.append(("text", plain(m[8] or m[9] or m[10] or m[11]), "b" if m[8] or m[9] else "i", None))
    if rest := line[at:].strip():
        out.append(("text", plain(rest), None, None))
    return out


class MarkdownWalk(Nodes):
    """Lines (kind, indent, marker, text, line) to nodes."""

    def __init__(self) -> None:
        super().__init__()
        self.lists: list[tuple[int, int, int]] = []  # (indent, list node, its last item)
        self.lines: list[str] = []
        self.kind = ("text", 0)
        self.table: list[str] = []
        self.fence: str | None = None
        self.code: list[str] = []
        self.blank = False

    @property
    def parent(self) -> int | None:
        return self.lists[-1][2] if self.lists else None

    def flow(self, label: str, level: int, lines: list[str], parent: int | None) -> int | None:
        """A block of text: one node, or for several spans a node without a text and a group of them."""
        parts = [s for line in lines for s in spans(line)]
        if len(parts) == 1 and parts[0][0] == "text":
            return self.add(label, parts[0][1], parent, level, *parts[0][2:])
        top = self.add(label, "", parent, level) if label != "text" else None
        group = parent if top is None else top
        if len(parts) > 1:
            group = self.add("inline", "", group)
        for kind, text, form, href in parts:
            if kind == "picture":
                at = self.add("picture", "", group, href=href)
                if text:
                    self.add("caption", text, at)
            else:
                self.add(kind, text, group, 0, form, href)
        return top

    def close_text(self) -> None:
        if self.lines:
            lines, (label, level) = self.lines, self.kind
            self.lines, self.kind = [], ("text", 0)
            at = self.flow(label, level, lines, self.lists[-1][1] if label == "list_item" else self.parent)
            if label == "list_item":
                self.lists[-1] = (*self.lists[-1][:2], at)

    def close_table(self) -> None:
        rows, self.table = self.table, []
        cells = [r.strip() for r in rows]
        if any(len(r.split("|")) > 2 for r in cells):
            self.close_text()
            self.add("table", "\n".join(plain(r) for i, r in enumerate(cells) if i != 1 or r.strip("|:- ")), self.parent)
        else:
            self.lines += rows

    def close(self) -> None:
        self.close_table() if self.table else None
        self.close_text()

    def close_code(self) -> None:
        code, self.code, self.fence = "\n".join(self.code).strip(), [], None
        if code:
            self.add("code", code, self.parent)

    def item(self, indent: int, marker: str, text: str) -> None:
        self.close()
        while self.lists and indent < self.lists[-1][0]:
            self.lists.pop()
        kind = "list" if marker in "-*+" else "ordered_list"
        if not self.lists or indent > self.lists[-1][0] + 1:
            self.lists.append((indent, self.add(kind, "", self.parent), -1))
        elif self.rows[self.lists[-1][1]][3] != kind:
            self.lists.pop()
            self.lists.append((indent, self.add(kind, "", self.parent), -1))
        self.kind, self.lines = ("list_item", 0), [text]

    def line(self, kind: str, indent: int, marker: str, text: str, line: str) -> None:
        if self.fence is not None:
            if kind == "fence" and marker.startswith(self.fence) and not text:
                self.close_code()
            else:
                self.code.append(line)
            return
        if kind != "code" and self.code:
            self.close_code()
        if kind == "blank":
            self.close()
        elif kind == "fence":
            self.close()
            self.fence = marker
        elif kind == "heading":
            self.close()
            self.lists = []
            level = len(marker) - 1
            self.flow("title" if level == 0 else "section_header", level, [text], None)
        elif kind == "underline" and self.lines and self.kind[0] == "text" and not self.table:
            lines, self.lines, self.lists = self.lines, [], []
            self.flow("title" if marker == "=" else "section_header", int(marker == "-"), lines, None)
        elif kind == "list_item":
            self.item(indent, marker, text)
        elif kind == "rule" or (kind == "underline" and marker == "-"):
            self.close()
            self.lists = []
        elif kind == "code" and not self.lines and not self.lists:
            self.code.append(line[4:])
        elif "|" in text:
            if not self.table and self.lines and self.kind[0] == "text":
                self.close_text()
            self.table.append(text)
        else:
            if self.table:
                self.close_table()
                self.close_text()
            if not self.lines and not indent and self.blank:
                self.lists = []
            self.lines.append(text)
        self.blank = kind == "blank"

    def end(self) -> list[tuple]:
        self.close_code() if self.code else None
        self.close()
        return self.rows


class AsciidocWalk(Nodes):
    """Lines to nodes; ``open`` holds the heading or list of each level, as far as there is one."""

    def __init__(self) -> None:
        super().__init__()
        self.open: dict[int, int] = {}
        self.indents: dict[int, int] = {}
        self.in_list = False
        self.texts: list[str] = []
        self.caption: list[str] = []
        self.table: list[str] = []
        self.in_table = False

    @property
    def level(self) -> int:
        return next(k for k in range(1, len(self.open) + 2) if k not in self.open) - 1

    @property
    def parent(self) -> int | None:
        return self.open.get(self.level)

    def close_text(self) -> None:
        if self.texts:
            self.add("paragraph", " ".join(self.texts), self.parent)
            self.texts = []

    def close_table(self) -> None:
        if self.table:
            at = self.add("table", "\n".join(self.table), self.parent)
            self.captioned(at)
        self.table, self.in_table = [], False

    def captioned(self, at: int) -> None:
        if self.caption:
            self.add("caption", " ".join(self.caption), at)
            self.caption = []

    def item(self, indent: int, text: str) -> None:
        level = self.level
        if not self.in_list or indent > self.indents.get(level, -1):
            self.in_list = True
            self.open[level + 1] = self.add("list", "", self.open.get(level))
            self.indents[level + 1] = indent
        else:
            while level in self.indents and indent < self.indents[level] and self.indents.get(level - 1) is not None:
                del self.open[level], self.indents[level]
                level -= 1
        self.add("list_item", text, self.parent)

    def line(self, kind: str, indent: int, marker: str, text: str, line: str) -> None:
        if self.in_list and kind != "list_item":
            self.in_list = False
            for level in self.indents:
                self.open.pop(level, None)
            self.indents = {}
        if kind not in ("text", "blank"):
            self.close_text()
        if self.in_table and kind not in ("table_row",):
            self.close_table()
            if kind == "table_edge":
                return
        if kind == "title":
            self.open[0] = self.add("title", text)
        elif kind == "header":
            level = len(marker) - 1
            at = self.add("section_header", text, self.open.get(level - 1), level)
            self.open = {k: v for k, v in self.open.items() if k < level} | {level: at}
        elif kind == "list_item":
            self.item(indent, text)
        elif kind == "table_edge":
            self.in_table = True
        elif kind == "table_row":
            self.in_table = True
            self.table.append("|" + "|".join(c.strip() for c in line.split("|") if c.strip()) + "|")
        elif kind == "picture":
            self.captioned(self.add("picture", "", None, href=text))
        elif kind == "caption" and not self.caption:
            self.caption.append(text)
        elif kind == "blank":
            self.close_text()
        elif self.caption:
            self.caption.append(line.strip())
        else:
            self.texts.append(line.strip())

    def end(self) -> list[tuple]:
        self.close_text()
        self.close_table()
        if self.caption:
            self.add("caption", " ".join(self.caption))
        return self.rows


def _lines(files: DataFrame, kind: Column, parts: dict[str, str]) -> DataFrame:
    """(doc_id, at, kind, indent, marker, text, line) of files (doc_id, text); the parts of a line are groups of its kind's pattern."""
    rows = files.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\r\n|\n|\r")).alias("at", "line")).withColumn("line", F.replace("line", F.lit("\t"), F.lit("    ")))
    rows = rows.withColumn("kind", kind)
    part = lambda i: F.coalesce(*[F.when(F.col("kind") == k, F.regexp_extract("line", p, i)) for k, p in parts.items()], F.trim("line") if i == 2 else F.lit(""))
    return rows.select("doc_id", "at", "kind", F.length(F.regexp_extract("line", "^ *", 0)).alias("indent"), part(1).alias("marker"), F.trim(part(2)).alias("text"), "line")


def _walked(lines: DataFrame, walk: type) -> DataFrame:
    def document(part: pd.DataFrame) -> list[tuple]:
        done = walk()
        for row in zip(*(part[c].tolist() for c in ("kind", "indent", "marker", "text", "line")), strict=True):
            done.line(*row)
        return done.end()

    return each_group(lines, ["doc_id"], ["at"], document, NODES)


#: Kinds of Markdown lines with the patterns of (marker, text).
MARKDOWN = {
    "fence": r"^ {0,3}(`{3,}|~{3,})([^`]*)$", "heading": r"^ {0,3}(#{1,6})(?: +(.*?))?(?: +#+)? *$", "underline": r"^ {0,3}(=|-)[=-]*() *$", "rule": r"^ {0,3}([*_])(?: *\1){2,}() *$",
    "list_item": r"^ *([-*+]|\d{1,9}[.)]) +(\S.*)$", "code": r"^ {4}()(.*)$", "quote": r"^ {0,3}(>) ?(.*)$",
}
#: Kinds of AsciiDoc lines likewise.
ASCIIDOC = {
    "title": r"^(=) (.*)$", "header": r"^(={2,})\s+(.*)$", "list_item": r"^\s*(\*|-|\d+\.|\w+\.) +(.*)$", "table_edge": r"^(\|===)()\s*$", "table_row": r"^(\|).*\|(.*)$", "picture": r"^(image::)(.+?)(?:\[.*\])?$", "caption": r"^(\.)(.+)$",
}


def _kind(patterns: dict[str, str]) -> Column:
    found = F.when(F.trim("line") == "", "blank")
    for kind, pattern in patterns.items():
        found = found.when(F.col("line").rlike(pattern), kind)
    return found.otherwise("text")


def markdown(files: DataFrame) -> DataFrame:
    """``NODES`` rows of Markdown files (doc_id, text); a null or blank text has none.

    Headings, paragraphs, nested lists, fenced and indented code, tables, and the spans within lines: a block of several spans, or of several
    lines, has a group ``inline`` with a node for each. Quoted lines count as paragraphs. A line with bars but without cells stays text; the second row
    of a table is its rule only if it is written as one.
    """
    files = files.select("doc_id", shortened_underscores(F.col("text")).alias("text"))
    return _walked(_lines(files, _kind(MARKDOWN), MARKDOWN), MarkdownWalk)


def asciidoc(files: DataFrame) -> DataFrame:
    """``NODES`` rows of AsciiDoc files (doc_id, text): titles, headings as parents of what follows, lists by indent, tables, pictures, captions and paragraphs."""
    return _walked(_lines(files, _kind(ASCIIDOC), ASCIIDOC), AsciidocWalk)


def table_cells(nodes: DataFrame) -> DataFrame:
    """(doc_id, node_id, row, col, text, header) of the table nodes; the first row is the header."""
    rows = nodes.where("label = 'table'").select("doc_id", "node_id", F.posexplode(F.split("text", "\n")).alias("row", "line"))
    cells = F.split(F.regexp_replace("line", r"^[^|]*\||\|[^|]*$", ""), r"\|")
    out = rows.select("doc_id", "node_id", "row", F.posexplode(cells).alias("col", "text"))
    return out.select("doc_id", "node_id", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), F.trim("text").alias("text"), (F.col("row") == 0).alias("header"))
