"""HTML pages as tree rows: one row per heading, paragraph, list item, code block, picture or table cell."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKIPPED = {"script", "style", "noscript", "template"}
BLOCKS = {"p", "div", "section", "article", "address", "summary", "footer", "header", "main", "aside", "nav", "details", "figure", "body", "ul", "ol", "dl", "table", "tr"}
SCHEMA = "page_id bigint, ord bigint, parent_ord bigint, label string, level bigint, layer string, text string"


class Tree(HTMLParser):
    """Buffers inline text until a block begins or ends; the first heading turns furniture into body."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.layer, self.buffer, self.label, self.level = "furniture", "", "text", 0
        self.skip = self.title = 0
        self.parents: list[int] = []
        self.lists: list[tuple[str, int]] = []

    def emit(self, label: str, text: str, level: int = 0) -> int:
        self.rows.append((len(self.rows), self.parents[-1] if self.parents else None, label, level, self.layer, text))
        return len(self.rows) - 1

    def flush(self) -> None:
        text = " ".join(self.buffer.split())
        self.buffer = ""
        if text:
            self.emit(self.label, text, self.level)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SKIPPED:
            self.skip += 1
        elif tag == "title":
            self.title = 1
        elif tag == "br":
            self.buffer += "\n"
        elif len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            self.flush()
            self.layer, self.label, self.level = "body", "title" if tag == "h1" else "section_header", int(tag[1]) - 1
        elif tag == "img":
            self.flush()
            self.emit("picture", dict(attrs).get("alt") or "")
        elif tag in ("ul", "ol"):
            self.flush()
            self.parents.append(self.emit("ordered_list" if tag == "ol" else "list", ""))
            self.lists.append((tag, 0))
        elif tag in ("li", "pre", "td", "th", "figcaption"):
            self.flush()
            self.label = {"li": "list_item", "pre": "code", "td": "cell", "th": "header_cell", "figcaption": "caption"}[tag]
        elif tag in BLOCKS:
            self.flush()
            self.label, self.level = "text", 0

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag == "title":
            text = " ".join(self.buffer.split())
            self.buffer, self.title = "", 0
            if text:
                self.emit("title", text)
        elif tag in ("ul", "ol"):
            self.flush()
            if self.lists:
                self.lists.pop()
                self.parents.pop()
            self.label = "text"
        elif tag in BLOCKS or tag in ("li", "pre", "td", "th", "figcaption") or (len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()):
            self.flush()
            self.label, self.level = "text", 0

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.buffer += data


def tree(pages: DataFrame) -> DataFrame:
    """``SCHEMA`` rows of pages (page_id, html); a null page has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page_id, text in zip(batch.page_id, batch.html, strict=True):
                parser = Tree()
                parser.feed(text or "")
                parser.close()
                parser.flush()
                out += [(page_id, *row) for row in parser.rows]
            yield pd.DataFrame(out, columns=["page_id", "ord", "parent_ord", "label", "level", "layer", "text"]).astype({"ord": "int64", "parent_ord": "Int64", "level": "int64"})

    return pages.select("page_id", "html").mapInPandas(run, SCHEMA)


def to_markdown(rows: DataFrame, layer: str = "body") -> DataFrame:
    """(page_id, markdown) of the rows of one layer in order."""
    text = F.col("text")
    line = (
        F.when(F.col("label") == "title", F.concat(F.lit("# "), text))
        .when(F.col("label") == "section_header", F.concat(F.repeat(F.lit("#"), (F.col("level") + 1).cast("int")), F.lit(" "), text))
        .when(F.col("label") == "list_item", F.concat(F.lit("- "), text))
        .when(F.col("label") == "code", F.concat(F.lit("```\n"), text, F.lit("\n```")))
        .when(F.col("label") == "picture", F.lit("<!-- image -->"))
        .when(F.col("label").isin("list", "ordered_list"), F.lit(None).cast("string"))
        .otherwise(text)
    )
    kept = rows.where(F.col("layer") == layer).withColumn("line", line).where("line is not null")
    return kept.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda p: p.line), "\n\n").alias("markdown"))


__all__ = ["SCHEMA", "to_markdown", "tree"]
