"""Tables of HTML pages as cells with their place, spans and header flags.

A row takes the columns that cells of the rows above leave free. Cells feed ``operators.tables.grid``.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from vellum.sources.html import SKIPPED

SCHEMA = "page_id bigint, table_ix bigint, cell_id bigint, start_row bigint, row_span bigint, start_col bigint, col_span bigint, column_header boolean, row_header boolean, text string"
#: What a span counts as at most, which is what browsers hold them to.
MOST = 1000


def span(value: str | None) -> int:
    """A span as written: 1 if it is absent or no number, and 1 at least."""
    return min(max(int(value), 1), MOST) if value is not None and value.isdecimal() else 1


class Tables(HTMLParser):
    """Collects the outermost tables of a page as rows of (is header, column span, row span, text); those that hold a table are left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[list[list[tuple]]] = []
        self.rows: list[list[tuple]] = []
        self.depth = self.skip = 0
        self.nested = False
        self.cell: list | None = None

    def close_cell(self) -> None:
        if self.cell is not None and self.rows:
            self.rows[-1].append((*self.cell[:3], " ".join(self.cell[3].split())))
        self.cell = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SKIPPED:
            self.skip += 1
        elif tag == "table":
            self.depth += 1
            self.nested |= self.depth > 1
            if self.depth == 1:
                self.rows, self.nested = [], False
        elif self.depth == 1 and tag == "tr":
            self.close_cell()
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self.close_cell()
            if not self.rows:
                self.rows.append([])
            given = dict(attrs)
            self.cell = [tag == "th", span(given.get("colspan")), span(given.get("rowspan")), ""]
        elif self.cell is not None:
            self.cell[3] += " "

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.close_cell()
                if not self.nested:
                    self.found.append(self.rows)
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self.close_cell()

    def handle_data(self, data: str) -> None:
        if self.cell is not None and not self.skip:
            self.cell[3] += data


def placed(rows: list[list[tuple]]) -> list[tuple]:
    """(cell_id, start_row, row_span, start_col, col_span, column_header, row_header, text) of a table's rows.

    Rows of nothing but headers that span several rows, and empty ones, have no row of their own: their cells begin in the
    row after the last one and reach a row less far.
    """
    own = [any(not head or down == 1 for head, _, down, _ in row) for row in rows]
    height, width = sum(own), max((sum(across for _, across, _, _ in row) for row in rows), default=0)
    taken: list[set[int]] = [set() for _ in range(height)]
    out: list[tuple] = []
    row, late = -1, 0
    for cells, counts in zip(rows, own, strict=True):
        row, late = (row + 1, 0) if counts else (row, late + 1)
        first, column = row + late, 0
        heads = all(head for head, *_ in cells)
        for head, across, down, text in cells:
            down -= not counts
            while column < width and first < height and column in taken[first]:
                column += 1
            for r in range(first, min(first + down, height)):
                taken[r].update(range(column, min(column + across, width)))
            out.append((len(out), first, down, column, across, heads, head and not heads, text))
            if first >= height or not down:
                column += across
    return out


def tables(pages: DataFrame) -> DataFrame:
    """``SCHEMA`` rows of pages (page_id, html), tables counted from 0; a null page has none, nor has a table that holds another one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page_id, text in zip(batch.page_id, batch.html, strict=True):
                parser = Tables()
                parser.feed(text or "")
                parser.close()
                out += [(page_id, i, *cell) for i, rows in enumerate(parser.found) for cell in placed(rows)]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return pages.select("page_id", "html").mapInPandas(run, SCHEMA)
