"""Tables of web pages, and whole Markdown and AsciiDoc documents."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vellum.operators import serialize, tree
from vellum.plans import source_queries
from vellum.plans.fixtures import view
from vellum.sources import html_tables, markup

SMALL = "/root/testdata/sf0.001"


def grid_by_loops(rows):
    """The occupancy of a table as a list of lists, filled cell by cell; rows are lists of (tag, colspan, rowspan, text)."""
    counts = [not (row and all(tag == "th" and down > 1 for tag, _, down, _ in row)) and bool(row) for row in rows]
    height, width = sum(counts), max((sum(c[1] for c in row) for row in rows), default=0)
    grid = [[None] * width for _ in range(height)]
    out, at, late = [], -1, 0
    for row, own in zip(rows, counts, strict=True):
        at, late = (at + 1, 0) if own else (at, late + 1)
        column = 0
        for tag, across, down, text in row:
            down = down if own else down - 1
            while column < width and at + late < height and grid[at + late][column] is not None:
                column += 1
            for r in range(at + late, at + late + down):
                for c in range(column, column + across):
                    if r < height and c < width:
                        grid[r][c] = text
            heads = all(t == "th" for t, *_ in row)
            out.append((at + late, down, column, across, heads, tag == "th" and not heads, text))
            if at + late >= height:
                column += across
    return out


def test_spans_are_placed_as_by_an_occupancy_grid(spark):
    rng = random.Random(2)
    pages, expected = [], set()
    for page in range(150):
        rows = [[(rng.choice(["td", "td", "th"]), rng.choice([1, 1, 1, 2, 3]), rng.choice([1, 1, 1, 2, 3]), f"c{r}-{c}") for c in range(rng.randrange(0, 5))] for r in range(rng.randrange(1, 6))]
        pages.append((page, "<p>x</p><table>" + "".join("<tr>" + "".join(f'<{t} colspan="{a}" rowspan={d}> {x}\n</{t}>' for t, a, d, x in row) + "</tr>" for row in rows) + "</table>"))
        expected |= {(page, i, *cell) for i, cell in enumerate(grid_by_loops(rows))}
    found = html_tables.tables(spark.createDataFrame(pages, "page_id long, html string"))
    assert {(r.page_id, *tuple(r)[2:]) for r in found.collect()} == expected


def test_tables_of_odd_pages(spark):
    pages = [(1, None), (2, "<table>"), (3, "<table><tr><td>a<script>no</script><br>b &amp; c</table>"), (4, source_queries._TABLES[2]), (5, "<td>no table</td>"), (6, "<table><td colspan='9999999' rowspan='-1'>x</td></table>")]
    found = {(r.page_id, r.table_ix): r for r in html_tables.tables(spark.createDataFrame(pages, "page_id long, html string")).orderBy(F.desc("cell_id")).collect()}
    assert set(found) == {(3, 0), (4, 0), (6, 0)} and found[3, 0].text == "a b & c" and found[6, 0].col_span == 1000 and found[4, 0].text == "{k}"


def test_each_slot_of_a_web_table_has_its_cell(spark):
    slots = {(r.table_id, r.row, r.col): r.text for r in source_queries.html_table_grid(spark, SMALL).where("table_id < 30").collect()}
    assert [[slots[0, r, c] for c in range(3)] for r in range(4)] == [["A", "A", "B"], ["0", "x y", "B"], ["r", "w", "w"], ["r", "1", "2"]]
    assert [slots[10, 0, c] for c in range(2)] == ["H", "K"] and slots[11, 0, 0] == "1" and slots[20, 0, 0] == "2"


MARKDOWN = """# The *whole* title

A paragraph with **bold words**, `code` and [a link](http://x.y "t").
- one
- two
  1. inner
  2. more inner
- three ![](p.png "a picture")

Plain \\_ text &amp; more

```python
x = 1

y | z
```
| a | b |
|---|:--|
| 1 | *2* |

    indented | code

Under
=====
no table: a || b | c
***
> quoted
2) second
"""


def outline(nodes):
    walk = tree.walked(nodes)
    return [(r.depth, r.label, r.text, r.format, r.href) for r in walk.orderBy("pos").collect()]


def test_a_markdown_document(spark):
    found = markup.markdown(spark.createDataFrame([(1, MARKDOWN), (2, None), (3, " \n")], "doc_id long, text string"))
    assert outline(found) == [
        (0, "title", "", None, None), (1, "inline", "", None, None), (2, "text", "The", None, None), (2, "text", "whole", "i", None), (2, "text", "title", None, None),
        (0, "inline", "", None, None), (1, "text", "A paragraph with", None, None), (1, "text", "bold words", "b", None), (1, "text", ",", None, None), (1, "code", "code", "c", None), (1, "text", "and", None, None), (1, "text", "a link", None, "http://x.y"), (1, "text", ".", None, None),
        (0, "list", "", None, None), (1, "list_item", "one", None, None), (1, "list_item", "two", None, None),
        (2, "ordered_list", "", None, None), (3, "list_item", "inner", None, None), (3, "list_item", "more inner", None, None),
        (1, "list_item", "", None, None), (2, "inline", "", None, None), (3, "text", "three", None, None), (3, "picture", "", None, "p.png"), (4, "caption", "a picture", None, None),
        (0, "text", "Plain _ text & more", None, None), (0, "code", "x = 1\n\ny | z", None, None), (0, "table", "| a | b |\n| 1 | *2* |", None, None), (0, "code", "indented | code", None, None),
        (0, "title", "Under", None, None), (0, "table", "no table: a || b | c", None, None), (0, "text", "quoted", None, None), (0, "ordered_list", "", None, None), (1, "list_item", "second", None, None),
    ]
    cells = {(r.row, r.col): (r.text, r.header) for r in markup.table_cells(found.where("text like '| a%'")).collect()}
    assert cells == {(0, 0): ("a", True), (0, 1): ("b", True), (1, 0): ("1", False), (1, 1): ("*2*", False)}


def test_trees_come_back_from_markdown(spark):
    walk = tree.walked(view(spark, SMALL, "d_tree")).persist()
    mixed = walk.where("label = 'list_item' and text = '' or size(lists) > 0 and label not in ('list_item', 'list', 'ordered_list')").select("doc_id").distinct()
    walk = walk.join(mixed, "doc_id", "left_anti")  # lines below an item would go on with it
    found = source_queries.markdown_nodes(spark, SMALL)
    shown = {"picture": "<!-- image -->"}
    expected = {}
    for r in walk.where("label not in ('list', 'ordered_list')").orderBy("doc_id", "pos").collect():
        text = f"$${r.text}$$" if r.label == "formula" else shown.get(r.label, r.text)
        expected.setdefault(r.doc_id, []).append(("text" if r.label in ("formula", "picture") else r.label, text))
    again = {}
    for r in found.where("label not in ('list', 'ordered_list')").orderBy("doc_id", "node_id").collect():
        again.setdefault(r.doc_id, []).append((r.label, r.text))
    assert {k: again.get(k) for k in expected} == expected and len(expected) > 500
    assert serialize.to_markdown(tree.walked(found)).count() >= len(expected)


def test_an_asciidoc_document(spark):
    text = "= Title\n\n== One\nfirst line\nsecond line\n\n* a\n* b\n  - inner\n* c\nafter the list\n\n=== Two\n.Caption\n|===\n|h|i|\n|1|2 |\n|===\n\n.Fig\nof two lines\nimage::x.png[alt, width=3]\n== Three\nlast"
    found = markup.asciidoc(spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string"))
    assert [r[:3] for r in outline(found)] == [
        (0, "title", "Title"), (1, "section_header", "One"), (2, "paragraph", "first line second line"), (2, "list", ""), (3, "list_item", "a"), (3, "list_item", "b"), (3, "list", ""), (4, "list_item", "inner"), (3, "list_item", "c"),
        (2, "paragraph", "after the list"), (2, "section_header", "Two"), (3, "table", "|h|i|\n|1|2|"), (4, "caption", "Caption"), (1, "section_header", "Three"), (2, "paragraph", "last"), (0, "picture", ""), (1, "caption", "Fig of two lines"),
    ]


@pytest.mark.parametrize("name", ["markdown", "asciidoc"])
def test_no_word_of_a_document_is_lost(spark, name):
    rng = random.Random(name)
    parts = ["# h{}", "= t{}", "=== u{}", "* i{}", "    - j{}", "1. k{}", "p{}", "", "```", "|===", "|a{}|b{}|", "|---|---|", ".c{}", "image::m{}[x]", "> q{}", "l{} | r{}", "***", "===", "---", "**b{}** _c{}_ `d{}`", "[e{}](x)"]
    files = [(i, "\n".join(rng.choice(parts).replace("{}", str(rng.randrange(100))) for _ in range(rng.randrange(30)))) for i in range(300)]
    found = getattr(markup, name)(spark.createDataFrame(files, "doc_id long, text string"))
    words = {i: {w for w in re.findall(r"[a-z]\d+", t)} for i, t in files}
    texts = {r.doc_id: r.t for r in found.groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list(F.concat_ws(" ", "text", "href"))).alias("t")).collect()}
    assert {i: w - set(re.findall(r"[a-z]\d+", texts.get(i, ""))) for i, w in words.items() if w} == {i: set() for i, w in words.items() if w}
    lost = tree.unreached(found, tree.walked(found))
    assert lost.count() == 0
