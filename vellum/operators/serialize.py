"""Whole documents as text: Markdown, HTML, tags, plain text, an outline and JSON, from walked nodes (``tree.walked``).

Each node is turned into its own piece of text by column expressions; a document is its pieces in order.
Formats that wrap children put an opening and a closing piece in the order of paths, so that no format
needs the tree as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.text import markdown_escape
from vellum.operators.tree import LISTS

#: Stand-ins for what a format cannot show.
STAND_INS = {"picture": "<!-- image -->", "form": "<!-- missing-form-item -->", "key_value_region": "<!-- missing-key-value-item -->"}
INDENT = 4
#: The tags of the tagged format.
TAGS = {
    "text": "text", "caption": "caption", "footnote": "footnote", "formula": "formula", "list_item": "list_item", "page_footer": "page_footer", "page_header": "page_header", "picture": "picture",
    "table": "otsl", "title": "title", "document_index": "document_index", "code": "code", "checkbox_selected": "checkbox_selected", "checkbox_unselected": "checkbox_unselected", "form": "form",
    "key_value_region": "key_value_region", "list": "unordered_list", "ordered_list": "ordered_list",
}
HTML = {"title": "h1", "list": "ul", "ordered_list": "ol", "list_item": "li", "code": "pre", "picture": "figure", "table": "div", "formula": "div"}


def vocabulary(grid: int = 500) -> list[str]:
    """The opening and closing tags of the tagged format, section headers of levels 1 to 6, and the location tokens."""
    names = [*TAGS.values(), *[f"section_header_level_{k}" for k in range(1, 7)], "doctag", "page_break"]
    return [x for name in names for x in (f"<{name}>", f"</{name}>")] + [f"<loc_{k}>" for k in range(grid)]


def _looked_up(values: dict[str, str], other: str) -> Column:
    found = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("label")]
    return F.coalesce(found, F.lit(other))


def marked(walk: DataFrame) -> DataFrame:
    """Walked nodes with ``marker``: ``-`` for items of a list, their number for those of an ordered list."""
    return walk.withColumn("marker", F.when(F.col("label") == "list_item", F.when(F.col("above") == "ordered_list", F.concat(F.col("item_ix").cast("string"), F.lit("."))).otherwise("-")))


def markdown_part(*, escape: bool = True) -> Column:
    """A ``marked`` node's Markdown, '' if it has none."""
    text = markdown_escape(F.col("text")) if escape else F.col("text")
    label = F.col("label")
    indent = F.repeat(F.lit(" "), F.greatest(F.size("lists") - 1, F.lit(0)) * INDENT)
    return (
        F.when(label.isin(LISTS), F.lit(""))
        .when(label == "title", F.concat(F.lit("# "), text))
        .when(label == "section_header", F.concat(F.repeat(F.lit("#"), (F.col("level") + 1).cast("int")), F.lit(" "), text))
        .when(label == "list_item", F.concat(indent, "marker", F.lit(" "), text))
        .when(label == "code", F.concat(F.lit("```\n"), "text", F.lit("\n```")))
        .when(label == "formula", F.concat(F.lit("$$"), "text", F.lit("$$")))
        .when(label.isin(*STAND_INS), _looked_up(STAND_INS, ""))
        .otherwise(text)
    )


def markdown_parts(walk: DataFrame, *, escape: bool = True, strict: bool = False) -> DataFrame:
    """(doc_id, pos, page_no, list_id, part): each node's Markdown, without those that have none; ``strict`` gives texts alone."""
    part = F.when(F.col("label").isin(*LISTS, *STAND_INS), "").otherwise(F.col("text")) if strict else markdown_part(escape=escape)
    nodes = walk if strict else marked(walk)
    return nodes.select("doc_id", "pos", "page_no", F.get("lists", 0).alias("list_id"), part.alias("part")).where("part <> ''")


def together(parts: DataFrame, *keys: str) -> DataFrame:
    """(keys, text): parts in order, those of one list on lines of their own, others with a blank line between."""
    rows = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "list_id", "part"))).alias("parts"))
    near = lambda p, i: F.coalesce(F.get("parts", i - 1).list_id == p.list_id, F.lit(False))
    text = F.transform("parts", lambda p, i: F.when(i == 0, p.part).otherwise(F.concat(F.when(near(p, i), "\n").otherwise("\n\n"), p.part)))
    return rows.select(*keys, F.array_join(text, "").alias("text"))


def to_markdown(walk: DataFrame) -> DataFrame:
    return together(markdown_parts(walk), "doc_id")


def to_text(walk: DataFrame) -> DataFrame:
    return together(markdown_parts(walk, strict=True).withColumn("list_id", F.lit(None).cast("bigint")), "doc_id")


def to_outline(walk: DataFrame, indent: str = "  ") -> DataFrame:
    """(doc_id, text): a line for each node, its label and text under its parent's."""
    line = F.concat(F.repeat(F.lit(indent), F.col("depth").cast("int")), "label", F.lit(": "), "text")
    lines = F.array_sort(F.collect_list(F.struct("pos", line.alias("line"))))
    return walk.groupBy("doc_id").agg(F.array_join(F.transform(lines, lambda x: x.line), "\n").alias("text"))


def _wrapped(walk: DataFrame, opening: Column, closing: Column) -> DataFrame:
    """(doc_id, text): pieces in the order of paths; a closing piece comes after all below its node."""
    last = F.array(F.struct(F.lit(2**63 - 1).alias("child_ix"), F.lit(2**63 - 1).alias("node_id")))
    ends = walk.select("doc_id", F.concat("path", last).alias("path"), closing.alias("piece"))
    both = walk.select("doc_id", "path", opening.alias("piece")).unionByName(ends)
    pieces = F.array_sort(F.collect_list(F.struct("path", "piece")))
    return both.groupBy("doc_id").agg(F.array_join(F.transform(pieces, lambda p: p.piece), "").alias("text"))


def html_escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _inner(walk: DataFrame, text: Column) -> Column:
    """What a node holds: its ``content`` if the walk has such a column and it is not null, else the text."""
    return F.coalesce("content", text) if "content" in walk.columns else text


def to_html(walk: DataFrame) -> DataFrame:
    """(doc_id, text): nested elements; headings under their level, lists around their items, tables with a ``content`` as such."""
    heading = F.concat(F.lit("h"), F.least(F.col("level") + 1, F.lit(6)).cast("string"))
    tag = F.when(F.col("label") == "section_header", heading).otherwise(_looked_up(HTML, "p"))
    if "content" in walk.columns:
        tag = F.when((F.col("label") == "table") & F.col("content").isNotNull(), "table").otherwise(tag)
    return _wrapped(walk, F.concat(F.lit("<"), tag, F.lit(">"), _inner(walk, html_escape(F.col("text")))), F.concat(F.lit("</"), tag, F.lit(">")))


def to_tags(walk: DataFrame, location: str | None = None) -> DataFrame:
    """(doc_id, text): every node in its tag, with its location tokens (column ``location``) first; ``&``, ``<`` and ``>`` of texts as entities."""
    tag = F.when(F.col("label") == "section_header", F.concat(F.lit("section_header_level_"), F.col("level").cast("string"))).otherwise(_looked_up(TAGS, "text"))
    place = F.col(location) if location else F.lit("")
    found = _wrapped(walk, F.concat(F.lit("<"), tag, F.lit(">"), place, _inner(walk, html_escape(F.coalesce("text", F.lit(""))))), F.concat(F.lit("</"), tag, F.lit(">\n")))
    return found.select("doc_id", F.concat(F.lit("<doctag>"), "text", F.lit("</doctag>")).alias("text"))


def to_json(walk: DataFrame) -> DataFrame:
    """(doc_id, json): the nodes in order; fields without a value are left out."""
    node = F.struct("pos", F.struct("node_id", "parent_id", "label", "layer", F.when(F.col("label") == "section_header", F.col("level")).alias("level"), "text").alias("node"))
    nodes = walk.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(node)), lambda x: x.node).alias("nodes"))
    return nodes.select("doc_id", F.to_json(F.struct("doc_id", "nodes")).alias("json"))


NODE = "array<struct<node_id:bigint,parent_id:bigint,label:string,layer:string,level:bigint,text:string>>"


def from_json(documents: DataFrame, column: str = "json") -> DataFrame:
    """(doc_id, pos, node_id, parent_id, label, layer, level, text, valid) of documents as ``to_json`` writes them.

    A document that does not read, or has no nodes, is one row with ``valid`` false.
    """
    read = documents.select(F.from_json(column, f"doc_id bigint, nodes {NODE}", {"mode": "PERMISSIVE"}).alias("d"))
    rows = read.select("d.doc_id", F.posexplode_outer("d.nodes").alias("pos", "node"))
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "node.*", F.col("node.label").isNotNull().alias("valid"))


#: Tokens of the structure of tables, which are not closed.
OTSL = "fcel|ecel|lcel|ucel|xcel|nl|ched|rhed|srow"
#: A tag with its location tokens and the text, structure tokens included, up to the next tag, or a closing tag.
TAGGED = rf"<(?!(?:{OTSL})>)(\w+)>((?:<loc_\d+>)*)((?:[^<>]|<(?:{OTSL})>)*+)|</(\w+)>"


def html_unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))


def from_tags(documents: DataFrame) -> DataFrame:
    """(doc_id, pos, parent_pos, depth, tag, location, text) of tagged texts (doc_id, text): a row for each element, in order.

    Elements are paired by depth: the parent of one is the last one opened before it that is a level higher. The tag around
    the document is left out; depth and pos count from 0. Text between a closing tag and the next one is layout. A table's
    text is its structure tokens as they are written (``table_contents.from_otsl``).
    """
    found = F.regexp_extract_all("text", F.lit(TAGGED), F.lit(0))
    rows = documents.select("doc_id", F.posexplode(found).alias("at", "m"))
    part = lambda i: F.regexp_extract("m", TAGGED, i)
    rows = rows.select("doc_id", "at", part(1).alias("tag"), part(2).alias("location"), part(3).alias("text"), part(4).alias("closed"))
    rows = rows.where("tag <> 'doctag' and closed <> 'doctag' and tag not rlike '^loc_[0-9]+$'")
    w = Window.partitionBy("doc_id").orderBy("at")
    level = F.sum(F.when(F.col("closed") == "", 1).otherwise(-1)).over(w)
    opened = rows.withColumn("depth", level - 1).where("closed = ''").withColumn("pos", F.row_number().over(w) - 1)
    # each element as one that may be a parent, and as a child of the level above
    both = opened.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("child"))
    both = both.withColumn("key", F.col("depth") - F.col("child"))
    parent = F.last(F.when(F.col("child") == 0, F.col("pos")), ignorenulls=True).over(Window.partitionBy("doc_id", "key").orderBy("at", F.desc("child")))
    found = both.withColumn("parent_pos", parent).where("child = 1")
    return found.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("parent_pos").cast("bigint").alias("parent_pos"), "depth", "tag", "location", F.when(F.col("text").rlike(f"<({OTSL})>"), F.col("text")).otherwise(html_unescape(F.col("text"))).alias("text"))
