"""Tables within documents: cells as HTML rows or structure tokens, put into whole documents, and read from them again.

Cells are (doc_id, node_id, cell_id, start_row, row_span, start_col, col_span, column_header, row_header, text), several tables in one frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.operators.serialize import OTSL, html_escape, html_unescape
from vellum.operators.tables import grid

KEY = ["doc_id", "node_id"]


def _slots(cells: DataFrame) -> DataFrame:
    """Every slot of every table with its cell's place, header flags and text; slots without a cell have null."""
    one = cells.withColumn("table_id", F.struct(*KEY))
    own = one.select("table_id", "cell_id", "row_span", "col_span", "column_header", "row_header", F.trim("text").alias("text"))
    return grid(one).join(own, ["table_id", "cell_id"], "left").select("table_id.*", "row", "col", "start_row", "start_col", "row_span", "col_span", "column_header", "row_header", "text")


def _together(slots: DataFrame, piece: Column, opening: str, closing: str) -> DataFrame:
    """(doc_id, node_id, content): the pieces of a table in order, each row between the two texts."""
    parts = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    rows = slots.withColumn("piece", piece).groupBy(*KEY, "row").agg(F.concat(F.lit(opening), F.array_join(F.transform(parts("col", "piece"), lambda p: p.piece), ""), F.lit(closing)).alias("line"))
    return rows.groupBy(*KEY).agg(F.array_join(F.transform(parts("row", "line"), lambda p: p.line), "").alias("content"))


def as_html(cells: DataFrame) -> DataFrame:
    """(doc_id, node_id, content): the rows of each table; a cell stands where it begins, with its spans, header cells as ``th``."""
    starts = (F.col("row") == F.col("start_row")) & (F.col("col") == F.col("start_col"))
    tag = F.when(F.col("column_header") | F.col("row_header"), "th").otherwise("td")
    span = lambda name, n: F.when(F.col(n) > 1, F.concat(F.lit(f' {name}="'), F.col(n).cast("string"), F.lit('"'))).otherwise("")
    cell = F.concat(F.lit("<"), tag, span("rowspan", "row_span"), span("colspan", "col_span"), F.lit(">"), html_escape(F.col("text")), F.lit("</"), tag, F.lit(">"))
    piece = F.when(F.col("start_row").isNull(), "<td></td>").when(starts, cell).otherwise("")
    found = _together(_slots(cells), piece, "<tr>", "</tr>")
    return found.withColumn("content", F.concat(F.lit("<tbody>"), "content", F.lit("</tbody>")))


def as_otsl(cells: DataFrame) -> DataFrame:
    """(doc_id, node_id, content): a structure token for each slot, with the text where a cell begins, and one at the end of each row."""
    right, below = F.col("col") > F.col("start_col"), F.col("row") > F.col("start_row")
    kind = F.when(F.col("column_header"), "ched").when(F.col("row_header"), "rhed").otherwise("fcel")
    token = F.when(F.col("start_row").isNull(), "ecel").when(right & below, "xcel").when(right, "lcel").when(below, "ucel").when(F.coalesce("text", F.lit("")) == "", "ecel").otherwise(kind)
    text = F.when(token.isin("fcel", "ched", "rhed"), html_escape(F.col("text"))).otherwise("")
    return _together(_slots(cells), F.concat(F.lit("<"), token, F.lit(">"), text), "", "<nl>")


def with_contents(walk: DataFrame, contents: DataFrame) -> DataFrame:
    """Walked nodes with ``content``, which ``serialize.to_html`` and ``to_tags`` put in place of a node's text."""
    return walk.join(contents.select(*KEY, "content"), KEY, "left")


def from_otsl(contents: DataFrame) -> DataFrame:
    """Cells of tables (doc_id, node_id, content) as ``as_otsl`` writes them; empty slots are no cells.

    A cell spans the lcel to its right and the ucel below it; xcel fills the rest of its area.
    """
    pattern = rf"<({OTSL})>([^<]*)"
    tokens = contents.select(*KEY, F.posexplode(F.regexp_extract_all("content", F.lit(pattern), F.lit(0))).alias("at", "m"))
    tokens = tokens.select(*KEY, "at", F.regexp_extract("m", pattern, 1).alias("token"), F.trim(html_unescape(F.regexp_extract("m", pattern, 2))).alias("text"))
    w = Window.partitionBy(*KEY).orderBy("at")
    tokens = tokens.withColumn("row", F.coalesce(F.sum((F.col("token") == "nl").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("token <> 'nl'")
    tokens = tokens.withColumn("col", F.row_number().over(Window.partitionBy(*KEY, "row").orderBy("at")) - 1)
    # how far a run of lcel goes on to the right, and one of ucel below, by the next token of another kind
    side = lambda token, along, across: F.min(F.when(F.col("token") != token, F.col(along))).over(Window.partitionBy(*KEY, across).orderBy(along).rowsBetween(1, Window.unboundedFollowing))
    last = lambda c, *by: F.max(c).over(Window.partitionBy(*KEY, *by))
    spans = tokens.withColumn("col_span", F.coalesce(side("lcel", "col", "row"), last("col", "row") + 1) - F.col("col"))
    spans = spans.withColumn("row_span", F.coalesce(side("ucel", "row", "col"), last("row", "col") + 1) - F.col("row"))
    cells = spans.where("token in ('fcel', 'ched', 'rhed', 'srow') or (token = 'ecel' and (row_span > 1 or col_span > 1))")
    number = F.row_number().over(w) - 1
    long = lambda c: F.col(c).cast("bigint").alias(c)
    return cells.select(*KEY, number.cast("bigint").alias("cell_id"), F.col("row").cast("bigint").alias("start_row"), long("row_span"), F.col("col").cast("bigint").alias("start_col"), long("col_span"), (F.col("token") == "ched").alias("column_header"), (F.col("token") == "rhed").alias("row_header"), "text")
