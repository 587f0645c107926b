"""Queries over quads, cells, table exports, inputs and transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.geometry import Box, Quad, location_token
from vellum.operators import cells as cell_ops
from vellum.operators import tables
from vellum.plans.fixtures import base, view
from vellum.plans.table_queries import _FINAL, _GRID, _MATCH, _TEXTS, _spans, _texts


def geom_quad_angle(spark: SparkSession, d: str) -> DataFrame:
    """Cells turned by quarters: their corners start one further round."""
    xs, ys = ["l", "r", "r", "l"], ["b", "b", "t", "t"]
    turn = F.col("cell_ix") % 4
    corner = lambda names, i: F.element_at(F.array(*[F.col(names[(i + k) % 4]) for k in range(4)]), (turn + 1).cast("int"))
    flipped = view(spark, d, "d_cells").withColumns({"t": 792 - F.col("t"), "b": 792 - F.col("b")})
    quads = flipped.select("page_id", "cell_ix", *[corner(xs, i).alias(f"x{i}") for i in range(4)], *[corner(ys, i).alias(f"y{i}") for i in range(4)])
    q = Quad.of()
    return quads.select("page_id", "cell_ix", q.width.alias("width"), q.height.alias("height"), q.degrees.alias("degrees"), q.box.l.alias("l"), q.box.t.alias("t"))


def _doubled(spark: SparkSession, d: str) -> DataFrame:
    cells = view(spark, d, "d_cells")
    copies = cells.where("cell_ix % 4 = 0").select("page_id", (F.col("cell_ix") + 100000).alias("cell_ix"), *[(F.col(c) + F.when(F.col("cell_ix") % 8 == 0, 0.05).otherwise(0.5)).alias(c) for c in "ltrb"], "text")
    return cells.unionByName(copies)


def cells_without_doubles(spark: SparkSession, d: str) -> DataFrame:
    return cell_ops.without_doubles(_doubled(spark, d)).select("page_id", "cell_ix")


def cell_lines(spark: SparkSession, d: str) -> DataFrame:
    return cell_ops.lines(view(spark, d, "d_cells"))


def crop_text(spark: SparkSession, d: str) -> DataFrame:
    boxes = view(spark, d, "d_clusters").where("label = 'table'").select("page_id", F.col("cluster_id").alias("box_id"), "l", "t", "r", "b")
    return cell_ops.text_in_boxes(view(spark, d, "d_cells"), boxes)


def table_crop_windows(spark: SparkSession, d: str) -> DataFrame:
    boxes = view(spark, d, "d_clusters").where("label = 'table'").select("page_id", F.col("cluster_id").alias("box_id"), *[(F.col(c) * 1.25 - 30).alias(c) for c in "ltrb"])
    return cell_ops.crop_windows(boxes, 612.0, 792.0)


def picture_description_filter(spark: SparkSession, d: str) -> DataFrame:
    """Pictures of at least 1 % of their page, and those whose page is not known."""
    pictures = view(spark, d, "d_clusters").where("label = 'picture'")
    pages = view(spark, d, "d_pages").where("page_id % 10 <> 3").select("page_id", "width", "height")
    share = F.try_divide(Box.of().area, F.col("width") * F.col("height"))
    return pictures.join(pages, "page_id", "left").where(share.isNull() | (share >= 0.01)).select("page_id", "cluster_id")


def table_row_edit(spark: SparkSession, d: str) -> DataFrame:
    """Cells after row 1 is taken out and an empty row put in before row 3."""
    cells = view(spark, d, "d_table_cells").where("row_id <> 1")
    row = F.col("row_id") - F.when(F.col("row_id") > 1, 1).otherwise(0)
    row = row + F.when(row >= 3, 1).otherwise(0)
    return cells.select("table_id", "cell_id", row.cast("bigint").alias("row_id"), "column_id")


def table_export_html(spark: SparkSession, d: str) -> DataFrame:
    """One HTML table for each grid; a spanned cell is written where it starts."""
    slots = tables.grid(_spans(spark, d)).join(_texts(spark, d), ["table_id", "cell_id"], "left").join(_spans(spark, d).select("table_id", "cell_id", "row_span", "col_span"), ["table_id", "cell_id"], "left")
    first = F.col("cell_id").isNull() | ((F.col("row") == F.col("start_row")) & (F.col("col") == F.col("start_col")))
    span = lambda c, n: F.when(F.col(c) > 1, F.concat(F.lit(f' {n}="'), F.col(c).cast("string"), F.lit('"'))).otherwise("")
    name = F.when(F.col("row") == 0, "th").otherwise("td")
    cell = F.concat(F.lit("<"), name, F.coalesce(span("row_span", "rowspan"), F.lit("")), F.coalesce(span("col_span", "colspan"), F.lit("")), F.lit(">"), F.coalesce("text", F.lit("")), F.lit("</"), name, F.lit(">"))
    rows = slots.where(first).select("table_id", "row", "col", cell.alias("cell")).groupBy("table_id", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "cell"))), lambda c: c.cell), "").alias("line"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda r: F.concat(F.lit("<tr>"), r.line, F.lit("</tr>"))), "")
    return rows.groupBy("table_id").agg(F.concat(F.lit("<table><tbody>"), lines, F.lit("</tbody></table>")).alias("html"))


def element_doctags(spark: SparkSession, d: str) -> DataFrame:
    """Each region as a tag with its place on the page."""
    box = Box.of().flipped(792.0)
    places = [location_token(c, F.lit(float(s))) for c, s in ((box.l, 612), (box.b, 792), (box.r, 612), (box.t, 792))]
    tag = lambda x: F.concat(F.lit(x), "label", F.lit(">"))
    return view(spark, d, "d_clusters").select("page_id", "cluster_id", F.concat(tag("<"), *places, tag("</")).alias("doctags"))


def input_validity(spark: SparkSession, d: str) -> DataFrame:
    """Hash, size and whether a document keeps to the limits."""
    size = F.octet_length("text")
    return base(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), size.cast("bigint").alias("n_bytes"), (size.between(10, 20000)).alias("valid"))


def url_filenames(spark: SparkSession, d: str) -> DataFrame:
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    name = F.element_at(F.split(path, "/"), -1)
    return base(spark, d, "pages").select("page_id", F.when(name == "", "index").otherwise(name).alias("filename"))


def page_lists(spark: SparkSession, d: str) -> DataFrame:
    """Pages that lists such as '2-5,9,4' name, each once."""
    k = F.col("p_partkey") % 9 + 1
    text = F.concat(k.cast("string"), F.lit("-"), (k + 3).cast("string"), F.lit(","), (k * 2).cast("string"), F.lit(",,"), (k + 1).cast("string"))
    parts = base(spark, d, "part").select("p_partkey", F.explode(F.split(text, ",")).alias("part")).where("part <> ''")
    ends = F.split("part", "-")
    pages = parts.select("p_partkey", F.explode(F.sequence(F.get(ends, 0).cast("int"), F.element_at(ends, -1).cast("int"))).alias("page"))
    return pages.distinct()


def transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Turns as timed, attributed lines."""
    at = F.format_string("%d-%d", F.col("turn") * 5, F.col("turn") * 5 + 5)
    return base(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("[time: "), at, F.lit("] [speaker:"), "role", F.lit("] "), F.trim("text")).alias("line"))


def active_pages(spark: SparkSession, d: str) -> DataFrame:
    """Jobs and pages that any of three stages holds, each once."""
    e = base(spark, d, "events").selectExpr("user_id AS job_id", "event_id % 100 AS page_no", "event_type")
    held = e.where("event_type = 'view'").union(e.where("event_type = 'click'")).union(e.where("event_type = 'purchase'"))
    return held.groupBy("job_id").agg(F.countDistinct("page_no").alias("pages"))


SQL = {
    "geom_quad_angle": """SELECT page_id, cell_ix, CASE WHEN cell_ix % 2 = 0 THEN r - l ELSE b - t END AS width, CASE WHEN cell_ix % 2 = 0 THEN b - t ELSE r - l END AS height,
 CAST((cell_ix % 4) * 90 AS INTEGER) AS degrees, l, 792 - t AS t FROM d_cells""",
    "cells_without_doubles": """WITH c AS (SELECT page_id, cell_ix, l, t, r, b, text FROM d_cells UNION ALL SELECT page_id, cell_ix + 100000, l + s, t + s, r + s, b + s, text FROM (SELECT *, CAST(CASE WHEN cell_ix % 8 = 0 THEN 0.05 ELSE 0.5 END AS DOUBLE) AS s FROM d_cells WHERE cell_ix % 4 = 0) q)
 SELECT page_id, cell_ix FROM c WHERE NOT EXISTS (SELECT 1 FROM c e WHERE e.page_id = c.page_id AND e.text = c.text AND e.cell_ix < c.cell_ix AND abs(e.l - c.l) < 0.1 AND abs(e.t - c.t) < 0.1 AND abs(e.r - c.r) < 0.1 AND abs(e.b - c.b) < 0.1)""",
    "cell_lines": """WITH a AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY page_id ORDER BY t, l, cell_ix) > 4 THEN 1 ELSE 0 END AS turn FROM d_cells),
 b1 AS (SELECT *, sum(turn) OVER (PARTITION BY page_id ORDER BY t, l, cell_ix ROWS UNBOUNDED PRECEDING) AS rw FROM a),
 c1 AS (SELECT *, CASE WHEN l - max(r) OVER (PARTITION BY page_id, rw ORDER BY l, cell_ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 40 THEN 1 ELSE 0 END AS cut FROM b1),
 p AS (SELECT *, sum(cut) OVER (PARTITION BY page_id, rw ORDER BY l, cell_ix ROWS UNBOUNDED PRECEDING) AS part FROM c1),
 g AS (SELECT page_id, rw, part, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b, string_agg(text, ' ' ORDER BY l, cell_ix) AS text FROM p GROUP BY 1, 2, 3)
 SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY rw, part) - 1 AS BIGINT) AS line_ix, l, t, r, b, text FROM g""",
    "crop_text": """WITH i AS (SELECT c.page_id, x.cluster_id AS box_id, c.cell_ix, c.text, c.l, c.b, lag(c.r) OVER w AS pr, lag(c.b) OVER w AS pb FROM d_cells c JOIN d_clusters x ON x.page_id = c.page_id AND x.label = 'table'
 AND c.l >= x.l AND c.r <= x.r AND c.t >= x.t AND c.b <= x.b WINDOW w AS (PARTITION BY c.page_id, x.cluster_id ORDER BY c.cell_ix))
 SELECT page_id, box_id, string_agg(CASE WHEN pr IS NULL OR (abs(l - pr) < 1 AND abs(b - pb) < 1) THEN text ELSE ' ' || text END, '' ORDER BY cell_ix) AS text FROM i GROUP BY 1, 2""",
    "table_crop_windows": """WITH x AS (SELECT page_id, cluster_id AS box_id, l * CAST(1.25 AS DOUBLE) - 30 AS l, t * CAST(1.25 AS DOUBLE) - 30 AS t, r * CAST(1.25 AS DOUBLE) - 30 AS r, b * CAST(1.25 AS DOUBLE) - 30 AS b FROM d_clusters WHERE label = 'table'),
 y AS (SELECT page_id, box_id, greatest(0, CAST(round_even(l, 0) AS INTEGER)) AS x1, greatest(0, CAST(round_even(t, 0) AS INTEGER)) AS y1, least(612, CAST(round_even(r, 0) AS INTEGER)) AS x2, least(792, CAST(round_even(b, 0) AS INTEGER)) AS y2,
 greatest(1, CAST(round_even((r - l) * (CAST(1024 AS DOUBLE) / 792), 0) AS INTEGER)) AS w, greatest(1, CAST(round_even((b - t) * (CAST(1024 AS DOUBLE) / 792), 0) AS INTEGER)) AS h FROM x) SELECT * FROM y WHERE x2 > x1 AND y2 > y1""",
    "picture_description_filter": """SELECT c.page_id, c.cluster_id FROM d_clusters c LEFT JOIN (SELECT * FROM d_pages WHERE page_id % 10 <> 3) p ON p.page_id = c.page_id
 WHERE c.label = 'picture' AND (p.page_id IS NULL OR (c.r - c.l) * (c.b - c.t) / (p.width * p.height) >= 0.01)""",
    "table_row_edit": "SELECT table_id, cell_id, CASE WHEN rw >= 3 THEN rw + 1 ELSE rw END AS row_id, column_id FROM (SELECT *, CASE WHEN row_id > 1 THEN row_id - 1 ELSE row_id END AS rw FROM d_table_cells WHERE row_id <> 1) q",
    "table_export_html": f"""WITH {_MATCH}, {_FINAL}, {_TEXTS}, {_GRID}, c AS (SELECT g.table_id, g.row, g.col, CASE WHEN g.row = 0 THEN 'th' ELSE 'td' END AS tag, CASE WHEN s.r1 > s.r0 THEN ' rowspan="2"' ELSE '' END || CASE WHEN s.c1 > s.c0 THEN ' colspan="2"' ELSE '' END AS sp, coalesce(t.text, '') AS text
 FROM grid g LEFT JOIN spans s ON s.table_id = g.table_id AND s.cell_id = g.cell_id LEFT JOIN texts t ON t.table_id = g.table_id AND t.cell_id = g.cell_id WHERE g.cell_id IS NULL OR (g.row = g.start_row AND g.col = g.start_col)),
 r AS (SELECT table_id, row, string_agg('<' || tag || sp || '>' || text || '</' || tag || '>', '' ORDER BY col) AS line FROM c GROUP BY 1, 2)
 SELECT table_id, '<table><tbody>' || string_agg('<tr>' || line || '</tr>', '' ORDER BY row) || '</tbody></table>' AS html FROM r GROUP BY 1""",
    "element_doctags": "SELECT page_id, cluster_id, '<' || label || '>' || "
    + " || ".join(f"'<loc_' || CAST(greatest(0, least(499, CAST(round_even(({c}) / {s} * 500, 0) AS INTEGER))) AS VARCHAR) || '>'" for c, s in (("l", 612), ("792 - b", 792), ("r", 612), ("792 - t", 792)))
    + " || '</' || label || '>' AS doctags FROM d_clusters",
    "input_validity": "SELECT doc_id, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS n_bytes, strlen(text) BETWEEN 10 AND 20000 AS valid FROM documents",
    "url_filenames": "SELECT page_id, CASE WHEN name = '' THEN 'index' ELSE name END AS filename FROM (SELECT page_id, string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')[-1] AS name FROM pages) p",
    "page_lists": "SELECT DISTINCT p_partkey, CAST(page AS INTEGER) AS page FROM (SELECT p_partkey, unnest(list_concat(range(k, k + 4), [k * 2, k + 1])) AS page FROM (SELECT p_partkey, p_partkey % 9 + 1 AS k FROM part) q) u",
    "transcripts": "SELECT conv_id, turn, '[time: ' || CAST(turn * 5 AS VARCHAR) || '-' || CAST(turn * 5 + 5 AS VARCHAR) || '] [speaker:' || role || '] ' || trim(text, ' ') AS line FROM conversations",
    "active_pages": "SELECT user_id AS job_id, count(DISTINCT event_id % 100) AS pages FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1",
}

QUERIES = (
    geom_quad_angle, cells_without_doubles, cell_lines, crop_text, table_crop_windows, picture_description_filter, table_row_edit, table_export_html, element_doctags,
    input_validity, url_filenames, page_lists, transcripts, active_pages,
)
