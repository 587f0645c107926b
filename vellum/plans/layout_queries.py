"""Queries over geometry and layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.geometry import Box, hull, location_token
from vellum.operators import layout
from vellum.plans.fixtures import view


def r6(column, name: str):
    return F.round(column, 6).alias(name)


def geom_area_perimeter(spark: SparkSession, d: str) -> DataFrame:
    x = Box.of()
    return view(spark, d, "d_cells").select("page_id", "cell_ix", x.area.alias("area"), (2 * (x.width + x.height)).alias("perimeter"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    c = view(spark, d, "d_clusters")
    a = c.select("page_id", F.col("cluster_id").alias("a"), *Box.of().columns("1"))
    b = c.select("page_id", F.col("cluster_id").alias("b"), *Box.of().columns("2"))
    return a.join(b, "page_id").where("a < b")


def _two() -> tuple[Box, Box]:
    return tuple(Box(*(F.col(f"{c}{i}") for c in "ltrb")) for i in (1, 2))


def geom_iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    x, y = _two()
    return _pairs(spark, d).where(x.overlaps(y)).select("page_id", "a", "b", x.intersection(y).alias("inter"), r6(x.iou(y), "iou"), r6(x.over_self(y), "ios_a"), r6(y.over_self(x), "ios_b"))


def geom_origin_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    flipped = Box.of().flipped(792.0)
    return view(spark, d, "d_cells").select("page_id", "cell_ix", flipped.t.alias("t_bl"), flipped.b.alias("b_bl"), flipped.flipped(792.0).t.alias("t_back"), flipped.height.alias("height"))


def geom_predicates(spark: SparkSession, d: str) -> DataFrame:
    x, y = _two()
    xb, yb = x.flipped(792.0), y.flipped(792.0)
    return _pairs(spark, d).select(
        "page_id", "a", "b", x.overlaps_x(y).alias("ox"), x.overlaps_y(y).alias("oy"), x.left_of(y).alias("is_left"), x.strictly_left_of(y).alias("strictly_left"),
        x.above(y).alias("is_above"), x.strictly_above(y).alias("strictly_above"), xb.strictly_above(yb).alias("strictly_above_bl"), x.x_union(y).alias("x_union"), x.y_union(y).alias("y_union"), x.x_overlap(y).alias("x_overlap"),
    )


def geom_enclosing(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "d_cells").groupBy("page_id").agg(*hull())


def geom_location_tokens(spark: SparkSession, d: str) -> DataFrame:
    tokens = [location_token(F.col(c), F.lit(float(s))) for c, s in (("l", 612), ("t", 792), ("r", 612), ("b", 792))]
    return view(spark, d, "d_cells").select("page_id", "cell_ix", F.concat(*tokens).alias("tokens"))


def geom_scaled_normalized(spark: SparkSession, d: str) -> DataFrame:
    n, s, e = Box.of().normalized(F.lit(612.0), F.lit(792.0)), Box.of().scaled(1.5, 2.0), Box.of().expanded(0.1, 0.2)
    return view(spark, d, "d_cells").select("page_id", "cell_ix", r6(n.l, "nl"), r6(n.b, "nb"), s.r.alias("sr"), s.t.alias("st"), r6(e.l, "el"), r6(e.b, "eb"))


def filter_confidence_label(spark: SparkSession, d: str) -> DataFrame:
    return layout.confident(view(spark, d, "d_clusters")).select("page_id", "cluster_id", "label", "confidence")


def filter_full_page_picture(spark: SparkSession, d: str) -> DataFrame:
    clusters = view(spark, d, "d_clusters")
    whole = F.expr("CASE WHEN cluster_id = 1 AND page_id % 5 = 0 THEN 612.0D ELSE r END")
    big = clusters.withColumn("r", whole).withColumn("l", F.expr("CASE WHEN cluster_id = 1 AND page_id % 5 = 0 THEN 0.0D ELSE l END")).withColumn("t", F.expr("CASE WHEN cluster_id = 1 AND page_id % 5 = 0 THEN 0.0D ELSE t END")).withColumn("b", F.expr("CASE WHEN cluster_id = 1 AND page_id % 5 = 0 THEN 792.0D ELSE b END"))
    return layout.without_full_page_pictures(big, view(spark, d, "d_pages")).select("page_id", "cluster_id", "label")


def _assigned(spark: SparkSession, d: str, bins: float | None = None) -> DataFrame:
    return layout.assign_cells(view(spark, d, "d_cells"), view(spark, d, "d_clusters"), bins=bins)


def assign_cells(spark: SparkSession, d: str) -> DataFrame:
    return _assigned(spark, d).withColumn("ratio", F.round("ratio", 6))


def assign_cells_binned(spark: SparkSession, d: str) -> DataFrame:
    return _assigned(spark, d, 120.0).withColumn("ratio", F.round("ratio", 6))


def orphan_cells(spark: SparkSession, d: str) -> DataFrame:
    return layout.orphans(view(spark, d, "d_cells"), view(spark, d, "d_clusters"), _assigned(spark, d)).select("page_id", "cluster_id", "cell_ix", "label")


def empty_clusters(spark: SparkSession, d: str) -> DataFrame:
    return layout.empty(view(spark, d, "d_clusters"), _assigned(spark, d)).select("page_id", "cluster_id", "label")


def special_children(spark: SparkSession, d: str) -> DataFrame:
    return layout.children_of_special(view(spark, d, "d_clusters"))


def overlap_edges(spark: SparkSession, d: str) -> DataFrame:
    return layout.overlap_edges(view(spark, d, "d_clusters"))


def overlap_components(spark: SparkSession, d: str) -> DataFrame:
    return layout.components(layout.overlap_edges(view(spark, d, "d_clusters")))


def overlap_best_of_group(spark: SparkSession, d: str) -> DataFrame:
    clusters = view(spark, d, "d_clusters")
    return layout.best_of_groups(clusters, layout.components(layout.overlap_edges(clusters)))


def cluster_shrink_bbox(spark: SparkSession, d: str) -> DataFrame:
    found = layout.shrunk(view(spark, d, "d_clusters"), view(spark, d, "d_cells"), _assigned(spark, d))
    return found.select("page_id", "cluster_id", "l", "t", "r", "b", "first_cell")


def cluster_sort_orders(spark: SparkSession, d: str) -> DataFrame:
    return layout.ordered(layout.shrunk(view(spark, d, "d_clusters"), view(spark, d, "d_cells"), _assigned(spark, d)))


def _tables(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "d_clusters").where("label = 'table'").withColumnRenamed("cluster_id", "box_id")


def cells_in_bbox(spark: SparkSession, d: str) -> DataFrame:
    return layout.cells_in_boxes(view(spark, d, "d_cells"), _tables(spark, d))


def table_tokens_fallback(spark: SparkSession, d: str) -> DataFrame:
    inside = layout.cells_in_boxes(view(spark, d, "d_cells").where("cell_ix % 2 = 0"), _tables(spark, d))
    tables = _tables(spark, d).select("page_id", "box_id")
    own = _assigned(spark, d).select("page_id", F.col("cluster_id").alias("box_id"), "cell_ix").join(tables, ["page_id", "box_id"], "left_semi")
    return layout.with_fallback(inside, own)


def ocr_anti_overlap_reindex(spark: SparkSession, d: str) -> DataFrame:
    cells = view(spark, d, "d_cells")
    both = layout.add_untouched(cells.where("cell_ix % 3 <> 1"), cells.where("cell_ix % 3 = 1"))
    return both.select("page_id", "cell_ix", "new_ix", "from_ocr")


#: Parts of the SQL that several queries share.
_ASSIGN = """assign AS (SELECT page_id, cell_ix, cluster_id, ratio FROM (SELECT *, row_number() OVER (PARTITION BY page_id, cell_ix ORDER BY ratio DESC, cluster_id) AS rn FROM (
 SELECT a.page_id, a.cell_ix, c.cluster_id, ((least(a.r,c.r)-greatest(a.l,c.l))*(least(a.b,c.b)-greatest(a.t,c.t)))/((a.r-a.l)*(a.b-a.t)) AS ratio
 FROM d_cells a JOIN d_clusters c ON a.page_id=c.page_id AND a.l<c.r AND c.l<a.r AND a.t<c.b AND c.t<a.b WHERE trim(a.text)<>'') y WHERE ratio>0.2) z WHERE rn=1)"""
_EDGES = """edges AS (SELECT page_id, a, b FROM (SELECT x.page_id, x.cluster_id AS a, y.cluster_id AS b, (least(x.r,y.r)-greatest(x.l,y.l))*(least(x.b,y.b)-greatest(x.t,y.t)) AS i,
 (x.r-x.l)*(x.b-x.t) AS xa,(y.r-y.l)*(y.b-y.t) AS ya FROM d_clusters x JOIN d_clusters y ON x.page_id=y.page_id AND x.cluster_id<y.cluster_id AND x.l<y.r AND y.l<x.r AND x.t<y.b AND y.t<x.b) w
 WHERE i/xa>=0.8 OR i/ya>=0.8 OR i/(xa+ya-i)>=0.8)"""
_COMPONENTS = """both_ways AS (SELECT page_id, a, b FROM edges UNION SELECT page_id, b, a FROM edges),
 reach(page_id, node, seen) AS (SELECT DISTINCT page_id, a, a FROM both_ways UNION SELECT r.page_id, r.node, e.b FROM reach r JOIN both_ways e ON e.page_id = r.page_id AND e.a = r.seen),
 comps AS (SELECT page_id, node, min(seen) AS component FROM reach GROUP BY page_id, node)"""
_SHRUNK = """around AS (SELECT s.page_id, s.cluster_id, min(c.l) AS nl, min(c.t) AS nt, max(c.r) AS nr, max(c.b) AS nb, min(c.cell_ix) AS first_cell
 FROM assign s JOIN d_cells c ON c.page_id = s.page_id AND c.cell_ix = s.cell_ix GROUP BY 1, 2),
 shrunk AS (SELECT k.page_id, k.cluster_id, CASE WHEN nl IS NULL THEN l WHEN label = 'table' THEN least(l, nl) ELSE nl END AS l,
 CASE WHEN nt IS NULL THEN t WHEN label = 'table' THEN least(t, nt) ELSE nt END AS t, CASE WHEN nr IS NULL THEN r WHEN label = 'table' THEN greatest(r, nr) ELSE nr END AS r,
 CASE WHEN nb IS NULL THEN b WHEN label = 'table' THEN greatest(b, nb) ELSE nb END AS b, first_cell
 FROM d_clusters k LEFT JOIN around a ON a.page_id = k.page_id AND a.cluster_id = k.cluster_id)"""
_PAIRS = "d_clusters x JOIN d_clusters y ON x.page_id = y.page_id AND x.cluster_id < y.cluster_id"
_ASSIGN_SQL = f"WITH {_ASSIGN} SELECT page_id, cell_ix, cluster_id, round(ratio, 6) AS ratio FROM assign"
_BOX = "(least(c.r, x.r) - greatest(c.l, x.l)) > 0 AND (least(c.b, x.b) - greatest(c.t, x.t)) > 0 AND (least(c.r, x.r) - greatest(c.l, x.l)) * (least(c.b, x.b) - greatest(c.t, x.t)) / ((c.r - c.l) * (c.b - c.t)) > 0.8"

SQL = {
    "geom_area_perimeter": "SELECT page_id, cell_ix, (r - l) * (b - t) AS area, 2 * ((r - l) + (b - t)) AS perimeter FROM d_cells",
    "geom_iou_pairs": f"""SELECT page_id, a, b, inter, round(inter / (aa + ab - inter + 1e-6), 6) AS iou, round(inter / aa, 6) AS ios_a, round(inter / ab, 6) AS ios_b FROM (
 SELECT x.page_id, x.cluster_id AS a, y.cluster_id AS b, (x.r - x.l) * (x.b - x.t) AS aa, (y.r - y.l) * (y.b - y.t) AS ab,
 (least(x.r, y.r) - greatest(x.l, y.l)) * (least(x.b, y.b) - greatest(x.t, y.t)) AS inter FROM {_PAIRS} AND x.l < y.r AND y.l < x.r AND x.t < y.b AND y.t < x.b) p""",
    "geom_origin_roundtrip": "SELECT page_id, cell_ix, 792 - t AS t_bl, 792 - b AS b_bl, t AS t_back, abs(b - t) AS height FROM d_cells",
    "geom_predicates": f"""SELECT x.page_id, x.cluster_id AS a, y.cluster_id AS b, NOT (x.r <= y.l OR y.r <= x.l) AS ox, NOT (x.b <= y.t OR y.b <= x.t) AS oy, x.l < y.l AS is_left,
 x.r + 0.001 < y.l AS strictly_left, x.t < y.t AS is_above, x.b + 0.001 < y.t AS strictly_above, (792 - x.b) + 0.001 > 792 - y.t AS strictly_above_bl,
 greatest(x.r, y.r) - least(x.l, y.l) AS x_union, greatest(x.b, y.b) - least(x.t, y.t) AS y_union, greatest(0.0, least(x.r, y.r) - greatest(x.l, y.l)) AS x_overlap FROM {_PAIRS}""",
    "geom_enclosing": "SELECT page_id, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM d_cells GROUP BY page_id",
    "geom_location_tokens": "SELECT page_id, cell_ix, "
    + " || ".join(f"'<loc_' || CAST(greatest(0, least(499, CAST(round_even({c} / {s} * 500, 0) AS INTEGER))) AS VARCHAR) || '>'" for c, s in (("l", 612), ("t", 792), ("r", 612), ("b", 792)))
    + " AS tokens FROM d_cells",
    "geom_scaled_normalized": "SELECT page_id, cell_ix, round(l / 612, 6) AS nl, round(b / 792, 6) AS nb, r * 1.5 AS sr, t * 2.0 AS st, round(l - (r - l) * CAST(0.1 AS DOUBLE), 6) AS el, round(b + (b - t) * CAST(0.2 AS DOUBLE), 6) AS eb FROM d_cells",
    "filter_confidence_label": "SELECT page_id, cluster_id, CASE label WHEN 'title' THEN 'section_header' ELSE label END AS label, confidence FROM d_clusters WHERE confidence >= CASE WHEN label IN ('section_header', 'title') THEN 0.45 ELSE 0.5 END",
    "filter_full_page_picture": """SELECT c.page_id, cluster_id, label FROM d_clusters c JOIN d_pages p ON p.page_id = c.page_id
 WHERE label <> 'picture' OR CASE WHEN cluster_id = 1 AND c.page_id % 5 = 0 THEN 612.0 * 792.0 ELSE (r - l) * (b - t) END / (width * height) <= 0.9""",
    "assign_cells": _ASSIGN_SQL,
    "assign_cells_binned": _ASSIGN_SQL,
    "orphan_cells": f"""WITH {_ASSIGN}, lost AS (SELECT c.page_id, c.cell_ix FROM d_cells c WHERE trim(c.text) <> '' AND NOT EXISTS (SELECT 1 FROM assign a WHERE a.page_id = c.page_id AND a.cell_ix = c.cell_ix)),
 last AS (SELECT page_id, max(cluster_id) AS m FROM d_clusters GROUP BY 1)
 SELECT l.page_id, CAST(m + row_number() OVER (PARTITION BY l.page_id ORDER BY cell_ix) AS BIGINT) AS cluster_id, cell_ix, 'text' AS label FROM lost l JOIN last ON last.page_id = l.page_id""",
    "empty_clusters": f"WITH {_ASSIGN} SELECT page_id, cluster_id, label FROM d_clusters c WHERE NOT EXISTS (SELECT 1 FROM assign a WHERE a.page_id = c.page_id AND a.cluster_id = c.cluster_id)",
    "special_children": """SELECT c.page_id, x.cluster_id AS special_id, c.cluster_id AS child_id FROM d_clusters c JOIN d_clusters x ON x.page_id = c.page_id
 WHERE x.label IN ('table', 'picture') AND c.label NOT IN ('table', 'picture') AND """ + _BOX,
    "overlap_edges": f"WITH {_EDGES} SELECT page_id, a, b FROM edges",
    "overlap_components": f"WITH RECURSIVE {_EDGES}, {_COMPONENTS} SELECT page_id, node, component FROM comps",
    "cluster_shrink_bbox": f"WITH {_ASSIGN}, {_SHRUNK} SELECT page_id, cluster_id, l, t, r, b, first_cell FROM shrunk",
    "cluster_sort_orders": f"""WITH {_ASSIGN}, {_SHRUNK} SELECT page_id, cluster_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY coalesce(first_cell, 2147483647), t, l, cluster_id) AS INTEGER) AS by_id,
 CAST(row_number() OVER (PARTITION BY page_id ORDER BY t, l, b, r, cluster_id) AS INTEGER) AS by_tblr, CAST(row_number() OVER (PARTITION BY page_id ORDER BY l, r, t, b, cluster_id) AS INTEGER) AS by_lrtb FROM shrunk""",
    "cells_in_bbox": f"SELECT c.page_id, x.cluster_id AS box_id, c.cell_ix FROM d_cells c JOIN d_clusters x ON x.page_id = c.page_id WHERE x.label = 'table' AND {_BOX}",
    "table_tokens_fallback": f"""WITH {_ASSIGN}, inside AS (SELECT c.page_id, x.cluster_id AS box_id, c.cell_ix FROM d_cells c JOIN d_clusters x ON x.page_id = c.page_id WHERE c.cell_ix % 2 = 0 AND x.label = 'table' AND {_BOX})
 SELECT * FROM inside UNION ALL SELECT a.page_id, a.cluster_id, a.cell_ix FROM assign a JOIN d_clusters k ON k.page_id = a.page_id AND k.cluster_id = a.cluster_id
 WHERE k.label = 'table' AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.page_id = a.page_id AND i.box_id = a.cluster_id)""",
    "ocr_anti_overlap_reindex": """WITH kept AS (SELECT page_id, cell_ix, FALSE AS from_ocr FROM d_cells WHERE cell_ix % 3 <> 1 UNION ALL SELECT page_id, cell_ix, TRUE FROM d_cells o WHERE cell_ix % 3 = 1
 AND NOT EXISTS (SELECT 1 FROM d_cells p WHERE p.page_id = o.page_id AND p.cell_ix % 3 <> 1 AND o.l < p.r AND p.l < o.r AND o.t < p.b AND p.t < o.b))
 SELECT page_id, cell_ix, CAST(row_number() OVER (PARTITION BY page_id ORDER BY from_ocr, cell_ix) - 1 AS BIGINT) AS new_ix, from_ocr FROM kept""",
}

QUERIES = (
    geom_area_perimeter, geom_iou_pairs, geom_origin_roundtrip, geom_predicates, geom_enclosing, geom_location_tokens, geom_scaled_normalized, filter_confidence_label,
    filter_full_page_picture, assign_cells, assign_cells_binned, orphan_cells, empty_clusters, special_children, overlap_edges, overlap_components, overlap_best_of_group,
    cluster_shrink_bbox, cluster_sort_orders, cells_in_bbox, table_tokens_fallback, ocr_anti_overlap_reindex,
)
