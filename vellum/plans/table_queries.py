"""Queries over table structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators import tables
from vellum.plans.fixtures import view


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "d_table_cells")


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "d_tokens")


def _matches(spark: SparkSession, d: str) -> DataFrame:
    return tables.matched(_cells(spark, d), _tokens(spark, d))


def _spans(spark: SparkSession, d: str) -> DataFrame:
    span = F.when((F.col("column_id") == 0) & (F.col("row_id") % 4 == 1), F.lit(2)).otherwise(F.lit(1)).cast("bigint")
    tall = F.when((F.col("column_id") == 2) & (F.col("row_id") % 3 == 0), F.lit(2)).otherwise(F.lit(1)).cast("bigint")
    return _cells(spark, d).select("table_id", "cell_id", F.col("row_id").alias("start_row"), tall.alias("row_span"), F.col("column_id").alias("start_col"), span.alias("col_span"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return tables.merged_text(tables.final_assignment(_matches(spark, d)), _tokens(spark, d))


def otsl_explode(spark: SparkSession, d: str) -> DataFrame:
    return tables.structure_cells(view(spark, d, "d_otsl"))


def otsl_square_check(spark: SparkSession, d: str) -> DataFrame:
    return tables.square(view(spark, d, "d_otsl"))


def table_cell_translate(spark: SparkSession, d: str) -> DataFrame:
    shares = _cells(spark, d).select("table_id", "cell_id", *[(F.col(c) / 1000).alias(c) for c in ("x1", "y1", "x2", "y2")])
    out = tables.translated(shares, 36.0, 72.0, 540.0, 648.0)
    return out.select("table_id", "cell_id", *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


def table_token_match(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).select("table_id", "cell_id", "token_id", F.round("iou", 6).alias("iou"), F.round("iopdf", 6).alias("iopdf"))


def table_column_alignment(spark: SparkSession, d: str) -> DataFrame:
    return tables.alignments(_cells(spark, d), _matches(spark, d))


def table_move_bad_cells(spark: SparkSession, d: str) -> DataFrame:
    return tables.moved(_cells(spark, d), _matches(spark, d))


def table_dedup_columns(spark: SparkSession, d: str) -> DataFrame:
    return tables.doubled_columns(_cells(spark, d), _matches(spark, d), 0.3)


def table_final_assignment(spark: SparkSession, d: str) -> DataFrame:
    return tables.final_assignment(_matches(spark, d))


def table_align_to_tokens(spark: SparkSession, d: str) -> DataFrame:
    return tables.aligned_to_tokens(tables.final_assignment(_matches(spark, d)), _tokens(spark, d))


def table_orphan_bands(spark: SparkSession, d: str) -> DataFrame:
    return tables.orphan_places(_cells(spark, d), _tokens(spark, d), _matches(spark, d))


def table_reconcile_rows(spark: SparkSession, d: str) -> DataFrame:
    return tables.token_rows(_cells(spark, d), _tokens(spark, d), _matches(spark, d))


def table_token_merge_text(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d)


def table_index_compaction(spark: SparkSession, d: str) -> DataFrame:
    return tables.compacted(_spans(spark, d).select("table_id", "cell_id", (F.col("start_row") * 3).alias("row_id"), (F.col("start_col") * 2 + 1).alias("column_id"), "row_span", "col_span"))


def table_grid_fill(spark: SparkSession, d: str) -> DataFrame:
    return tables.grid(_spans(spark, d))


def table_row_col_hulls(spark: SparkSession, d: str) -> DataFrame:
    return tables.hulls(_cells(spark, d))


def table_export_otsl(spark: SparkSession, d: str) -> DataFrame:
    return tables.to_otsl(tables.grid(_spans(spark, d)), _texts(spark, d))


def table_triplets(spark: SparkSession, d: str) -> DataFrame:
    return tables.triplets(tables.grid(_spans(spark, d)), _texts(spark, d))


def table_export_markdown(spark: SparkSession, d: str) -> DataFrame:
    return tables.to_markdown(tables.grid(_spans(spark, d)), _texts(spark, d))


_MATCH = """match AS (SELECT table_id, cell_id, token_id, w * h / (ta + ca - w * h) AS iou, w * h / ta AS iopdf FROM (SELECT c.table_id, c.cell_id, t.token_id,
 least(c.x2, t.x2) - greatest(c.x1, t.x1) AS w, least(c.y2, t.y2) - greatest(c.y1, t.y1) AS h, (t.x2 - t.x1) * (t.y2 - t.y1) AS ta, (c.x2 - c.x1) * (c.y2 - c.y1) AS ca
 FROM d_table_cells c JOIN d_tokens t ON t.table_id = c.table_id) p WHERE w > 0 AND h > 0)"""
_ALIGN = """good AS (SELECT * FROM d_table_cells c WHERE cell_class > 1 AND EXISTS (SELECT 1 FROM match m WHERE m.table_id = c.table_id AND m.cell_id = c.cell_id)),
 stats AS (SELECT table_id, column_id, max(x1) - min(x1) AS dl, max((x1 + x2) / 2) - min((x1 + x2) / 2) AS dm, max(x2) - min(x2) AS dr, quantile_cont(x1, 0.5) AS lft,
 quantile_cont((x1 + x2) / 2, 0.5) AS mid, quantile_cont(x2, 0.5) AS rgt, quantile_cont(x2 - x1, 0.5) AS width, quantile_cont(y2 - y1, 0.5) AS height FROM good GROUP BY 1, 2),
 align AS (SELECT table_id, column_id, CASE WHEN dl <= dm AND dl <= dr THEN 'left' WHEN dm <= dr THEN 'middle' ELSE 'right' END AS alignment,
 CASE WHEN dl <= dm AND dl <= dr THEN lft WHEN dm <= dr THEN mid ELSE rgt END AS median_x, width, height FROM stats)"""
_FINAL = "final AS (SELECT table_id, token_id, cell_id FROM (SELECT *, row_number() OVER (PARTITION BY table_id, token_id ORDER BY round(iopdf, 9) DESC, cell_id) AS n FROM match) f WHERE n = 1)"
_TEXTS = "texts AS (SELECT f.table_id, f.cell_id, string_agg(t.text, ' ' ORDER BY t.token_id) AS text FROM final f JOIN d_tokens t ON t.table_id = f.table_id AND t.token_id = f.token_id GROUP BY 1, 2)"
_GRID = """spans AS (SELECT table_id, cell_id, row_id AS r0, row_id + CASE WHEN column_id = 2 AND row_id % 3 = 0 THEN 1 ELSE 0 END AS r1, column_id AS c0,
 column_id + CASE WHEN column_id = 0 AND row_id % 4 = 1 THEN 1 ELSE 0 END AS c1 FROM d_table_cells),
 size AS (SELECT table_id, max(r1) AS h, max(c1) AS w FROM spans GROUP BY 1),
 slots AS (SELECT table_id, row, unnest(range(w + 1)) AS col FROM (SELECT table_id, w, unnest(range(h + 1)) AS row FROM size) s),
 grid AS (SELECT table_id, row, col, cell_id, r0 AS start_row, c0 AS start_col FROM (SELECT s.table_id, s.row, s.col, p.cell_id, p.r0, p.c0,
 row_number() OVER (PARTITION BY s.table_id, s.row, s.col ORDER BY p.cell_id DESC NULLS LAST) AS n FROM slots s LEFT JOIN spans p ON p.table_id = s.table_id AND s.row BETWEEN p.r0 AND p.r1 AND s.col BETWEEN p.c0 AND p.c1) g WHERE n = 1)"""
_OTSL = """tokens AS (SELECT table_id, unnest(string_split(otsl, ' ')) AS token, unnest(range(len(string_split(otsl, ' ')))) AS pos FROM d_otsl),
 rows_ AS (SELECT table_id, pos, token, CAST(coalesce(sum(CASE WHEN token = 'nl' THEN 1 ELSE 0 END) OVER (PARTITION BY table_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS row_id FROM tokens),
 placed AS (SELECT table_id, CAST(pos AS BIGINT) AS pos, token, row_id, CAST(row_number() OVER (PARTITION BY table_id, row_id ORDER BY pos) - 1 AS BIGINT) AS col_id FROM rows_ WHERE token <> 'nl')"""

SQL = {
    "otsl_explode": f"WITH {_OTSL} SELECT * FROM placed WHERE token IN ('fcel', 'ecel', 'xcel', 'ched', 'rhed', 'srow')",
    "otsl_square_check": f"WITH {_OTSL} SELECT table_id, count(*) AS n_rows, min(n) = max(n) AS is_square FROM (SELECT table_id, row_id, count(*) AS n FROM placed GROUP BY 1, 2) s GROUP BY 1",
    "table_cell_translate": "SELECT table_id, cell_id, round(36 + x1 / 1000 * 540, 6) AS x1, round(72 + y1 / 1000 * 648, 6) AS y1, round(36 + x2 / 1000 * 540, 6) AS x2, round(72 + y2 / 1000 * 648, 6) AS y2 FROM d_table_cells",
    "table_token_match": f"WITH {_MATCH} SELECT table_id, cell_id, token_id, round(iou, 6) AS iou, round(iopdf, 6) AS iopdf FROM match",
    "table_column_alignment": f"WITH {_MATCH}, {_ALIGN} SELECT * FROM align",
    "table_move_bad_cells": f"""WITH {_MATCH}, {_ALIGN}, hit AS (SELECT DISTINCT table_id, cell_id FROM match),
 j AS (SELECT c.*, a.alignment, a.median_x, (h.cell_id IS NULL OR c.cell_class <= 1) AND a.alignment IS NOT NULL AS moved FROM d_table_cells c
 LEFT JOIN hit h ON h.table_id = c.table_id AND h.cell_id = c.cell_id LEFT JOIN align a ON a.table_id = c.table_id AND a.column_id = c.column_id),
 k AS (SELECT *, CASE alignment WHEN 'left' THEN median_x WHEN 'middle' THEN median_x - (x2 - x1) / 2 ELSE median_x - (x2 - x1) END AS nx FROM j)
 SELECT table_id, cell_id, CASE WHEN moved THEN nx ELSE x1 END AS x1, CASE WHEN moved THEN nx + (x2 - x1) ELSE x2 END AS x2, y1, y2, moved FROM k""",
    "table_dedup_columns": f"""WITH {_MATCH}, own AS (SELECT m.*, c.column_id FROM match m JOIN d_table_cells c ON c.table_id = m.table_id AND c.cell_id = m.cell_id),
 by_col AS (SELECT table_id, column_id, round(sum(iou + iopdf), 6) AS score, list_distinct(list(token_id)) AS toks FROM own GROUP BY 1, 2),
 pair AS (SELECT *, lead(column_id) OVER w AS nxt, lead(score) OVER w AS ns, lead(toks) OVER w AS nt FROM by_col WINDOW w AS (PARTITION BY table_id ORDER BY column_id))
 SELECT DISTINCT table_id, CASE WHEN score >= ns THEN nxt ELSE column_id END AS column_id FROM pair WHERE nxt IS NOT NULL AND len(list_intersect(toks, nt)) / len(toks) > 0.3""",
    "table_final_assignment": f"WITH {_MATCH}, {_FINAL} SELECT * FROM final",
    "table_align_to_tokens": f"""WITH {_MATCH}, {_FINAL} SELECT f.table_id, f.cell_id, min(t.x1) AS x1, min(t.y1) AS y1, max(t.x2) AS x2, max(t.y2) AS y2 FROM final f
 JOIN d_tokens t ON t.table_id = f.table_id AND t.token_id = f.token_id GROUP BY 1, 2""",
    "table_orphan_bands": f"""WITH {_MATCH}, lost AS (SELECT table_id, token_id, (x1 + x2) / 2 AS x, (y1 + y2) / 2 AS y FROM d_tokens t WHERE NOT EXISTS (SELECT 1 FROM match m WHERE m.table_id = t.table_id AND m.token_id = t.token_id)),
 rb AS (SELECT table_id, row_id, min(y1) AS lo, max(y2) AS hi FROM d_table_cells GROUP BY 1, 2), cb AS (SELECT table_id, column_id, min(x1) AS lo, max(x2) AS hi FROM d_table_cells GROUP BY 1, 2),
 rr AS (SELECT l.table_id, token_id, row_id, row_number() OVER (PARTITION BY l.table_id, token_id ORDER BY round_even(abs(y - (lo + hi) / 2), 3), row_id) AS n FROM lost l JOIN rb ON rb.table_id = l.table_id AND y BETWEEN lo AND hi),
 cc AS (SELECT l.table_id, token_id, column_id, row_number() OVER (PARTITION BY l.table_id, token_id ORDER BY round_even(abs(x - (lo + hi) / 2), 3), column_id) AS n FROM lost l JOIN cb ON cb.table_id = l.table_id AND x BETWEEN lo AND hi)
 SELECT l.table_id, l.token_id, row_id, column_id FROM lost l LEFT JOIN rr ON rr.table_id = l.table_id AND rr.token_id = l.token_id AND rr.n = 1 LEFT JOIN cc ON cc.table_id = l.table_id AND cc.token_id = l.token_id AND cc.n = 1""",
    "table_reconcile_rows": f"""WITH {_MATCH}, centres AS (SELECT table_id, row_id, avg((y1 + y2) / 2) AS y FROM d_table_cells GROUP BY 1, 2),
 steps AS (SELECT table_id, y - lag(y) OVER (PARTITION BY table_id ORDER BY row_id) AS step FROM centres), lim AS (SELECT table_id, coalesce(round(avg(step) * 0.6, 6), 15.0) AS lim FROM steps GROUP BY 1),
 lost AS (SELECT t.table_id, token_id, text, (y1 + y2) / 2 AS y, lim FROM d_tokens t JOIN lim ON lim.table_id = t.table_id WHERE NOT EXISTS (SELECT 1 FROM match m WHERE m.table_id = t.table_id AND m.token_id = t.token_id)),
 turns AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY table_id ORDER BY y, token_id) >= lim THEN 1 ELSE 0 END AS turn FROM lost)
 SELECT table_id, token_id, CAST(sum(turn) OVER (PARTITION BY table_id ORDER BY y, token_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS group_id,
 regexp_matches(text, '^(?:[$€£¥]|[-–—]?\\(?\\d[\\d,]*(?:\\.\\d+)?\\)?%?)$') AS is_value FROM turns""",
    "table_token_merge_text": f"WITH {_MATCH}, {_FINAL}, {_TEXTS} SELECT * FROM texts",
    "table_index_compaction": f"""WITH {_GRID}, r AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY table_id ORDER BY r0) - 1 AS BIGINT) AS row, CAST(dense_rank() OVER (PARTITION BY table_id ORDER BY c0) - 1 AS BIGINT) AS col FROM spans)
 SELECT table_id, cell_id, row, col, max(row + r1 - r0 + 1) OVER (PARTITION BY table_id) AS num_rows, max(col + c1 - c0 + 1) OVER (PARTITION BY table_id) AS num_cols FROM r""",
    "table_grid_fill": f"WITH {_GRID} SELECT * FROM grid",
    "table_row_col_hulls": """SELECT table_id, row_id AS ix, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, 0 AS axis FROM d_table_cells GROUP BY 1, 2
 UNION ALL SELECT table_id, column_id, min(x1), min(y1), max(x2), max(y2), 1 FROM d_table_cells GROUP BY 1, 2""",
    "table_export_otsl": f"""WITH {_MATCH}, {_FINAL}, {_TEXTS}, {_GRID}, tok AS (SELECT g.table_id, row, col, CASE WHEN g.cell_id IS NULL THEN 'ecel' WHEN col > start_col AND row > start_row THEN 'xcel' WHEN col > start_col THEN 'lcel'
 WHEN row > start_row THEN 'ucel' WHEN coalesce(text, '') = '' THEN 'ecel' ELSE 'fcel' END || CASE WHEN col = max(col) OVER (PARTITION BY g.table_id) THEN ' nl' ELSE '' END AS token
 FROM grid g LEFT JOIN texts t ON t.table_id = g.table_id AND t.cell_id = g.cell_id) SELECT table_id, string_agg(token, ' ' ORDER BY row, col) AS otsl FROM tok GROUP BY 1""",
    "table_triplets": f"""WITH {_MATCH}, {_FINAL}, {_TEXTS}, {_GRID}, f AS (SELECT g.table_id, row, col, coalesce(text, '') AS text FROM grid g LEFT JOIN texts t ON t.table_id = g.table_id AND t.cell_id = g.cell_id)
 SELECT f.table_id, string_agg(l.text || ', ' || h.text || ' = ' || f.text, '. ' ORDER BY f.row, f.col) AS text FROM f JOIN f h ON h.table_id = f.table_id AND h.row = 0 AND h.col = f.col
 JOIN f l ON l.table_id = f.table_id AND l.col = 0 AND l.row = f.row WHERE f.row > 0 AND f.col > 0 GROUP BY 1""",
}

QUERIES = (
    otsl_explode, otsl_square_check, table_cell_translate, table_token_match, table_column_alignment, table_move_bad_cells, table_dedup_columns, table_final_assignment,
    table_align_to_tokens, table_orphan_bands, table_reconcile_rows, table_token_merge_text, table_index_compaction, table_grid_fill, table_row_col_hulls,
    table_export_otsl, table_triplets, table_export_markdown,
)
