"""Queries over turned boxes, contained clusters, table repair, text rules, event windows and timings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import text as texts
from vellum.functions.geometry import Box
from vellum.operators import evaluation, layout, tables
from vellum.plans.fixtures import base, view
from vellum.plans.table_queries import _FINAL, _MATCH, _cells, _matches, _tokens
from vellum.streaming import windows


def _neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Each cluster with the next two of its page."""
    a = view(spark, d, "d_clusters").select("page_id", "cluster_id", *"ltrb")
    next_ = lambda k: a.select("page_id", (F.col("cluster_id") - k).alias("cluster_id"), *[F.col(c).alias(f"n{k}_{c}") for c in "ltrb"])
    return a.join(next_(1), ["page_id", "cluster_id"]).join(next_(2), ["page_id", "cluster_id"])


def geom_vertical_iou(spark: SparkSession, d: str) -> DataFrame:
    iou = Box.of().y_iou(Box.of("n1_"))
    return _neighbours(spark, d).select("page_id", "cluster_id", F.round(iou, 6).alias("iou"), (iou > 0.5).alias("level"))


def geom_beside(spark: SparkSession, d: str) -> DataFrame:
    return _neighbours(spark, d).select("page_id", "cluster_id", Box.of().beside(Box.of("n1_"), Box.of("n2_")).alias("beside"))


def geom_turned(spark: SparkSession, d: str) -> DataFrame:
    quad = Box.of().turned((F.col("cluster_id") * 90).cast("int"), F.lit(612.0), F.lit(792.0)).placed(3.0, 10.0, 20.0)
    return view(spark, d, "d_clusters").select("page_id", "cluster_id", *[F.round(c, 6).alias(f"{n}{i}") for n, cs in (("x", quad.xs), ("y", quad.ys)) for i, c in enumerate(cs)])


def geom_centred(spark: SparkSession, d: str) -> DataFrame:
    x, y, w, h = Box.of().joined(Box.of("n1_")).centre()
    again = Box.centred(x, y, w, h)
    return _neighbours(spark, d).select("page_id", "cluster_id", x.alias("x"), y.alias("y"), w.alias("width"), h.alias("height"), *again.columns())


def layout_predictions(spark: SparkSession, d: str) -> DataFrame:
    moved = view(spark, d, "d_clusters").withColumns({"l": F.col("l") - 50, "b": F.col("b") + 300})
    return layout.predicted(moved, view(spark, d, "d_pages"), 0.6, ("footnote", "caption"))


def layout_without_contained(spark: SparkSession, d: str) -> DataFrame:
    return layout.without_contained(view(spark, d, "d_clusters")).select("page_id", "cluster_id")


def _regions(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of which tables are forms on every second page, and pictures key-value regions."""
    label = F.when((F.col("label") == "table") & (F.col("page_id") % 2 == 0), "form").when(F.col("label") == "picture", "key_value_region").otherwise(F.col("label"))
    return view(spark, d, "d_clusters").withColumn("label", label)


def layout_around_children(spark: SparkSession, d: str) -> DataFrame:
    return layout.around_children(_regions(spark, d)).select("page_id", "cluster_id", *"ltrb")


def layout_doubled_wrappers(spark: SparkSession, d: str) -> DataFrame:
    clusters = view(spark, d, "d_clusters")
    copies = clusters.where("label = 'table'").select("page_id", (F.col("cluster_id") + 100).alias("cluster_id"), F.lit("key_value_region").alias("label"), (F.col("confidence") + F.when(F.col("page_id") % 3 == 0, 0.2).otherwise(0.05)).alias("confidence"), "l", (F.col("t") + 1).alias("t"), "r", "b")
    return layout.without_doubled_wrappers(clusters.unionByName(copies)).select("page_id", "cluster_id")


def layout_refined(spark: SparkSession, d: str) -> DataFrame:
    cells, clusters = view(spark, d, "d_cells"), view(spark, d, "d_clusters")
    found, assigned = layout.refined(clusters, cells, layout.assign_cells(cells, clusters).select("page_id", "cell_ix", "cluster_id"))
    n = assigned.groupBy("page_id", "cluster_id").agg(F.count("*").alias("n_cells"))
    return found.join(n, ["page_id", "cluster_id"], "left").select("page_id", "cluster_id", "label", *"ltrb", "n_cells")


def cells_first_wins(spark: SparkSession, d: str) -> DataFrame:
    cells = view(spark, d, "d_cells")
    more = cells.withColumns({"cell_ix": F.col("cell_ix") + 2, "text": F.concat(F.lit("ocr "), "text")})
    return layout.first_cells(cells, more).select("page_id", "cell_ix", "text")


def tables_with_predictions(spark: SparkSession, d: str) -> DataFrame:
    clusters = view(spark, d, "d_clusters")
    found = clusters.where("page_id % 4 <> 1").select("page_id", "cluster_id", (F.col("cluster_id") + 1).alias("n_rows"), F.lit(2).cast("bigint").alias("n_cols"), F.lit("fcel fcel nl").alias("otsl"))
    return layout.with_predictions(clusters, found)


def candidate_histogram(spark: SparkSession, d: str) -> DataFrame:
    return layout.candidate_counts(view(spark, d, "d_cells"), view(spark, d, "d_clusters"))


def otsl_decoded(spark: SparkSession, d: str) -> DataFrame:
    return tables.decoded(view(spark, d, "d_otsl_odd"))


def table_synced_boxes(spark: SparkSession, d: str) -> DataFrame:
    tags = view(spark, d, "d_rows").select(F.col("page_id").alias("table_id"), F.col("ix").alias("pos"), F.when(F.col("pk") % 5 == 0, ">").when(F.col("pk") % 5 == 1, "</td>").otherwise("<td>").alias("tag"))
    boxes = view(spark, d, "d_rows").select(F.col("page_id").alias("table_id"), "ix")
    return tables.synced_boxes(tags, boxes)


def table_without_columns(spark: SparkSession, d: str) -> DataFrame:
    cells, matches = _cells(spark, d), _matches(spark, d)
    return tables.without_columns(cells, matches, tables.doubled_columns(cells, matches, 0.3))[1].select("table_id", "cell_id", "token_id")


def table_matched_kinds(spark: SparkSession, d: str) -> DataFrame:
    return tables.matched_kinds(_cells(spark, d), _matches(spark, d))


def table_token_columns(spark: SparkSession, d: str) -> DataFrame:
    return tables.token_columns(_cells(spark, d), tables.with_text(_tokens(spark, d)))


def table_missing_rows(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of the second row moved under the table in the tables of seven cells; a few tokens are blank."""
    tokens = view(spark, d, "d_tokens_lost")
    return tables.missing_rows(_cells(spark, d), tokens, tables.matched(_cells(spark, d), tokens))


def table_responses(spark: SparkSession, d: str) -> DataFrame:
    label = F.element_at(F.array(*map(F.lit, ["ched", "rhed", "srow", "fcel"])), (F.col("cell_id") % 4 + 1).cast("int"))
    cells = _cells(spark, d).withColumns({"label": label, "row_span": 1 + F.when(F.col("row_id") % 3 == 0, 1).otherwise(0), "col_span": 1 + F.when(F.col("column_id") == 0, 1).otherwise(0)})
    return tables.responses(cells, _matches(spark, d))


def table_rows_moved(spark: SparkSession, d: str) -> DataFrame:
    """Row 1 is taken out, and two empty rows are put in before row 1."""
    cells = tables.with_space(tables.without_row(_cells(spark, d), 1), 1, 2)
    return cells.select("table_id", "cell_id", F.col("row_id").cast("bigint").alias("row_id"), "column_id")


def text_code_language(spark: SparkSession, d: str) -> DataFrame:
    marked = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<_Python_> "), "text")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("<_C++_>\n"), "text")).otherwise(F.concat(F.lit("<_Go_>"), "text"))
    language, rest = texts.code_language(marked)
    return base(spark, d, "documents").select("doc_id", language.alias("language"), F.md5(rest).alias("rest_md5"))


_STYLES = [("Heading", "%s 1"), ("Heading", "2 %s"), ("Title", "%s"), ("List Bullet", "%s 3"), ("heading", "%s12"), ("a1b", "%s2")]


def text_heading_style(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*[F.lit(form % name) for name, form in _STYLES])
    rows = base(spark, d, "part").select("p_partkey", F.element_at(names, (F.col("p_partkey") % len(_STYLES) + 1).cast("int")).alias("style"))
    label, level = texts.heading_style(F.col("style"))
    return rows.select("p_partkey", texts.label_name(F.col("style")).alias("name"), label.alias("label"), level.alias("level"))


def text_data_uri(spark: SparkSession, d: str) -> DataFrame:
    rows = base(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("https://x/"), "source")).otherwise(F.concat(F.lit("data:image/png;base64,"), F.base64(F.encode("source", "UTF-8")))).alias("uri"))
    kind, data = texts.data_uri(F.col("uri"))
    return rows.select("doc_id", kind.alias("kind"), F.decode(data, "UTF-8").alias("content"))


def text_datetimes(spark: SparkSession, d: str) -> DataFrame:
    value = F.when(F.col("event_id") % 4 == 0, F.col("event_id").cast("string")).when(F.col("event_id") % 4 == 1, F.col("event_type")).when(F.col("event_id") % 4 == 2, F.lit("2024-02-31 10:00:00")).otherwise(F.concat(F.lit("2024-02-1"), (F.col("event_id") % 10).cast("string"), F.lit("T08:30:00")))
    return base(spark, d, "events").select("event_id", texts.is_datetime(value).alias("valid"))


def text_controls(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("  \t"), "source")).otherwise(F.concat("lang", F.lit("\x02 a \n\n b  ")))
    text = F.when(F.col("doc_id") % 7 == 0, "   ").otherwise(text)
    rows = base(spark, d, "documents").select("doc_id", texts.single_spaced(texts.plain_controls(text)).alias("text"))
    return rows.where("text <> ''")


def text_similarity(spark: SparkSession, d: str) -> DataFrame:
    rows = base(spark, d, "conversations").select("conv_id", "turn", "text")
    after = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
    return rows.join(after, ["conv_id", "turn"]).select("conv_id", "turn", F.round(texts.similarity("text", "next"), 6).alias("ratio"))


def event_windows_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return windows.counted(_events(spark, d), "1 hour").withColumn("opens", F.unix_micros("opens"))


def event_windows_sliding(spark: SparkSession, d: str) -> DataFrame:
    return windows.counted(_events(spark, d), "1 hour", "20 minutes").withColumn("opens", F.unix_micros("opens"))


def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    return windows.sessions(_events(spark, d), "30 minutes").withColumns({c: F.unix_micros(c) for c in ("opens", "last")})


def _events(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def stage_overdue(spark: SparkSession, d: str) -> DataFrame:
    """Users as jobs: a view opens a stage, a purchase closes it; judged at the last event."""
    events = _events(spark, d)
    opened = events.where("event_type = 'view'").groupBy(F.col("user_id").alias("job_id")).agg(F.max("ts").alias("opened"))
    closed = events.where("event_type = 'purchase'").groupBy(F.col("user_id").alias("job_id")).agg(F.max("ts").alias("closed"))
    return windows.overdue(opened, closed, events.agg(F.max("ts").alias("now")), warn=6 * 3600.0, error=48 * 3600.0)


def page_timings_best(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user are repeated runs of pages: the best run of each page, and each user's total."""
    runs = base(spark, d, "events").select("user_id", (F.col("event_id") % 7).alias("page_no"), F.col("value").alias("seconds"))
    return evaluation.best_of_runs(runs, ["user_id", "page_no"]).groupBy("user_id").agg(F.round(F.sum("seconds"), 6).alias("seconds"), F.count("*").alias("pages"))


def edge_colours(spark: SparkSession, d: str) -> DataFrame:
    """Parts are pixels of images of one brand: 10 x 10 places, of which the edges count."""
    pixels = base(spark, d, "part").select(F.col("p_brand").alias("image"), (F.col("p_partkey") % 10).alias("x"), (F.floor(F.col("p_partkey") / 10) % 10).alias("y"), (F.col("p_size") % 5).cast("bigint").alias("colour"))
    return evaluation.edge_colour(pixels, 10, 10)


_N = "nb AS (SELECT c.page_id, c.cluster_id, c.l, c.t, c.r, c.b, " + ", ".join(f"n{k}.{x} AS n{k}_{x}" for k in (1, 2) for x in "ltrb") + " FROM d_clusters c " + " ".join(f"JOIN d_clusters n{k} ON n{k}.page_id = c.page_id AND n{k}.cluster_id = c.cluster_id + {k}" for k in (1, 2)) + ")"
_INSIDE = """inside AS (SELECT c.page_id, s.cluster_id AS special_id, c.cluster_id AS child_id, c.l, c.t, c.r, c.b FROM cl c JOIN cl s ON c.page_id = s.page_id AND c.label NOT IN ({s}) AND s.label IN ({s})
 WHERE greatest(0, least(c.r, s.r) - greatest(c.l, s.l)) * greatest(0, least(c.b, s.b) - greatest(c.t, s.t)) / ((c.r - c.l) * (c.b - c.t)) > 0.8)""".format(s="'form', 'key_value_region', 'table', 'document_index', 'picture'")
_MISSING = """lostt AS (SELECT t.*, (y1 + y2) / 2 AS y FROM d_tokens_lost t WHERE trim(text) <> '' AND NOT EXISTS (SELECT 1 FROM d_table_cells c WHERE c.table_id = t.table_id AND least(c.x2, t.x2) > greatest(c.x1, t.x1) AND least(c.y2, t.y2) > greatest(c.y1, t.y1))),
 few AS (SELECT a.table_id FROM (SELECT table_id, count(*) AS n FROM d_tokens_lost GROUP BY 1) a JOIN (SELECT table_id, count(*) AS m FROM lostt GROUP BY 1) b ON a.table_id = b.table_id WHERE m / n <= 0.35),
 cent AS (SELECT table_id, row_id, avg((y1 + y2) / 2) AS y FROM d_table_cells GROUP BY 1, 2), pit AS (SELECT table_id, CASE WHEN count(*) > 1 THEN round((max(y) - min(y)) / (count(*) - 1) * 0.6, 9) ELSE 15.0 END AS pitch FROM cent GROUP BY 1),
 tn AS (SELECT l.*, p.pitch, CASE WHEN y - lag(y) OVER w >= p.pitch THEN 1 ELSE 0 END AS turn, row_number() OVER w AS place FROM lostt l JOIN pit p ON p.table_id = l.table_id WHERE l.table_id IN (SELECT table_id FROM few) WINDOW w AS (PARTITION BY l.table_id ORDER BY y, token_id)),
 gr AS (SELECT *, sum(turn) OVER (PARTITION BY table_id ORDER BY y, token_id) AS g, sum(turn) OVER (PARTITION BY table_id) AS lastg FROM tn),
 bandc AS (SELECT table_id, column_id, min(x1) AS lo, max(x2) AS hi FROM d_table_cells GROUP BY 1, 2), bandr AS (SELECT table_id, row_id, min(y1) AS lo, max(y2) AS hi FROM d_table_cells GROUP BY 1, 2),
 pl AS (SELECT * FROM (SELECT g.*, b.column_id, row_number() OVER (PARTITION BY g.table_id, token_id ORDER BY least(x2, hi) - greatest(x1, lo) DESC, column_id) AS n FROM gr g JOIN bandc b ON b.table_id = g.table_id AND least(x2, hi) > greatest(x1, lo) WHERE lastg < 3) q WHERE n = 1),
 tb AS (SELECT table_id, min(column_id) AS lab, max(row_id) AS lr, max(cell_id) AS lc FROM d_table_cells GROUP BY 1),
 cand AS (SELECT p.table_id, g, max(pitch) AS pitch FROM pl p JOIN tb ON tb.table_id = p.table_id GROUP BY 1, 2 HAVING count(*) >= 2 AND count(DISTINCT column_id) >= 2 AND bool_or(column_id = lab)
  AND bool_or(column_id <> lab AND regexp_matches(text, '^(?:[$€£¥]|[-–—]?\\(?\\d[\\d,]*(?:\\.\\d+)?\\)?%?)$'))),
 ext AS (SELECT table_id, g, min(y1) AS top, max(y2) AS bot FROM gr GROUP BY 1, 2),
 ok AS (SELECT c.table_id, c.g, row_number() OVER (PARTITION BY c.table_id ORDER BY c.g) AS k FROM cand c JOIN ext e ON e.table_id = c.table_id AND e.g = c.g
  WHERE NOT EXISTS (SELECT 1 FROM bandr b WHERE b.table_id = c.table_id AND e.bot >= b.lo - least(4, c.pitch * 0.25) AND e.top <= b.hi + least(4, c.pitch * 0.25))),
 made AS (SELECT p.table_id, lr + k AS row_id, column_id, max(lc) AS lc, min(place) AS place, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM pl p JOIN ok ON ok.table_id = p.table_id AND ok.g = p.g JOIN tb ON tb.table_id = p.table_id GROUP BY 1, 2, 3)
 SELECT table_id, CAST(lc + row_number() OVER (PARTITION BY table_id ORDER BY place) AS BIGINT) AS cell_id, CAST(row_id AS BIGINT) AS row_id, column_id, x1, y1, x2, y2 FROM made"""
_T = "CASE cluster_id * 90 % 360 WHEN 90 THEN {} WHEN 180 THEN {} WHEN 270 THEN {} ELSE {} END"
_X0, _Y0 = _T.format("b", "612 - l", "792 - b", "l"), _T.format("612 - l", "792 - b", "l", "b")
_WX, _WY = _T.format("0", "-(r - l)", "0", "r - l"), _T.format("-(r - l)", "0", "r - l", "0")
_HX, _HY = _T.format("-(b - t)", "0", "b - t", "0"), _T.format("0", "b - t", "0", "-(b - t)")
_STYLE = "list_extract([" + ", ".join("'" + form % name + "'" for name, form in _STYLES) + f"], CAST(p_partkey % {len(_STYLES)} + 1 AS BIGINT))"

SQL = {
    "geom_vertical_iou": f"WITH {_N}, i AS (SELECT *, CASE WHEN least(b, n1_b) > greatest(t, n1_t) THEN (least(b, n1_b) - greatest(t, n1_t)) / (greatest(b, n1_b) - least(t, n1_t)) ELSE 0 END AS iou FROM nb) SELECT page_id, cluster_id, round(iou, 6) AS iou, iou > 0.5 AS level FROM i",
    "geom_beside": f"WITH {_N} SELECT page_id, cluster_id, NOT (t < greatest(n1_b, n2_b) AND least(n1_t, n2_t) < b) AND l < n1_r AND n2_l < r AS beside FROM nb",
    "geom_turned": f"""WITH q AS (SELECT page_id, cluster_id, {_X0} AS x, {_Y0} AS y, {_WX} AS wx, {_WY} AS wy, {_HX} AS hx, {_HY} AS hy FROM d_clusters)
 SELECT page_id, cluster_id, round(x / 3 + 10, 6) AS x0, round((x + wx) / 3 + 10, 6) AS x1, round((x + wx + hx) / 3 + 10, 6) AS x2, round((x + hx) / 3 + 10, 6) AS x3,
 round(y / 3 + 20, 6) AS y0, round((y + wy) / 3 + 20, 6) AS y1, round((y + wy + hy) / 3 + 20, 6) AS y2, round((y + hy) / 3 + 20, 6) AS y3 FROM q""",
    "geom_centred": f"""WITH {_N}, u AS (SELECT page_id, cluster_id, least(l, n1_l) AS l, least(t, n1_t) AS t, greatest(r, n1_r) AS r, greatest(b, n1_b) AS b FROM nb)
 SELECT page_id, cluster_id, (l + r) / 2 AS x, (t + b) / 2 AS y, r - l AS width, b - t AS height, l, t, r, b FROM u""",
    "layout_predictions": "SELECT page_id, cluster_id, label, confidence, greatest(0.0, least(l - 50, 612.0)) AS l, greatest(0.0, least(t, 792.0)) AS t, greatest(0.0, least(r, 612.0)) AS r, greatest(0.0, least(b + 300, 792.0)) AS b FROM d_clusters WHERE confidence >= 0.6 AND label NOT IN ('footnote', 'caption')",
    "layout_without_contained": f"WITH cl AS (SELECT * FROM d_clusters), {_INSIDE} SELECT page_id, cluster_id FROM cl c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.page_id = c.page_id AND i.child_id = c.cluster_id)",
    "layout_around_children": f"""WITH cl AS (SELECT page_id, cluster_id, CASE WHEN label = 'table' AND page_id % 2 = 0 THEN 'form' WHEN label = 'picture' THEN 'key_value_region' ELSE label END AS label, l, t, r, b FROM d_clusters), {_INSIDE},
 h AS (SELECT page_id, special_id, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM inside GROUP BY 1, 2)
 SELECT c.page_id, c.cluster_id, """ + ", ".join(f"CASE WHEN c.label IN ('form', 'key_value_region') THEN coalesce(h.{x}, c.{x}) ELSE c.{x} END AS {x}" for x in "ltrb") + " FROM cl c LEFT JOIN h ON h.page_id = c.page_id AND h.special_id = c.cluster_id",
    "layout_doubled_wrappers": """WITH cl AS (SELECT * FROM d_clusters UNION ALL SELECT page_id, cluster_id + 100, 'key_value_region', confidence + CASE WHEN page_id % 3 = 0 THEN 0.2 ELSE 0.05 END, l, t + 1, r, b FROM d_clusters WHERE label = 'table')
 SELECT page_id, cluster_id FROM cl c WHERE NOT (label IN ('form', 'key_value_region', 'document_index') AND EXISTS (SELECT 1 FROM cl x WHERE x.page_id = c.page_id AND x.label = 'table' AND c.confidence - x.confidence < 0.1
 AND greatest(0, least(c.r, x.r) - greatest(c.l, x.l)) * greatest(0, least(c.b, x.b) - greatest(c.t, x.t)) / ((c.r - c.l) * (c.b - c.t)) > 0.9))""",
    "cells_first_wins": "WITH u AS (SELECT page_id, cell_ix, text, 0 AS turn FROM d_cells UNION ALL SELECT page_id, cell_ix + 2, 'ocr ' || text, 1 FROM d_cells) SELECT page_id, cell_ix, text FROM (SELECT *, row_number() OVER (PARTITION BY page_id, cell_ix ORDER BY turn) AS n FROM u) q WHERE n = 1",
    "tables_with_predictions": "SELECT page_id, cluster_id, CASE WHEN page_id % 4 <> 1 THEN cluster_id + 1 ELSE 0 END AS n_rows, CAST(CASE WHEN page_id % 4 <> 1 THEN 2 ELSE 0 END AS BIGINT) AS n_cols, CASE WHEN page_id % 4 <> 1 THEN 'fcel fcel nl' ELSE '' END AS otsl FROM d_clusters WHERE label = 'table'",
    "candidate_histogram": """WITH n AS (SELECT c.page_id, c.cell_ix, count(k.cluster_id) AS n FROM d_cells c LEFT JOIN d_clusters k ON k.page_id = c.page_id AND c.r > k.l AND k.r > c.l AND c.b > k.t AND k.b > c.t WHERE trim(c.text) <> '' GROUP BY 1, 2),
 s AS (SELECT page_id, list(n ORDER BY n) AS c FROM n GROUP BY 1) SELECT page_id, c[len(c) // 2 + 1] AS p50, c[CAST(floor(len(c) * 0.95) AS BIGINT) + 1] AS p95, c[-1] AS most FROM s""",
    "otsl_decoded": """WITH s AS (SELECT table_id, string_split(otsl, ' ') AS t FROM d_otsl_odd), e AS (SELECT table_id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM s), x AS (SELECT table_id, pos, CASE token WHEN 'xcel' THEN 'lcel' ELSE token END AS token FROM e),
 f AS (SELECT table_id, pos, CASE WHEN token = 'lcel' AND lag(token) OVER (PARTITION BY table_id ORDER BY pos) = 'ucel' THEN 'fcel' ELSE token END AS token FROM x), p AS (SELECT *, lag(token) OVER (PARTITION BY table_id ORDER BY pos) AS prev FROM f),
 o AS (SELECT *, token = 'lcel' AND coalesce(prev <> 'lcel', TRUE) AS opens, (token = 'lcel' AND coalesce(prev <> 'lcel', TRUE)) OR (prev IS NOT NULL AND prev NOT IN ('nl', 'ucel', 'xcel') AND token IN ('fcel', 'ecel', 'ched', 'rhed', 'srow', 'nl', 'ucel')) AS gives FROM p),
 b AS (SELECT *, CASE WHEN gives THEN sum(CASE WHEN gives THEN 1 ELSE 0 END) OVER (PARTITION BY table_id ORDER BY pos) - 1 END AS box FROM o),
 g AS (SELECT *, lag(opens) OVER w AS was, lag(box) OVER w AS last FROM b WHERE gives WINDOW w AS (PARTITION BY table_id ORDER BY pos))
 SELECT b.table_id, CAST(b.pos AS BIGINT) AS pos, b.token, CAST(b.box AS BIGINT) AS box, CAST(CASE WHEN g.was AND NOT g.opens THEN g.last END AS BIGINT) AS span_start FROM b LEFT JOIN g ON g.table_id = b.table_id AND g.pos = b.pos""",
    "table_synced_boxes": """WITH t AS (SELECT page_id AS table_id, ix AS pos, CASE pk % 5 WHEN 0 THEN '>' WHEN 1 THEN '</td>' ELSE '<td>' END AS tag FROM d_rows), c AS (SELECT table_id, tag, count(*) OVER (PARTITION BY table_id ORDER BY pos) AS ix FROM t WHERE tag IN ('<td>', '>')),
 n AS (SELECT table_id, count(*) AS n FROM c GROUP BY 1), h AS (SELECT page_id AS table_id, count(*) AS n FROM d_rows GROUP BY 1)
 SELECT r.page_id AS table_id, r.ix FROM d_rows r JOIN h ON h.table_id = r.page_id LEFT JOIN n ON n.table_id = r.page_id WHERE h.n = coalesce(n.n, 0) OR NOT EXISTS (SELECT 1 FROM c WHERE c.table_id = r.page_id AND c.tag = '>' AND c.ix = r.ix)""",
    "table_without_columns": f"""WITH {_MATCH}, own AS (SELECT m.*, c.column_id FROM match m JOIN d_table_cells c ON c.table_id = m.table_id AND c.cell_id = m.cell_id),
 by_col AS (SELECT table_id, column_id, round(sum(iou + iopdf), 6) AS score, list_distinct(list(token_id)) AS toks FROM own GROUP BY 1, 2),
 pair AS (SELECT *, lead(column_id) OVER w AS nxt, lead(score) OVER w AS ns, lead(toks) OVER w AS nt FROM by_col WINDOW w AS (PARTITION BY table_id ORDER BY column_id)),
 gone AS (SELECT DISTINCT table_id, CASE WHEN score >= ns THEN nxt ELSE column_id END AS column_id FROM pair WHERE nxt IS NOT NULL AND len(list_intersect(toks, nt)) / len(toks) > 0.3)
 SELECT table_id, cell_id, token_id FROM own o WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.table_id = o.table_id AND g.column_id = o.column_id)""",
    "table_matched_kinds": f"""WITH {_MATCH}, h AS (SELECT table_id, cell_id, count(*) AS hits FROM match GROUP BY 1, 2) SELECT c.table_id, c.column_id, CAST(sum(CASE WHEN cell_class > 1 THEN coalesce(hits, 0) ELSE 0 END) AS BIGINT) AS good,
 CAST(sum(CASE WHEN cell_class > 1 AND hits IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS bad FROM d_table_cells c LEFT JOIN h ON h.table_id = c.table_id AND h.cell_id = c.cell_id GROUP BY 1, 2""",
    "table_token_columns": """WITH b AS (SELECT table_id, column_id, min(x1) AS lo, max(x2) AS hi FROM d_table_cells GROUP BY 1, 2), o AS (SELECT t.table_id, t.token_id, b.column_id, least(t.x2, hi) - greatest(t.x1, lo) AS overlap FROM d_tokens t JOIN b ON b.table_id = t.table_id)
 SELECT table_id, token_id, column_id, overlap FROM (SELECT *, row_number() OVER (PARTITION BY table_id, token_id ORDER BY overlap DESC, column_id) AS n FROM o WHERE overlap > 0) q WHERE n = 1""",
    "table_missing_rows": f"WITH {_MISSING}",
    "table_responses": f"""WITH {_MATCH}, c AS (SELECT *, list_extract(['ched', 'rhed', 'srow', 'fcel'], CAST(cell_id % 4 + 1 AS BIGINT)) AS label, 1 + CASE WHEN row_id % 3 = 0 THEN 1 ELSE 0 END AS rs, 1 + CASE WHEN column_id = 0 THEN 1 ELSE 0 END AS cs FROM d_table_cells),
 j AS (SELECT m.table_id, m.token_id, c.*, row_number() OVER (PARTITION BY m.table_id, m.token_id ORDER BY c.cell_id DESC) AS n FROM match m JOIN c ON c.table_id = m.table_id AND c.cell_id = m.cell_id),
 f AS (SELECT table_id, token_id, bool_or(label = 'ched') AS column_header, bool_or(label = 'rhed') AS row_header, bool_or(label = 'srow') AS row_section FROM j GROUP BY 1, 2)
 SELECT f.*, row_id AS start_row, row_id + rs AS end_row, column_id AS start_col, column_id + cs AS end_col FROM f JOIN j ON j.table_id = f.table_id AND j.token_id = f.token_id AND j.n = 1""",
    "table_rows_moved": "SELECT table_id, cell_id, CASE WHEN row_id > 1 THEN row_id + 1 ELSE row_id END AS row_id, column_id FROM d_table_cells WHERE row_id <> 1",
    "text_code_language": "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Python' WHEN 1 THEN 'C++' END AS language, md5(CASE WHEN doc_id % 3 = 2 THEN '<_Go_>' || text ELSE text END) AS rest_md5 FROM documents",
    "text_heading_style": f"""WITH s AS (SELECT p_partkey, {_STYLE} AS style FROM part), w AS (SELECT *, CASE WHEN regexp_matches(style, '^\\D+\\d+$') THEN regexp_extract(style, '^(\\D+)(\\d+)$', 1) WHEN regexp_matches(style, '^\\d+\\D+') THEN regexp_extract(style, '^(\\d+)(\\D+)', 2) END AS word,
 TRY_CAST(CASE WHEN regexp_matches(style, '^\\D+\\d+$') THEN regexp_extract(style, '^(\\D+)(\\d+)$', 2) WHEN regexp_matches(style, '^\\d+\\D+') THEN regexp_extract(style, '^(\\d+)(\\D+)', 1) END AS INTEGER) AS num FROM s)
 SELECT p_partkey, translate(lower(style), ' -', '__') AS name, CASE WHEN word IS NULL THEN style WHEN lower(trim(word)) = 'heading' THEN 'Heading' ELSE '' END AS label, CASE WHEN lower(trim(word)) = 'heading' THEN num WHEN word IS NOT NULL THEN 0 END AS level FROM w""",
    "text_data_uri": "SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN 'image/png' END AS kind, CASE WHEN doc_id % 4 <> 0 THEN source END AS content FROM documents",
    "text_datetimes": "SELECT event_id, event_id % 4 = 3 AS valid FROM events",
    "text_controls": "WITH t AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '   ' WHEN doc_id % 5 = 0 THEN '  ' || chr(9) || source ELSE lang || chr(2) || ' a ' || chr(10) || chr(10) || ' b  ' END AS text FROM documents), c AS (SELECT doc_id, regexp_replace(trim(replace(text, chr(2), '-')), '\\s+', ' ', 'g') AS text FROM t) SELECT * FROM c WHERE text <> ''",
    "event_windows_tumbling": "SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS opens, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "event_windows_sliding": "WITH w AS (SELECT unnest([0, 20, 40]) AS back), e AS (SELECT time_bucket(INTERVAL 20 MINUTE, ts) - to_minutes(back) AS opens, event_type, value FROM events, w) SELECT epoch_us(opens) AS opens, event_type, count(*) AS n, round(sum(value), 4) AS total FROM e GROUP BY 1, 2",
    "event_sessions": """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
 SELECT user_id, epoch_us(min(ts)) AS opens, epoch_us(max(ts)) AS last, count(*) AS n FROM s GROUP BY user_id, k""",
    "stage_overdue": """WITH o AS (SELECT user_id AS job_id, max(ts) AS opened FROM events WHERE event_type = 'view' GROUP BY 1), c AS (SELECT user_id AS job_id, max(ts) AS closed FROM events WHERE event_type = 'purchase' GROUP BY 1), n AS (SELECT max(ts) AS now FROM events),
 a AS (SELECT o.job_id, round((epoch_us(now) - epoch_us(opened)) / 1000000, 3) AS seconds FROM o CROSS JOIN n LEFT JOIN c ON c.job_id = o.job_id WHERE closed IS NULL OR closed < opened)
 SELECT job_id, seconds, CASE WHEN seconds >= 172800 THEN 'error' WHEN seconds >= 21600 THEN 'warning' ELSE 'in time' END AS state FROM a""",
    "page_timings_best": "SELECT user_id, round(sum(s), 6) AS seconds, count(*) AS pages FROM (SELECT user_id, event_id % 7 AS p, min(value) AS s FROM events GROUP BY 1, 2) q GROUP BY 1",
    "edge_colours": """WITH p AS (SELECT p_brand AS image, p_partkey % 10 AS x, CAST(floor(p_partkey / 10.0) AS BIGINT) % 10 AS y, CAST(p_size % 5 AS BIGINT) AS colour FROM part), c AS (SELECT image, colour, sum(CASE WHEN x IN (0, 9) AND y IN (0, 9) THEN 2 ELSE 1 END) AS n FROM p WHERE x IN (0, 9) OR y IN (0, 9) GROUP BY 1, 2)
 SELECT image, colour FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY n DESC, colour) AS k FROM c) q WHERE k = 1""",
}

QUERIES = (
    geom_vertical_iou, geom_beside, geom_turned, geom_centred, layout_predictions, layout_without_contained, layout_around_children, layout_doubled_wrappers, layout_refined, cells_first_wins,
    tables_with_predictions, candidate_histogram, otsl_decoded, table_synced_boxes, table_without_columns, table_matched_kinds, table_token_columns, table_missing_rows, table_responses, table_rows_moved,
    text_code_language, text_heading_style, text_data_uri, text_datetimes, text_controls, text_similarity, event_windows_tumbling, event_windows_sliding, event_sessions, stage_overdue, page_timings_best, edge_colours,
)
