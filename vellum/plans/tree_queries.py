"""Queries over document trees: building, editing, ranges, serialisers, readers and chunkers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.operators import chunking, documents, serialize, tree
from vellum.plans.document_queries import _PAIRS, _W
from vellum.plans.fixtures import view


def _walk(spark: SparkSession, d: str) -> DataFrame:
    return tree.walked(view(spark, d, "d_tree"))


def doc_tree_build(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(((F.col("cluster_id") % 2 == 0) | (F.col("doc_id") % 3 == 0)) & ~F.col("label").isin("table", "picture"), "text").otherwise(F.col("label"))
    items = view(spark, d, "d_elements").select("doc_id", "page_no", "cluster_id", label.alias("label"), F.col("cluster_id").alias("pos"), F.when(F.col("cluster_id") % 3 == 0, "it goes on and").when(F.col("cluster_id") % 3 == 1, "then goes on and").otherwise("on it went.").alias("text"))
    w = Window.partitionBy("doc_id", "page_no").orderBy("pos")
    captions = items.select("doc_id", "page_no", "label", F.lag("cluster_id").over(w).alias("target"), F.lag("label").over(w).alias("kind"), F.col("cluster_id").alias("caption"))
    captions = captions.where("label = 'caption' and kind in ('table', 'picture')").select("doc_id", "page_no", "target", "caption")
    found = tree.build(items, captions, documents.footnote_links(items), documents.merge_candidates(items, pages=True))
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s.start.cast("string"), F.lit("-"), s.stop.cast("string"))), ",")
    return found.withColumn("spans", spans)


def doc_append_nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes = view(spark, d, "d_tree").select("doc_id", "node_id", "parent_id", "child_ix", "label", "text")
    new = nodes.where("node_id < 2").select("doc_id", (F.col("node_id") + 1).alias("at"), F.lit(0).cast("bigint").alias("parent_id"), F.lit("text").alias("label"), F.concat(F.lit("new "), "text").alias("text"))
    return tree.appended(nodes, new)


def doc_insert_nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes = view(spark, d, "d_tree").select("doc_id", "node_id", "parent_id", "child_ix", "label", "text")
    new = nodes.where("node_id in (1, 2)").select("doc_id", F.col("node_id").alias("at"), F.col("node_id").alias("sibling_id"), (F.col("node_id") == 1).alias("before"), F.lit("text").alias("label"), F.concat(F.lit("new "), "text").alias("text"))
    return tree.inserted(nodes, new)


def doc_concat(spark: SparkSession, d: str) -> DataFrame:
    nodes = view(spark, d, "d_tree").select("doc_id", "node_id", "parent_id", "child_ix", "label")
    return tree.joined(nodes, nodes.withColumn("doc_id", F.col("doc_id") - 1))


def doc_extract_range(spark: SparkSession, d: str) -> DataFrame:
    return tree.extracted(_walk(spark, d), 1, 4)


def doc_delete_range(spark: SparkSession, d: str) -> DataFrame:
    return tree.without_range(_walk(spark, d), 2, 3)


def doc_selected_items(spark: SparkSession, d: str) -> DataFrame:
    found = tree.selected(_walk(spark, d), layers=["body"], labels=["text", "list_item", "code", "title"], pages=[1, 2], start=1, stop=5)
    return found.select("doc_id", "node_id", "pos")


def doc_markdown(spark: SparkSession, d: str) -> DataFrame:
    return serialize.to_markdown(_walk(spark, d))


def doc_plain_text(spark: SparkSession, d: str) -> DataFrame:
    return serialize.to_text(_walk(spark, d))


def doc_outline(spark: SparkSession, d: str) -> DataFrame:
    return serialize.to_outline(_walk(spark, d))


def doc_html(spark: SparkSession, d: str) -> DataFrame:
    return serialize.to_html(_walk(spark, d))


def _tags(spark: SparkSession, d: str) -> DataFrame:
    place = F.concat(F.lit("<loc_"), (F.col("node_id") * 7 % 500).cast("string"), F.lit("><loc_"), (F.col("doc_id") % 500).cast("string"), F.lit(">"))
    return serialize.to_tags(_walk(spark, d).withColumn("place", place), "place")


def doc_doctags(spark: SparkSession, d: str) -> DataFrame:
    return _tags(spark, d)


def doc_json(spark: SparkSession, d: str) -> DataFrame:
    return serialize.to_json(_walk(spark, d))


def doc_json_read(spark: SparkSession, d: str) -> DataFrame:
    """Every tenth document does not read."""
    found = serialize.to_json(_walk(spark, d))
    return serialize.from_json(found.select(F.when(F.col("doc_id") % 10 == 0, "no json").otherwise(F.col("json")).alias("json")))


def doctags_read(spark: SparkSession, d: str) -> DataFrame:
    return serialize.from_tags(_tags(spark, d))


def doc_unreached(spark: SparkSession, d: str) -> DataFrame:
    """Trees with missing parents and cycles."""
    nodes = view(spark, d, "d_tree").withColumn("parent_id", F.expr(_BAD_PARENT))
    return tree.unreached(nodes, tree.walked(nodes))


def doctags_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(serialize.vocabulary())), "id bigint, token string")


def chunk_hierarchical(spark: SparkSession, d: str) -> DataFrame:
    found = chunking.hierarchical(_walk(spark, d))
    nodes = F.array_join(F.transform("nodes", lambda n: n.cast("string")), ",")
    return found.select("doc_id", "chunk_id", F.array_join("headings", " > ").alias("headings"), "text", nodes.alias("nodes"))


def chunk_by_page(spark: SparkSession, d: str) -> DataFrame:
    return chunking.by_page(_walk(spark, d))


def chunk_hybrid_tree(spark: SparkSession, d: str) -> DataFrame:
    return chunking.hybrid(_walk(spark, d), 4).select("doc_id", "chunk_id", "heading", "text", "n_tokens")


_WALK = """walk0(doc_id, node_id, parent_id, label, layer, level, page_no, text, path, lists) AS (SELECT doc_id, node_id, parent_id, label, layer, level, page_no, text, [node_id], CAST([] AS BIGINT[]) FROM d_tree WHERE parent_id IS NULL
 UNION ALL SELECT t.doc_id, t.node_id, t.parent_id, t.label, t.layer, t.level, t.page_no, t.text, list_append(w.path, t.node_id), CASE WHEN w.label IN ('list', 'ordered_list') THEN list_append(w.lists, w.node_id) ELSE w.lists END
 FROM walk0 w JOIN d_tree t ON t.doc_id = w.doc_id AND t.parent_id = w.node_id),
 walk AS (SELECT *, len(path) - 1 AS depth, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY path) - 1 AS BIGINT) AS pos FROM walk0)"""


def _parts(text: str) -> str:
    return f"""{_WALK}, mk AS (SELECT w.*, CASE WHEN p.label = 'ordered_list' THEN CAST(row_number() OVER (PARTITION BY w.doc_id, w.parent_id, w.label = 'list_item' ORDER BY w.pos) AS VARCHAR) || '.' ELSE '-' END AS marker, {text} AS esc
 FROM walk w LEFT JOIN walk p ON p.doc_id = w.doc_id AND p.node_id = w.parent_id),
 parts AS (SELECT * FROM (SELECT doc_id, pos, node_id, label, page_no, lists[1] AS list_id, CASE label WHEN 'list' THEN '' WHEN 'ordered_list' THEN '' WHEN 'title' THEN '# ' || esc WHEN 'section_header' THEN repeat('#', level + 1) || ' ' || esc
 WHEN 'list_item' THEN repeat(' ', 4 * greatest(len(lists) - 1, 0)) || marker || ' ' || esc WHEN 'code' THEN '```' || chr(10) || text || chr(10) || '```' WHEN 'formula' THEN '$$' || text || '$$' WHEN 'picture' THEN '<!-- image -->' ELSE esc END AS part FROM mk) q WHERE part <> '')"""


_ESCAPED = "replace(replace(replace(replace(w.text, '_', '\\_'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_GAPS = "SELECT *, CASE WHEN lag(list_id) OVER w = list_id THEN chr(10) ELSE chr(10) || chr(10) END AS gap, row_number() OVER w AS n FROM parts WINDOW w AS (PARTITION BY {k} ORDER BY pos)"
_TEXT = "string_agg(CASE WHEN n = 1 THEN part ELSE gap || part END, '' ORDER BY pos) AS text"
_MAX = "9223372036854775807"


def _wrap(opening: str, closing: str, after: str = "text") -> str:
    return f"""{_WALK}, ev AS (SELECT doc_id, path, {opening} AS piece FROM walk UNION ALL SELECT doc_id, list_append(path, {_MAX}), {closing} FROM walk),
 wrapped AS (SELECT doc_id, string_agg(piece, '' ORDER BY path) AS text FROM ev GROUP BY 1), done AS (SELECT doc_id, {after} AS text FROM wrapped)"""


_HTML = "CASE label WHEN 'section_header' THEN 'h' || CAST(least(level + 1, 6) AS VARCHAR) WHEN 'title' THEN 'h1' WHEN 'list' THEN 'ul' WHEN 'ordered_list' THEN 'ol' WHEN 'list_item' THEN 'li' WHEN 'code' THEN 'pre' WHEN 'picture' THEN 'figure' WHEN 'formula' THEN 'div' ELSE 'p' END"
_TAG = "CASE label WHEN 'section_header' THEN 'section_header_level_' || CAST(level AS VARCHAR) WHEN 'list' THEN 'unordered_list' ELSE label END"
_TAGGED = _wrap(f"'<' || {_TAG} || '>' || '<loc_' || CAST(node_id * 7 % 500 AS VARCHAR) || '><loc_' || CAST(doc_id % 500 AS VARCHAR) || '>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')", f"'</' || {_TAG} || '>' || chr(10)", "'<doctag>' || text || '</doctag>'")
_RANK = "CAST(row_number() OVER (PARTITION BY doc_id, parent_id ORDER BY {}) - 1 AS BIGINT) AS child_ix"
_BUILD = f"""it AS (SELECT doc_id, page_no, cluster_id, CASE WHEN (cluster_id % 2 = 0 OR doc_id % 3 = 0) AND label NOT IN ('table', 'picture') THEN 'text' ELSE label END AS label, cluster_id AS pos, {_W} AS text FROM d_elements),
 cap AS (SELECT doc_id, page_no, target, own FROM (SELECT doc_id, page_no, cluster_id AS own, label, lag(cluster_id) OVER w AS target, lag(label) OVER w AS kind FROM it WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY pos)) c WHERE label = 'caption' AND kind IN ('table', 'picture')),
 nt AS (SELECT doc_id, page_no, cluster_id, label, last_value(CASE WHEN label <> 'footnote' THEN cluster_id END IGNORE NULLS) OVER (PARTITION BY doc_id, page_no ORDER BY pos) AS host FROM it),
 fn AS (SELECT n.doc_id, n.page_no, n.host AS target, n.cluster_id AS own FROM nt n JOIN it h ON h.doc_id = n.doc_id AND h.page_no = n.page_no AND h.cluster_id = n.host WHERE n.label = 'footnote' AND h.label IN ('table', 'picture')),
 mg AS (SELECT doc_id, page_no, cluster_id AS target, np, second AS own, nt AS more FROM {_PAIRS.format(items="it")}),
 sk AS (SELECT doc_id, page_no, own FROM cap UNION SELECT doc_id, page_no, own FROM fn UNION SELECT doc_id, np, own FROM mg),
 fl AS (SELECT i.*, row_number() OVER (PARTITION BY doc_id ORDER BY page_no, pos) AS place FROM it i WHERE NOT EXISTS (SELECT 1 FROM sk WHERE sk.doc_id = i.doc_id AND sk.page_no = i.page_no AND sk.own = i.cluster_id)),
 ls AS (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY place) AS list_id FROM (SELECT *, CASE WHEN label = 'list_item' AND coalesce(lag(label) OVER (PARTITION BY doc_id ORDER BY place), '') <> 'list_item' THEN 1 ELSE 0 END AS st FROM fl WHERE label NOT IN ('table', 'picture', 'code')) x),
 ow AS (SELECT f.*, CASE WHEN f.label = 'list_item' THEN l.list_id END AS list_id, m.more FROM fl f LEFT JOIN ls l ON l.doc_id = f.doc_id AND l.place = f.place LEFT JOIN mg m ON m.doc_id = f.doc_id AND m.page_no = f.page_no AND m.target = f.cluster_id),
 bl AS (SELECT doc_id, page_no, target, own, 1 AS turn FROM cap UNION ALL SELECT doc_id, page_no, target, own, 2 FROM fn),
 nd AS (SELECT doc_id, place, 0 AS turn, 0 AS k, list_id, NULL AS host, label, page_no, text || coalesce(' ' || more, '') AS text, '0-' || CAST(length(text) AS VARCHAR) || coalesce(',' || CAST(length(text) + 1 AS VARCHAR) || '-' || CAST(length(text) + 1 + length(more) AS VARCHAR), '') AS spans FROM ow
  UNION ALL SELECT doc_id, min(place), -1, 0, list_id, NULL, 'list', min(page_no), '', '' FROM ow WHERE list_id IS NOT NULL GROUP BY doc_id, list_id
  UNION ALL SELECT b.doc_id, f.place, b.turn, i.pos, NULL, f.place, i.label, b.page_no, i.text, '0-' || CAST(length(i.text) AS VARCHAR) FROM bl b JOIN it i ON i.doc_id = b.doc_id AND i.page_no = b.page_no AND i.cluster_id = b.own JOIN fl f ON f.doc_id = b.doc_id AND f.page_no = b.page_no AND f.cluster_id = b.target),
 kd AS (SELECT *, CASE WHEN label = 'list' THEN 'groups' WHEN label = 'table' THEN 'tables' WHEN label = 'picture' THEN 'pictures' ELSE 'texts' END AS kind FROM nd),
 rf AS (SELECT *, '#/' || kind || '/' || CAST(row_number() OVER (PARTITION BY doc_id, kind ORDER BY place, turn, k) - 1 AS VARCHAR) AS ref FROM kd),
 pr AS (SELECT r.*, coalesce(h.ref, CASE WHEN r.turn = 0 THEN g.ref END, '#/body') AS parent_ref FROM rf r LEFT JOIN rf h ON h.doc_id = r.doc_id AND h.turn = 0 AND h.place = r.host LEFT JOIN rf g ON g.doc_id = r.doc_id AND g.turn = -1 AND g.list_id = r.list_id)
 SELECT doc_id, ref, parent_ref, CAST(row_number() OVER (PARTITION BY doc_id, parent_ref ORDER BY place, turn, k) - 1 AS BIGINT) AS child_ix, label, 'body' AS layer, page_no + 1 AS page_no, text, spans FROM pr"""
_CHUNKS = f"""WITH RECURSIVE {_parts("w.text")}, hd AS (SELECT doc_id, pos, CASE WHEN label = 'title' THEN 0 ELSE level END AS lv, text FROM walk WHERE label IN ('title', 'section_header')),
 ch AS (SELECT doc_id, coalesce(list_id, -1 - pos) AS own, min(pos) AS pos, string_agg(part, chr(10) ORDER BY pos) AS text, string_agg(CAST(node_id AS VARCHAR), ',' ORDER BY pos) AS nodes FROM parts WHERE label NOT IN ('title', 'section_header') GROUP BY 1, 2),
 hs AS (SELECT c.doc_id, c.pos, string_agg(h.text, ' > ' ORDER BY h.lv) AS headings FROM ch c JOIN hd h ON h.doc_id = c.doc_id AND h.pos < c.pos WHERE NOT EXISTS (SELECT 1 FROM hd x WHERE x.doc_id = c.doc_id AND x.pos > h.pos AND x.pos < c.pos AND x.lv <= h.lv) GROUP BY 1, 2)
 SELECT c.doc_id, CAST(row_number() OVER (PARTITION BY c.doc_id ORDER BY c.pos) - 1 AS BIGINT) AS chunk_id, coalesce(h.headings, '') AS headings, c.text, c.nodes FROM ch c LEFT JOIN hs h ON h.doc_id = c.doc_id AND h.pos = c.pos"""

#: Every ninth node hangs on a node that is missing, every eleventh on its own child.
_BAD_PARENT = "CASE WHEN (doc_id + node_id) % 9 = 4 THEN node_id + 1000 WHEN (doc_id + node_id) % 11 = 5 AND node_id > 0 THEN 3 * node_id + 1 ELSE parent_id END"

SQL = {
    "doc_tree_build": f"WITH {_BUILD}",
    "doc_append_nodes": f"""WITH l AS (SELECT doc_id, max(node_id) AS m FROM d_tree GROUP BY 1), u AS (SELECT doc_id, node_id, parent_id, child_ix, label, text, 0 AS turn FROM d_tree UNION ALL SELECT t.doc_id, m + 1 + node_id, 0, node_id + 1, 'text', 'new ' || text, 1 FROM d_tree t JOIN l ON l.doc_id = t.doc_id WHERE node_id < 2)
 SELECT doc_id, node_id, parent_id, {_RANK.format("turn, child_ix, node_id")}, label, text FROM u""",
    "doc_insert_nodes": f"""WITH l AS (SELECT doc_id, max(node_id) AS m FROM d_tree GROUP BY 1), u AS (SELECT doc_id, node_id, parent_id, child_ix, label, text, 0 AS turn FROM d_tree UNION ALL SELECT t.doc_id, m + node_id, parent_id, child_ix, 'text', 'new ' || text, CASE node_id WHEN 1 THEN -1 ELSE 1 END FROM d_tree t JOIN l ON l.doc_id = t.doc_id WHERE node_id IN (1, 2))
 SELECT doc_id, node_id, parent_id, {_RANK.format("child_ix, turn, node_id")}, label, text FROM u""",
    "doc_concat": f"""WITH l AS (SELECT doc_id, max(node_id) + 1 AS m FROM d_tree GROUP BY 1), u AS (SELECT doc_id, node_id, parent_id, child_ix, label, 0 AS turn FROM d_tree UNION ALL SELECT t.doc_id - 1, node_id + coalesce(m, 0), parent_id + coalesce(m, 0), child_ix, label, 1 FROM d_tree t LEFT JOIN l ON l.doc_id = t.doc_id - 1)
 SELECT doc_id, node_id, parent_id, {_RANK.format("turn, child_ix, node_id")}, label FROM u""",
    "doc_extract_range": f"WITH RECURSIVE {_WALK}, k AS (SELECT *, pos - 1 AS new_id FROM walk WHERE pos BETWEEN 1 AND 4) SELECT k.doc_id, k.node_id, k.new_id, p.new_id AS new_parent FROM k LEFT JOIN k p ON p.doc_id = k.doc_id AND p.node_id = k.parent_id",
    "doc_delete_range": f"""WITH RECURSIVE {_WALK}, x AS (SELECT doc_id, node_id, unnest(path) AS above FROM walk), g AS (SELECT DISTINCT x.doc_id, x.node_id FROM x JOIN walk a ON a.doc_id = x.doc_id AND a.node_id = x.above WHERE a.pos BETWEEN 2 AND 3),
 k AS (SELECT w.*, CAST(row_number() OVER (PARTITION BY w.doc_id ORDER BY pos) - 1 AS BIGINT) AS new_id FROM walk w ANTI JOIN g ON g.doc_id = w.doc_id AND g.node_id = w.node_id)
 SELECT k.doc_id, k.node_id, k.new_id, p.new_id AS new_parent FROM k LEFT JOIN k p ON p.doc_id = k.doc_id AND p.node_id = k.parent_id""",
    "doc_unreached": f"""WITH RECURSIVE bad AS (SELECT doc_id, node_id, {_BAD_PARENT} AS parent_id FROM d_tree), up AS (SELECT doc_id, node_id, parent_id, 0 AS n FROM bad UNION ALL SELECT u.doc_id, u.node_id, b.parent_id, n + 1 FROM up u JOIN bad b ON b.doc_id = u.doc_id AND b.node_id = u.parent_id WHERE n < 9),
 ok AS (SELECT DISTINCT doc_id, node_id FROM up WHERE parent_id IS NULL) SELECT b.doc_id, b.node_id, CASE WHEN EXISTS (SELECT 1 FROM bad p WHERE p.doc_id = b.doc_id AND p.node_id = b.parent_id) THEN 'cut off' ELSE 'orphan' END AS reason
 FROM bad b ANTI JOIN ok ON ok.doc_id = b.doc_id AND ok.node_id = b.node_id""",
    "doc_selected_items": f"WITH RECURSIVE {_WALK} SELECT doc_id, node_id, pos FROM walk WHERE layer = 'body' AND label IN ('text', 'list_item', 'code', 'title') AND page_no IN (1, 2) AND pos >= 1 AND pos < 5",
    "doc_markdown": f"WITH RECURSIVE {_parts(_ESCAPED)}, g AS ({_GAPS.format(k='doc_id')}) SELECT doc_id, {_TEXT} FROM g GROUP BY 1",
    "doc_plain_text": f"WITH RECURSIVE {_WALK} SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY pos) AS text FROM walk WHERE text <> '' AND label NOT IN ('list', 'ordered_list', 'picture') GROUP BY 1",
    "doc_outline": f"WITH RECURSIVE {_WALK} SELECT doc_id, string_agg(repeat('  ', depth) || label || ': ' || text, chr(10) ORDER BY pos) AS text FROM walk GROUP BY 1",
    "doc_html": f"WITH RECURSIVE {_wrap(f"'<' || {_HTML} || '>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')", f"'</' || {_HTML} || '>'")} SELECT * FROM done",
    "doc_doctags": f"WITH RECURSIVE {_TAGGED} SELECT * FROM done",
    "doc_json": f"""WITH RECURSIVE {_WALK} SELECT doc_id, '{{"doc_id":' || CAST(doc_id AS VARCHAR) || ',"nodes":[' || string_agg('{{"node_id":' || CAST(node_id AS VARCHAR) || coalesce(',"parent_id":' || CAST(parent_id AS VARCHAR), '') || ',"label":"' || label || '","layer":"' || layer || '"'
 || CASE WHEN label = 'section_header' THEN ',"level":' || CAST(level AS VARCHAR) ELSE '' END || ',"text":"' || text || '"}}', ',' ORDER BY pos) || ']}}' AS json FROM walk GROUP BY 1""",
    "doc_json_read": f"""WITH RECURSIVE {_WALK} SELECT doc_id, pos, node_id, parent_id, label, layer, CASE WHEN label = 'section_header' THEN level END AS level, text, TRUE AS valid FROM walk WHERE doc_id % 10 <> 0
 UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, FALSE FROM (SELECT DISTINCT doc_id FROM d_tree WHERE doc_id % 10 = 0) b""",
    "doctags_read": f"""WITH RECURSIVE {_WALK}, deep_walk AS (SELECT walk.*, CAST(len(path) - 1 AS BIGINT) AS deep FROM walk)
 SELECT a.doc_id, a.pos, p.pos AS parent_pos, a.deep AS depth, {_TAG.replace("label", "a.label").replace("level", "a.level").replace("section_header_a.level_", "section_header_level_")} AS tag, '<loc_' || CAST(a.node_id * 7 % 500 AS VARCHAR) || '><loc_' || CAST(a.doc_id % 500 AS VARCHAR) || '>' AS location, a.text
 FROM deep_walk a LEFT JOIN walk p ON p.doc_id = a.doc_id AND p.node_id = a.parent_id""",
    "chunk_hierarchical": _CHUNKS,
    "chunk_by_page": f"WITH RECURSIVE {_parts(_ESCAPED)}, g AS ({_GAPS.format(k='doc_id, page_no')}) SELECT doc_id, page_no, {_TEXT} FROM g GROUP BY 1, 2",
}

QUERIES = (
    doc_tree_build, doc_append_nodes, doc_insert_nodes, doc_concat, doc_extract_range, doc_delete_range, doc_selected_items, doc_markdown, doc_plain_text, doc_outline, doc_html, doc_doctags,
    doc_json, doc_json_read, doctags_read, doc_unreached, doctags_vocabulary, chunk_hierarchical, chunk_by_page, chunk_hybrid_tree,
)
