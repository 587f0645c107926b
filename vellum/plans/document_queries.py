"""Queries over page elements, reading order, trees, chunks, evaluation and timings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import text as texts
from vellum.operators import chunking, documents, evaluation, layout
from vellum.plans.fixtures import base, view
from vellum.plans.layout_queries import _ASSIGN


def _cluster_text(spark: SparkSession, d: str) -> DataFrame:
    cells = view(spark, d, "d_cells")
    found = layout.assign_cells(cells, view(spark, d, "d_clusters")).join(cells.select("page_id", "cell_ix", "text"), ["page_id", "cell_ix"])
    lines = F.transform(F.array_sort(F.collect_list(F.struct("cell_ix", "text"))), lambda c: c.text)
    return found.groupBy("page_id", "cluster_id").agg(lines.alias("lines")).select("page_id", "cluster_id", texts.joined_lines(F.col("lines")).alias("text"))


def element_text_sanitize(spark: SparkSession, d: str) -> DataFrame:
    return _cluster_text(spark, d)


def page_elements(spark: SparkSession, d: str) -> DataFrame:
    found = documents.elements(view(spark, d, "d_clusters"), _cluster_text(spark, d))
    return found.withColumn("markdown", documents.markdown_line())


def _placed(spark: SparkSession, d: str) -> DataFrame:
    """Elements in the order of their number, which stands for a reading order that SQL can express."""
    words = F.when(F.col("cluster_id") % 3 == 0, "it goes on and").when(F.col("cluster_id") % 3 == 1, "then goes on and").otherwise("on it went.")
    return view(spark, d, "d_elements").withColumn("pos", F.col("cluster_id")).withColumn("text", words)


def reading_order_edges(spark: SparkSession, d: str) -> DataFrame:
    return documents.above(view(spark, d, "d_elements"))


def reading_order_full(spark: SparkSession, d: str) -> DataFrame:
    return documents.reading_order(view(spark, d, "d_elements"))


def caption_links(spark: SparkSession, d: str) -> DataFrame:
    return documents.caption_links(_placed(spark, d))


def footnote_links(spark: SparkSession, d: str) -> DataFrame:
    return documents.footnote_links(_placed(spark, d))


def text_merge_candidates(spark: SparkSession, d: str) -> DataFrame:
    items = _placed(spark, d).withColumn("label", F.when((F.col("cluster_id") % 2 == 0) | (F.col("doc_id") % 3 == 0), "text").otherwise(F.col("label")))
    return documents.merge_candidates(items)


def list_groups(spark: SparkSession, d: str) -> DataFrame:
    items = _placed(spark, d).withColumn("label", F.when(F.col("cluster_id") % 3 == 0, "list_item").otherwise(F.col("label")))
    return documents.list_groups(items)


def doc_tree_traverse(spark: SparkSession, d: str) -> DataFrame:
    return documents.traverse(view(spark, d, "d_nodes"))


def doc_tree_layer_filter(spark: SparkSession, d: str) -> DataFrame:
    return documents.traverse(view(spark, d, "d_nodes"), F.col("content_layer") == "body")


def doc_subtree_delete_renumber(spark: SparkSession, d: str) -> DataFrame:
    return documents.delete_subtrees(view(spark, d, "d_nodes"), (F.col("level") == 3) & F.col("parent_id").isNotNull())


def doc_elements_by_page(spark: SparkSession, d: str) -> DataFrame:
    refs = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "cluster_id", "label"))), lambda e: F.concat(e.label, F.lit(":"), e.cluster_id.cast("string"))), ",")
    return view(spark, d, "d_elements").withColumn("t", -F.col("t")).groupBy("doc_id", "page_no").agg(F.count("*").alias("n"), refs.alias("elements"))


def doc_graph_links_validate(spark: SparkSession, d: str) -> DataFrame:
    nodes = view(spark, d, "d_nodes")
    links = nodes.where("parent_id is not null").select("doc_id", "node_id", (F.col("parent_id") + F.when(F.col("node_id") % 7 == 0, 1000).otherwise(0)).alias("target"))
    return links.join(nodes.select("doc_id", F.col("node_id").alias("target")), ["doc_id", "target"], "left_anti").select("doc_id", "node_id", "target")


def chunk_lines(spark: SparkSession, d: str) -> DataFrame:
    return chunking.lines_of(base(spark, d, "documents")).select("doc_id", "pos", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


def chunk_heading_context(spark: SparkSession, d: str) -> DataFrame:
    found = chunking.heading_context(view(spark, d, "d_nodes"))
    return found.select("doc_id", "node_id", F.array_join("headings", " > ").alias("headings"))


def chunk_contextualize(spark: SparkSession, d: str) -> DataFrame:
    nodes = view(spark, d, "d_nodes")
    found = chunking.heading_context(nodes).join(nodes.where("label = 'text'"), ["doc_id", "node_id"])
    return found.select("doc_id", "node_id", chunking.contextualized(F.col("headings"), F.col("text")).alias("text"))


def chunk_hybrid(spark: SparkSession, d: str) -> DataFrame:
    lines = chunking.lines_of(base(spark, d, "documents")).withColumn("heading", F.lit(""))
    return chunking.greedy_chunks(lines, 128).select("doc_id", "chunk_id", "n_tokens", F.md5("text").alias("text_md5"))


def chunk_pages(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("["), "role", F.lit("] "), "text")
    turns = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x.line), "\n")
    return base(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_turns"), turns.alias("text"))


def _changed(spark: SparkSession, d: str) -> DataFrame:
    clusters = view(spark, d, "d_clusters").where("(page_id + cluster_id) % 17 <> 0")
    label = F.when((F.col("page_id") + F.col("cluster_id")) % 5 == 0, "text").otherwise(F.col("label"))
    return clusters.withColumn("label", label).withColumn("l", F.col("l") + F.col("cluster_id") % 3)


def eval_label_f1(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.label_f1(view(spark, d, "d_clusters"), _changed(spark, d), ["page_id"])


def eval_golden_diff(spark: SparkSession, d: str) -> DataFrame:
    orders = base(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    actual = orders.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_custkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    more = orders.where("o_orderkey % 13 = 0").withColumn("o_orderkey", -F.col("o_orderkey"))
    return evaluation.keyed_diff(orders, actual.unionByName(more), ["o_orderkey"], ["o_custkey", "o_orderstatus"])


def eval_greedy_iou(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.greedy_iou(view(spark, d, "d_clusters"), _changed(spark, d))


def profile_stats(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return base(spark, d, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("std"), F.round(F.percentile(v, 0.5), 6).alias("p50"), F.round(F.percentile(v, 0.95), 6).alias("p95"), F.max(v).alias("most")
    )


def stage_latency(spark: SparkSession, d: str) -> DataFrame:
    at = lambda kind, f: f(F.when(F.col("event_type") == kind, F.unix_micros("ts")))
    spans = base(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).groupBy("user_id").agg(at("view", F.min).alias("first_view"), at("purchase", F.max).alias("last_purchase"), F.count("*").alias("n"))
    return spans.select("user_id", "n", (F.col("last_purchase") - F.col("first_view")).alias("micros"))


def throughput_topk(spark: SparkSession, d: str) -> DataFrame:
    per_user = base(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return per_user.orderBy(F.desc("n"), F.desc("total"), "user_id").limit(25)


def page_fanout_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Page ranges of documents, from 1 page a task to 6 in steps of 40 pages; pages are counted per customer."""
    pages = view(spark, d, "d_pages").groupBy("doc_id").agg((F.count("*") * 7).alias("total"))
    size = F.least(F.lit(6), F.floor((F.col("total") - 1) / 40) + 1).cast("bigint")
    starts = pages.withColumn("size", size).withColumn("first", F.explode(F.expr("sequence(0L, total - 1, size)")))
    return starts.select("doc_id", "total", "first", F.least(F.col("first") + F.col("size"), F.col("total")).alias("stop"))


def completeness_barrier_batch(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose lines are all there, lines counted once, and for the others how many are missing."""
    seen = base(spark, d, "lineitem").where("l_partkey % 50 <> 0").select("l_orderkey", "l_linenumber").distinct()
    want = base(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_linenumber").cast("int").alias("total"))
    due = want.select("l_orderkey", "total", F.explode(F.sequence(F.lit(1), F.col("total"))).alias("l_linenumber"))
    missing = due.join(seen.withColumn("l_linenumber", F.col("l_linenumber").cast("int")), ["l_orderkey", "l_linenumber"], "left_anti").groupBy("l_orderkey").agg(F.count("*").alias("missing"))
    return want.join(missing, "l_orderkey", "left").select("l_orderkey", F.col("total").cast("bigint").alias("total"), F.coalesce("missing", F.lit(0)).cast("bigint").alias("missing"))


def snapshot_hash(spark: SparkSession, d: str) -> DataFrame:
    body = F.concat(F.lit('{"doc_id":'), F.col("doc_id").cast("string"), F.lit(',"lang":"'), "lang", F.lit('","n_chars":'), F.col("n_chars").cast("string"), F.lit(',"source":"'), "source", F.lit('"}'))
    return base(spark, d, "documents").select("doc_id", F.substring(F.sha2(body, 256), 1, 12).alias("snapshot"))


_W = "CASE cluster_id % 3 WHEN 0 THEN 'it goes on and' WHEN 1 THEN 'then goes on and' ELSE 'on it went.' END"
#: Pairs of texts that go on, every other one of a chain; {own} are the columns of a pair.
_PAIRS = """(SELECT *, row_number() OVER (PARTITION BY doc_id, chain ORDER BY page_no, cluster_id) AS turn FROM (
  SELECT *, sum(CASE WHEN pair THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY page_no, cluster_id) AS chain FROM (
   SELECT *, coalesce(label = 'text' AND nl = 'text' AND regexp_matches(text, '^.+([a-z,\\-])(\\s*)$') AND regexp_matches(nt, '^(\\s*[a-z])(.+)$'), FALSE) AS pair FROM (
    SELECT *, lead(page_no) OVER w AS np, lead(cluster_id) OVER w AS second, lead(label) OVER w AS nl, lead(text) OVER w AS nt FROM {items} WINDOW w AS (PARTITION BY doc_id ORDER BY page_no, cluster_id)) a) b) c WHERE pair) d WHERE turn % 2 = 1"""
_HEADS = "heads AS (SELECT n.doc_id, n.node_id, n.label, n.text, " + ", ".join(
    f"max(CASE WHEN h.level = {k} THEN h.node_id END) AS p{k}" for k in (1, 2, 3)
) + " FROM d_nodes n LEFT JOIN d_nodes h ON h.doc_id = n.doc_id AND h.node_id < n.node_id AND h.label = 'section_header' GROUP BY 1, 2, 3, 4)"
_CONTEXT = f"""{_HEADS}, ctx AS (SELECT x.doc_id, x.node_id, x.label, x.text, a.text AS t1, CASE WHEN coalesce(p1, -1) < p2 THEN b.text END AS t2,
 CASE WHEN coalesce(p1, -1) < p3 AND coalesce(p2, -1) < p3 THEN c.text END AS t3 FROM heads x LEFT JOIN d_nodes a ON a.doc_id = x.doc_id AND a.node_id = p1
 LEFT JOIN d_nodes b ON b.doc_id = x.doc_id AND b.node_id = p2 LEFT JOIN d_nodes c ON c.doc_id = x.doc_id AND c.node_id = p3)"""


def _tree_sql(where: str, select: str) -> str:
    return f"""WITH RECURSIVE keep AS (SELECT * FROM d_nodes WHERE {where}), walk(doc_id, node_id, path) AS (SELECT doc_id, node_id, [node_id] FROM keep WHERE parent_id IS NULL
 UNION ALL SELECT k.doc_id, k.node_id, list_append(w.path, k.node_id) FROM walk w JOIN keep k ON k.doc_id = w.doc_id AND k.parent_id = w.node_id),
 placed AS (SELECT doc_id, node_id, CAST(len(path) - 1 AS BIGINT) AS depth, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY path) - 1 AS BIGINT) AS pos FROM walk) {select}"""


SQL = {
    "element_text_sanitize": f"""WITH {_ASSIGN}, parts AS (SELECT a.page_id, a.cluster_id, c.cell_ix, c.text, lead(c.text) OVER (PARTITION BY a.page_id, a.cluster_id ORDER BY c.cell_ix) AS nxt
 FROM assign a JOIN d_cells c ON c.page_id = a.page_id AND c.cell_ix = a.cell_ix)
 SELECT page_id, cluster_id, trim(string_agg(CASE WHEN nxt IS NULL THEN text WHEN ends_with(text, '-') THEN substr(text, 1, length(text) - 1) ELSE text || ' ' END, '' ORDER BY cell_ix)) AS text FROM parts GROUP BY 1, 2""",
    "page_elements": f"""WITH {_ASSIGN}, parts AS (SELECT a.page_id, a.cluster_id, c.cell_ix, c.text, lead(c.text) OVER (PARTITION BY a.page_id, a.cluster_id ORDER BY c.cell_ix) AS nxt
 FROM assign a JOIN d_cells c ON c.page_id = a.page_id AND c.cell_ix = a.cell_ix), joined AS (SELECT page_id, cluster_id,
 trim(string_agg(CASE WHEN nxt IS NULL THEN text WHEN ends_with(text, '-') THEN substr(text, 1, length(text) - 1) ELSE text || ' ' END, '' ORDER BY cell_ix)) AS text FROM parts GROUP BY 1, 2),
 e AS (SELECT k.page_id, k.cluster_id, CASE k.label WHEN 'table' THEN 'table' WHEN 'picture' THEN 'figure' ELSE 'text' END AS kind, 'body' AS part,
 CASE k.label WHEN 'title' THEN 'section_header' ELSE k.label END AS label, coalesce(j.text, '') AS text FROM d_clusters k LEFT JOIN joined j ON j.page_id = k.page_id AND j.cluster_id = k.cluster_id)
 SELECT *, CASE label WHEN 'section_header' THEN '## ' || text WHEN 'list_item' THEN '- ' || text WHEN 'picture' THEN '<!-- image -->' ELSE text END AS markdown FROM e""",
    "reading_order_edges": """SELECT i.doc_id, i.page_no, i.cluster_id AS upper, j.cluster_id AS lower FROM d_elements i JOIN d_elements j ON i.doc_id = j.doc_id AND i.page_no = j.page_no AND i.cluster_id <> j.cluster_id
 AND i.b + 0.001 > j.t AND i.r > j.l AND j.r > i.l WHERE NOT EXISTS (SELECT 1 FROM d_elements w WHERE w.doc_id = i.doc_id AND w.page_no = i.page_no AND w.cluster_id NOT IN (i.cluster_id, j.cluster_id)
 AND ((w.r > i.l AND i.r > w.l) OR (w.r > j.l AND j.r > w.l)) AND i.b + 0.001 > w.t AND w.b + 0.001 > j.t)""",
    "footnote_links": """WITH o AS (SELECT *, last_value(CASE WHEN label <> 'footnote' THEN cluster_id END IGNORE NULLS) OVER (PARTITION BY doc_id, page_no ORDER BY cluster_id) AS host FROM d_elements)
 SELECT o.doc_id, o.page_no, o.host AS target, o.cluster_id AS footnote FROM o JOIN d_elements h ON h.doc_id = o.doc_id AND h.page_no = o.page_no AND h.cluster_id = o.host WHERE o.label = 'footnote' AND h.label IN ('table', 'picture')""",
    "text_merge_candidates": f"""WITH e AS (SELECT doc_id, page_no, cluster_id, CASE WHEN cluster_id % 2 = 0 OR doc_id % 3 = 0 THEN 'text' ELSE label END AS label, {_W} AS text FROM d_elements)
 SELECT doc_id, page_no, cluster_id AS first, second FROM {_PAIRS.format(items="e")}""",
    "list_groups": """WITH e AS (SELECT doc_id, page_no, cluster_id, CASE WHEN cluster_id % 3 = 0 THEN 'list_item' ELSE label END AS label FROM d_elements), f AS (SELECT * FROM e WHERE label NOT IN ('table', 'picture', 'code')),
 s AS (SELECT *, CASE WHEN label = 'list_item' AND coalesce(lag(label) OVER (PARTITION BY doc_id ORDER BY page_no, cluster_id), '') <> 'list_item' THEN 1 ELSE 0 END AS st FROM f)
 SELECT doc_id, cluster_id, CAST(n AS BIGINT) AS list_id FROM (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY page_no, cluster_id) AS n FROM s) q WHERE label = 'list_item'""",
    "doc_tree_traverse": _tree_sql("TRUE", "SELECT doc_id, node_id, depth, pos FROM placed"),
    "doc_tree_layer_filter": _tree_sql("content_layer = 'body'", "SELECT doc_id, node_id, depth, pos FROM placed"),
    "doc_subtree_delete_renumber": _tree_sql("NOT (level = 3 AND parent_id IS NOT NULL)", """SELECT p.doc_id, p.node_id, p.pos AS new_id, q.pos AS new_parent FROM placed p JOIN d_nodes n ON n.doc_id = p.doc_id AND n.node_id = p.node_id
 LEFT JOIN placed q ON q.doc_id = p.doc_id AND q.node_id = n.parent_id"""),
    "doc_elements_by_page": "SELECT doc_id, page_no, count(*) AS n, string_agg(label || ':' || CAST(cluster_id AS VARCHAR), ',' ORDER BY -t, cluster_id) AS elements FROM d_elements GROUP BY 1, 2",
    "doc_graph_links_validate": """SELECT l.doc_id, l.node_id, l.target FROM (SELECT doc_id, node_id, parent_id + CASE WHEN node_id % 7 = 0 THEN 1000 ELSE 0 END AS target FROM d_nodes WHERE parent_id IS NOT NULL) l
 WHERE NOT EXISTS (SELECT 1 FROM d_nodes n WHERE n.doc_id = l.doc_id AND n.node_id = l.target)""",
    "chunk_lines": """SELECT doc_id, CAST(pos AS BIGINT) AS pos, CAST(length(line) AS BIGINT) AS n_chars, md5(line) AS text_md5 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents) l WHERE trim(line) <> ''""",
    "chunk_heading_context": f"WITH {_CONTEXT} SELECT doc_id, node_id, concat_ws(' > ', t1, t2, t3) AS headings FROM ctx",
    "chunk_contextualize": f"WITH {_CONTEXT} SELECT doc_id, node_id, concat_ws(chr(10), t1, t2, t3, text) AS text FROM ctx WHERE label = 'text'",
    "chunk_pages": "SELECT conv_id, count(*) AS n_turns, string_agg('[' || role || '] ' || text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1",
    "eval_label_f1": """WITH a AS (SELECT page_id, label, count(*) AS x FROM d_clusters GROUP BY 1, 2), b AS (SELECT page_id, CASE WHEN (page_id + cluster_id) % 5 = 0 THEN 'text' ELSE label END AS label, count(*) AS y
 FROM d_clusters WHERE (page_id + cluster_id) % 17 <> 0 GROUP BY 1, 2), j AS (SELECT coalesce(a.page_id, b.page_id) AS page_id, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM a FULL JOIN b ON a.page_id = b.page_id AND a.label = b.label)
 SELECT page_id, round(2 * sum(least(x, y)) / (sum(x) + sum(y)), 6) AS f1 FROM j GROUP BY 1""",
    "eval_golden_diff": """WITH act AS (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 11 <> 0
 UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 13 = 0)
 SELECT coalesce(o.o_orderkey, a.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'missing' WHEN o.o_orderkey IS NULL THEN 'new' WHEN o.o_custkey = a.o_custkey AND o.o_orderstatus = a.o_orderstatus THEN 'same' ELSE 'changed' END AS status
 FROM orders o FULL JOIN act a ON a.o_orderkey = o.o_orderkey""",
    "profile_stats": "SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, max(value) AS most FROM events GROUP BY 1",
    "stage_latency": """SELECT user_id, count(*) AS n, max(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) - min(CASE WHEN event_type = 'view' THEN epoch_us(ts) END) AS micros FROM events GROUP BY 1""",
    "throughput_topk": "SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1 ORDER BY n DESC, total DESC, user_id LIMIT 25",
    "page_fanout_ranges": """WITH p AS (SELECT doc_id, count(*) * 7 AS total FROM d_pages GROUP BY 1), s AS (SELECT doc_id, total, least(6, CAST(floor((total - 1) / 40.0) AS BIGINT) + 1) AS size FROM p)
 SELECT doc_id, total, first, least(first + size, total) AS stop FROM (SELECT doc_id, total, size, unnest(range(0, total, size)) AS first FROM s) r""",
    "completeness_barrier_batch": """WITH want AS (SELECT l_orderkey, max(l_linenumber) AS total FROM lineitem GROUP BY 1), due AS (SELECT l_orderkey, total, unnest(range(1, total + 1)) AS ln FROM want)
 SELECT d.l_orderkey, CAST(max(total) AS BIGINT) AS total, CAST(sum(CASE WHEN s.l_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM due d
 LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 50 <> 0) s ON s.l_orderkey = d.l_orderkey AND s.l_linenumber = d.ln GROUP BY 1""",
    "snapshot_hash": """SELECT doc_id, substr(sha256('{"doc_id":' || CAST(doc_id AS VARCHAR) || ',"lang":"' || lang || '","n_chars":' || CAST(n_chars AS VARCHAR) || ',"source":"' || source || '"}'), 1, 12) AS snapshot FROM documents""",
}

QUERIES = (
    element_text_sanitize, page_elements, reading_order_edges, reading_order_full, caption_links, footnote_links, text_merge_candidates, list_groups, doc_tree_traverse,
    doc_tree_layer_filter, doc_subtree_delete_renumber, doc_elements_by_page, doc_graph_links_validate, chunk_lines, chunk_heading_context, chunk_contextualize, chunk_hybrid,
    chunk_pages, eval_label_f1, eval_golden_diff, eval_greedy_iou, profile_stats, stage_latency, throughput_topk, page_fanout_ranges, completeness_barrier_batch, snapshot_hash,
)
