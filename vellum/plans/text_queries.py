"""Queries over texts, web pages, line formats and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import text as texts
from vellum.operators.evaluation import grade
from vellum.plans.fixtures import base, view
from vellum.sources import detect, html, lines
from vellum.streaming.barrier import complete_jobs


def text_quality_score(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "d_texts").select("doc_id", F.round(texts.quality(F.col("text")), 6).alias("score"))


def page_parse_score_p10(spark: SparkSession, d: str) -> DataFrame:
    scored = view(spark, d, "d_texts").select("source", texts.quality(F.col("text")).alias("score"))
    return scored.groupBy("source").agg(F.round(F.percentile("score", 0.1), 6).alias("p10"), F.round(F.avg("score"), 6).alias("mean"))


def confidence_report(spark: SparkSession, d: str) -> DataFrame:
    """Per document: the mean and the 5 % quantile of what is known of four scores, and their grades."""
    scored = view(spark, d, "d_texts").select("doc_id", texts.quality(F.col("text")).alias("parse"))
    labels = base(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("layout"), (1 - F.col("toxic")).cast("double").alias("ocr"))
    long = scored.join(labels, "doc_id", "left").select("doc_id", F.explode(F.array("parse", "layout", F.lit(None).cast("double"), "ocr")).alias("score"))
    found = long.groupBy("doc_id").agg(F.round(F.avg("score"), 6).alias("mean_score"), F.round(F.percentile("score", 0.05), 6).alias("low_score"))
    return found.select("doc_id", "mean_score", "low_score", grade(F.col("mean_score")).alias("mean_grade"), grade(F.col("low_score")).alias("low_grade"))


def text_unicode_clean(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "d_texts").select("doc_id", F.md5(texts.clean_web(F.col("text"))).alias("text_md5"))


def text_ligatures(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "d_texts").select("doc_id", F.md5(texts.clean_page(F.col("text"))).alias("text_md5"))


def text_md_escape(spark: SparkSession, d: str) -> DataFrame:
    escaped = texts.markdown_escape(texts.shortened_underscores(F.col("text")))
    return view(spark, d, "d_texts").select("doc_id", F.md5(escaped).alias("text_md5"))


def text_direction(spark: SparkSession, d: str) -> DataFrame:
    some = F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("שלום "), "text")).otherwise(F.col("text"))
    return base(spark, d, "documents").select("doc_id", texts.direction(some).alias("direction"))


def html_titles(spark: SparkSession, d: str) -> DataFrame:
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return base(spark, d, "pages").select("page_id", F.trim(texts.clean_web(F.replace(title, F.lit("&amp;"), F.lit("&")))).alias("title"))


def html_headings_links_lists(spark: SparkSession, d: str) -> DataFrame:
    count = lambda p: F.size(F.regexp_extract_all("html", F.lit(p), F.lit(0))).cast("bigint")
    return base(spark, d, "pages").select("page_id", count(r"<h1[ >]").alias("n_h1"), count(r"<a [^>]*href=").alias("n_links"), count(r"<li[ >]").alias("n_items"), count(r"<p[ >]").alias("n_paragraphs"))


def html_links(spark: SparkSession, d: str) -> DataFrame:
    found = base(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))).alias("pos", "href"))
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


def html_tree(spark: SparkSession, d: str) -> DataFrame:
    return html.tree(base(spark, d, "pages"))


def html_to_markdown(spark: SparkSession, d: str) -> DataFrame:
    return html.to_markdown(html_tree(spark, d))


def format_detect(spark: SparkSession, d: str) -> DataFrame:
    pages = base(spark, d, "pages")
    head = F.when(F.col("page_id") % 4 == 0, F.lit("")).when(F.col("page_id") % 4 == 1, F.lit('{"a":1}')).otherwise(F.col("html"))
    return pages.select("page_id", detect.detect(F.col("url"), head).alias("format"))


def line_classifier_asciidoc(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d, lines.asciidoc)


def line_classifier_md(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d, lines.markdown)


def _classified(spark: SparkSession, d: str, kind) -> DataFrame:  # noqa: ANN001
    marked = base(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    prefix = F.create_map(*[F.lit(x) for kv in enumerate(["= ", "== ", "# ", "- ", "1. ", "|", "image::", "."]) for x in kv])[F.col("pos") % 11]
    line = F.concat(F.coalesce(prefix, F.lit("")), "line")
    return marked.select("doc_id", F.col("pos").cast("bigint").alias("pos"), kind(line).alias("kind"))


def csv_cells(spark: SparkSession, d: str) -> DataFrame:
    return lines.cells(view(spark, d, "d_csv"))


def completeness_barrier_stream(spark: SparkSession, d: str) -> DataFrame:
    """Jobs of 4 events each, as a file stream through the barrier; the result is read back from its sink."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = root or f"file:///tmp/spark-stream-{uuid.uuid4().hex}"
    source = f"{root}/events-{uuid.uuid4().hex}"
    base(spark, d, "events").selectExpr("CAST(floor(event_id / 4) AS BIGINT) AS job_id", "event_id % 4 AS page_no", "4L AS total", "event_type AS payload").write.parquet(source)
    pages = spark.readStream.schema("job_id bigint, page_no bigint, total bigint, payload string").option("maxFilesPerTrigger", 4).parquet(source)
    sink = f"{source}-out"
    query = complete_jobs(pages).writeStream.format("parquet").option("checkpointLocation", f"{source}-state").option("path", sink).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(sink)


def completeness_batch(spark: SparkSession, d: str) -> DataFrame:
    """What the barrier gives out, as one grouping of the same pages."""
    jobs = base(spark, d, "events").selectExpr("CAST(floor(event_id / 4) AS BIGINT) AS job_id", "event_id % 4 AS page_no", "event_type AS payload")
    payloads = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "payload"))), lambda p: p.payload), ",")
    return jobs.groupBy("job_id").agg(F.count("*").cast("int").alias("pages"), payloads.alias("payloads")).where("pages = 4").withColumn("status", F.lit("complete"))


def _replace_sql(column: str, table: dict[str, str]) -> str:
    for k, v in table.items():
        column = f"replace({column}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return column


_SCORE = r"""CASE WHEN contains(text, '�') OR regexp_matches(text, 'GLYPH<[0-9A-Fa-f]+>') OR regexp_matches(text, '(?:/G\d+){2,}') OR regexp_matches(text, '^(?:/\w+\s*){2,}') THEN 0.0
 ELSE greatest(0.0, 1.0 - CASE WHEN len(regexp_extract_all(text, '\b[A-Za-z](?:/[a-z]{1,3}\.[a-z]{1,3}){2,}\b')) >= 3 THEN CAST(len(regexp_extract_all(text, '\b[A-Za-z](?:/[a-z]{1,3}\.[a-z]{1,3}){2,}\b')) AS DOUBLE) * CAST(0.1 AS DOUBLE) ELSE 0.0 END) END"""
_GRADE = "CASE WHEN {0} < 0.5 THEN 'poor' WHEN {0} < 0.8 THEN 'fair' WHEN {0} < 0.9 THEN 'good' WHEN {0} >= 0.9 THEN 'excellent' ELSE 'unspecified' END"
_LINES = """SELECT doc_id, CAST(pos AS BIGINT) AS pos, coalesce(CASE pos % 11 WHEN 0 THEN '= ' WHEN 1 THEN '== ' WHEN 2 THEN '# ' WHEN 3 THEN '- ' WHEN 4 THEN '1. ' WHEN 5 THEN '|' WHEN 6 THEN 'image::' WHEN 7 THEN '.' END, '') || line AS line
 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents) l"""


def _case(rules: list[tuple[str, str]], other: str = "text") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{k}'" for c, k in rules) + f" ELSE '{other}' END"


_ASCIIDOC = _case([(f"regexp_matches(line, '{p}')", k) for p, k in ((r"^= ", "title"), (r"^==+\s+", "header"), (r"^\s*(\*|-|\d+\.|\w+\.) ", "list_item"), (r"^\|===", "table_edge"), (r"^\|", "table_row"), (r"^image::", "picture"), (r"^\.[^ .]", "caption"))] + [("trim(line) = ''", "blank")])
_MARKDOWN = _case([("regexp_matches(line, '^#{1,6} ')", "heading"), ("regexp_matches(line, '^(```|~~~)')", "fence"), (r"regexp_matches(line, '^\s*([-*+]|\d+[.)]) ')", "list_item"), (r"regexp_matches(line, '^\s*>')", "quote"),
                   (r"regexp_matches(line, '^\s*\|?[\s:|-]*-{3,}[\s:|-]*$') AND contains(line, '|')", "table_rule"), ("contains(line, '|')", "table_row"), ("trim(line) = ''", "blank")])

SQL = {
    "text_quality_score": f"SELECT doc_id, round({_SCORE}, 6) AS score FROM d_texts",
    "page_parse_score_p10": f"SELECT source, round(quantile_cont(s, 0.1), 6) AS p10, round(avg(s), 6) AS mean FROM (SELECT source, CAST({_SCORE} AS DOUBLE) AS s FROM d_texts) q GROUP BY 1",
    "confidence_report": f"""WITH p AS (SELECT doc_id, CAST({_SCORE} AS DOUBLE) AS score FROM d_texts UNION ALL SELECT doc_id, CAST(quality AS DOUBLE) FROM labels UNION ALL SELECT doc_id, CAST(1 - toxic AS DOUBLE) FROM labels),
 g AS (SELECT doc_id, round(avg(score), 6) AS mean_score, round(quantile_cont(score, 0.05), 6) AS low_score FROM p GROUP BY 1)
 SELECT doc_id, mean_score, low_score, {_GRADE.format('mean_score')} AS mean_grade, {_GRADE.format('low_score')} AS low_grade FROM g""",
    "text_unicode_clean": f"SELECT doc_id, md5({_replace_sql('text', texts.WEB)}) AS text_md5 FROM d_texts",
    "text_ligatures": f"SELECT doc_id, md5({_replace_sql('text', texts.NAMED_LIGATURES | texts.LIGATURES | texts.PAGE)}) AS text_md5 FROM d_texts",
    "text_md_escape": r"SELECT doc_id, md5(replace(replace(replace(replace(regexp_replace(text, '_{11,}', '__________', 'g'), '_', '\_'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS text_md5 FROM d_texts",
    "text_direction": "SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'right_to_left' ELSE 'left_to_right' END AS direction FROM documents",
    "html_titles": f"SELECT page_id, trim({_replace_sql('t', texts.WEB)}) AS title FROM (SELECT page_id, replace(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), '&amp;', '&') AS t FROM pages) p",
    "html_headings_links_lists": "SELECT page_id, CAST(len(regexp_extract_all(html, '<h1[ >]')) AS BIGINT) AS n_h1, CAST(len(regexp_extract_all(html, '<a [^>]*href=')) AS BIGINT) AS n_links, CAST(len(regexp_extract_all(html, '<li[ >]')) AS BIGINT) AS n_items, CAST(len(regexp_extract_all(html, '<p[ >]')) AS BIGINT) AS n_paragraphs FROM pages",
    "html_links": """SELECT page_id, CAST(unnest(range(len(h))) AS BIGINT) AS pos, unnest(h) AS href FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages) p""",
    "format_detect": """SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'json' WHEN page_id % 4 > 1 THEN 'html' ELSE CASE lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '\\.([A-Za-z0-9]+)$', 1))
 WHEN 'html' THEN 'html' WHEN 'htm' THEN 'html' WHEN 'pdf' THEN 'pdf' WHEN 'txt' THEN 'text' WHEN 'md' THEN 'md' ELSE 'text' END END AS format FROM pages""",
    "line_classifier_asciidoc": f"SELECT doc_id, pos, {_ASCIIDOC} AS kind FROM ({_LINES}) m",
    "line_classifier_md": f"SELECT doc_id, pos, {_MARKDOWN} AS kind FROM ({_LINES}) m",
    "csv_cells": """WITH f AS (SELECT file_id, arg_min(line, line_id) AS fl FROM d_csv GROUP BY 1), s AS (SELECT file_id, fl, CASE file_id % 5 WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN '|' WHEN 3 THEN ':' ELSE chr(9) END AS sep FROM f),
 r AS (SELECT c.file_id, CAST(row_number() OVER (PARTITION BY c.file_id ORDER BY line_id) - 1 AS BIGINT) AS row, string_split(line, sep) AS parts, len(string_split(fl, sep)) AS n FROM d_csv c JOIN s ON s.file_id = c.file_id)
 SELECT file_id, row, CAST(unnest(range(len(parts))) AS BIGINT) AS col, unnest(parts) AS text, row = 0 AS header, len(parts) <> n AS ragged FROM r""",
    "completeness_batch": """SELECT job_id, CAST(count(*) AS INTEGER) AS pages, string_agg(event_type, ',' ORDER BY page_no, event_type) AS payloads, 'complete' AS status FROM (SELECT CAST(floor(event_id / 4.0) AS BIGINT) AS job_id, event_id % 4 AS page_no, event_type FROM events) e GROUP BY 1 HAVING count(*) = 4""",
}
SQL["completeness_barrier_stream"] = SQL["completeness_batch"]

QUERIES = (
    text_quality_score, page_parse_score_p10, confidence_report, text_unicode_clean, text_ligatures, text_md_escape, text_direction, html_titles, html_headings_links_lists, html_links,
    html_tree, html_to_markdown, format_detect, line_classifier_asciidoc, line_classifier_md, csv_cells, completeness_batch, completeness_barrier_stream,
)
