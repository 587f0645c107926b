"""Derived views of the test tables: pages, regions, cells, tables, tokens, nodes and texts.

One SQL text serves Spark and DuckDB: ``{table}`` stands for a base table. Only integer arithmetic
that both engines compute alike is used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: In order of dependence.
VIEWS: dict[str, str] = {
    "d_pages": """
SELECT o_custkey AS doc_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS BIGINT) AS page_no,
 o_orderkey AS page_id, CAST(612 AS DOUBLE) AS width, CAST(792 AS DOUBLE) AS height FROM {orders}""",
    "d_rows": """
SELECT l_orderkey AS page_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
 l_extendedprice, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS BIGINT) AS ix, l_partkey AS pk, l_suppkey AS sk,
 CAST(l_quantity AS BIGINT) AS q, CAST(l_linenumber AS BIGINT) AS ln FROM {lineitem}""",
    "d_clusters": """
SELECT page_id, ix AS cluster_id,
 CASE (pk + ix) % 8 WHEN 0 THEN 'table' WHEN 1 THEN 'picture' WHEN 2 THEN 'section_header' WHEN 3 THEN 'list_item' WHEN 4 THEN 'caption'
 WHEN 5 THEN 'footnote' WHEN 6 THEN 'title' ELSE 'text' END AS label,
 CAST(40 + pk % 60 AS DOUBLE) / 100 AS confidence,
 CAST(l0 AS DOUBLE) AS l, CAST(t0 AS DOUBLE) AS t, CAST(l0 + 100 + CASE WHEN q % 9 = 0 THEN 60 ELSE 0 END AS DOUBLE) AS r,
 CAST(t0 + 40 + (ix % 2) * ln AS DOUBLE) AS b
 FROM (SELECT *, (page_id * 37 + CAST(floor(ix / 4.0) AS BIGINT) * 131) % 380 + (ix % 4) * 12 AS l0,
 (page_id * 53 + CAST(floor(ix / 4.0) AS BIGINT) * 89) % 560 AS t0 FROM d_rows) x""",
    "d_cells": """
SELECT c.page_id, c.cluster_id * 3 + v.k AS cell_ix,
 c.l + 4 + v.k * 38 AS l, CASE WHEN (c.cluster_id + v.k + c.page_id) % 11 = 0 THEN CAST(740 AS DOUBLE) ELSE c.t + 5 END AS t,
 c.l + 34 + v.k * 38 AS r, CASE WHEN (c.cluster_id + v.k + c.page_id) % 11 = 0 THEN CAST(752 AS DOUBLE) ELSE c.t + 17 END AS b,
 CASE WHEN (c.page_id + v.k) % 13 = 0 THEN ' ' ELSE 'w' || CAST((c.page_id * 7 + c.cluster_id + v.k) % 97 AS STRING)
  || CASE WHEN v.k = 2 AND c.page_id % 3 = 0 THEN '-' ELSE '' END END AS text
 FROM d_clusters c CROSS JOIN (VALUES (0),(1),(2)) AS v(k)""",
    "d_based": """
SELECT page_id AS doc_id, ix AS node_id, CASE WHEN ix = 0 THEN NULL ELSE CAST(floor((ix - 1) / 3.0) AS BIGINT) END AS parent_id,
 CASE (pk + ix) % 9 WHEN 0 THEN 'list' WHEN 1 THEN 'section_header' WHEN 2 THEN 'code' WHEN 3 THEN 'picture' WHEN 4 THEN 'formula' WHEN 5 THEN 'ordered_list' WHEN 6 THEN 'title' ELSE 'text' END AS base,
 CASE WHEN (pk + ix) % 7 = 0 THEN 'furniture' ELSE 'body' END AS layer, 1 + pk % 3 AS level,
 CASE WHEN (pk + ix) % 9 IN (0, 3, 5) THEN '' ELSE 'n_' || CAST(pk AS STRING) || CASE WHEN sk % 3 = 0 THEN ' <&> two words' ELSE '' END END AS text FROM d_rows""",
    "d_nodes": """
SELECT page_id AS doc_id, ix AS node_id, CASE WHEN ix = 0 THEN NULL ELSE CAST(floor((ix - 1) / 3.0) AS BIGINT) END AS parent_id,
 CASE WHEN (pk + ix) % 5 = 0 THEN 'furniture' ELSE 'body' END AS content_layer, CASE WHEN pk % 4 = 0 THEN 'section_header' ELSE 'text' END AS label,
 1 + pk % 3 AS level, 'n' || CAST(pk AS STRING) AS text FROM d_rows""",
    "d_tree": """
SELECT n.doc_id, n.node_id, n.parent_id, n.node_id AS child_ix, CASE WHEN p.base IN ('list', 'ordered_list') AND n.base NOT IN ('list', 'ordered_list') THEN 'list_item' ELSE n.base END AS label,
 n.layer, n.level, CAST(floor(n.node_id / 3.0) AS BIGINT) + 1 AS page_no, n.text FROM d_based n LEFT JOIN d_based p ON p.doc_id = n.doc_id AND p.node_id = n.parent_id""",
    "d_otsl": """
SELECT p_partkey AS table_id, CASE p_partkey % 4 WHEN 0 THEN 'ched ched nl fcel fcel nl' WHEN 1 THEN 'ched lcel nl fcel ecel nl'
 WHEN 2 THEN 'rhed fcel nl ucel fcel nl fcel fcel nl' ELSE 'srow lcel nl fcel nl' END AS otsl FROM {part}""",
    "d_table_cells": """
SELECT page_id AS table_id, ix AS cell_id, CAST(floor(ix / 3.0) AS BIGINT) AS row_id, ix % 3 AS column_id, CASE WHEN pk % 10 = 0 THEN 1 ELSE 2 END AS cell_class,
 CAST((ix % 3) * 100 + q % 7 AS DOUBLE) AS x1, CAST(CAST(floor(ix / 3.0) AS BIGINT) * 20 AS DOUBLE) AS y1, CAST((ix % 3) * 100 + 70 + q % 11 AS DOUBLE) AS x2,
 CAST(CAST(floor(ix / 3.0) AS BIGINT) * 20 + 16 AS DOUBLE) AS y2 FROM d_rows""",
    "d_tokens": """
SELECT table_id, cell_id AS token_id, x1 + 5 + (table_id % 4) * 15 AS x1, CASE WHEN (table_id + cell_id) % 9 = 0 THEN y1 + 200 ELSE y1 + 2 END AS y1,
 CASE WHEN (table_id + cell_id) % 5 = 0 THEN x1 + 130 ELSE x1 + 45 + (table_id % 4) * 15 END AS x2, CASE WHEN (table_id + cell_id) % 9 = 0 THEN y1 + 212 ELSE y1 + 14 END AS y2,
 CASE WHEN cell_id % 3 = 0 THEN 'lab' || CAST(cell_id AS STRING) ELSE '$' || CAST(table_id % 1000 AS STRING) END AS text FROM d_table_cells""",
    "d_otsl_odd": """
SELECT p_partkey AS table_id, CASE p_partkey % 5 WHEN 0 THEN 'ched ched nl fcel fcel nl' WHEN 1 THEN 'ched lcel lcel nl fcel ecel ucel nl' WHEN 2 THEN 'fcel lcel nl ucel lcel fcel nl'
 WHEN 3 THEN 'fcel lcel xcel nl ucel xcel fcel nl' ELSE 'srow lcel nl fcel lcel fcel lcel nl rhed fcel nl' END AS otsl FROM {part}""",
    "d_tokens_lost": """
SELECT c.table_id, c.cell_id AS token_id, c.x1 + 5 AS x1, CASE WHEN n = 7 AND c.row_id = 1 AND c.column_id < 2 THEN c.y1 + 200 ELSE c.y1 + 2 END AS y1, c.x1 + 45 AS x2,
 CASE WHEN n = 7 AND c.row_id = 1 AND c.column_id < 2 THEN c.y1 + 212 ELSE c.y1 + 14 END AS y2,
 CASE WHEN c.cell_id = 6 THEN ' ' WHEN c.column_id = 0 THEN 'total' WHEN c.table_id % 5 = 0 THEN 'n/a' ELSE CAST(c.table_id % 1000 AS STRING) END AS text
 FROM d_table_cells c JOIN (SELECT table_id, count(*) AS n FROM d_table_cells GROUP BY table_id) k ON k.table_id = c.table_id""",
    "d_elements": """
SELECT p.doc_id, p.page_no, c.cluster_id, c.label, c.l, 792 - c.t AS t, c.r, 792 - c.b AS b FROM d_clusters c JOIN d_pages p ON p.page_id = c.page_id""",
    "d_texts": """
SELECT doc_id, lang, source, text || CASE doc_id % 12
 WHEN 0 THEN ' GLYPH<0A1F>' WHEN 1 THEN ' x/G12/G34' WHEN 2 THEN ' a/bc.de/fg.hi b/bc.de/fg.hi c/bc.de/fg.hi'
 WHEN 3 THEN ' snake_case_name ‘q’' WHEN 4 THEN ' “q” – dash' WHEN 5 THEN ' bad�char' WHEN 6 THEN ' hyphen-'
 WHEN 7 THEN ' ﬁne ﬂow' WHEN 8 THEN ' 1⁄2 • <b>&' WHEN 9 THEN ' ________________' ELSE '' END AS text FROM {documents}""",
    "d_csv": """
SELECT CAST(floor(p_partkey / 50.0) AS BIGINT) AS file_id, p_partkey AS line_id,
 CASE CAST(floor(p_partkey / 50.0) AS BIGINT) % 5 WHEN 0 THEN replace(line, '~', ',') WHEN 1 THEN replace(line, '~', ';') WHEN 2 THEN replace(line, '~', '|')
 WHEN 3 THEN replace(line, '~', ':') ELSE replace(line, '~', chr(9)) END AS line
 FROM (SELECT p_partkey, CAST(p_partkey AS STRING) || '~' || 'b' || CAST(p_partkey % 25 AS STRING) || '~s' || CAST(p_size AS STRING)
  || CASE WHEN p_partkey % 7 = 0 THEN '~x' ELSE '' END AS line FROM {part}) p""",
}


def _needed(name: str, found: list[str]) -> list[str]:
    for other in VIEWS:
        if other != name and re.search(rf"\b{other}\b", VIEWS[name]):
            _needed(other, found)
    if name not in found:
        found.append(name)
    return found


def chain(*names: str) -> str:
    """The WITH clauses that the named views need, without the keyword."""
    found: list[str] = []
    for name in names:
        _needed(name, found)
    return ",\n".join(f"{n} AS ({VIEWS[n]})" for n in found)


def for_duckdb(sql: str) -> str:
    """``sql`` with base tables, and the views that it mentions, put in place."""
    names = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    body = sql.strip()
    if names:
        recursive = bool(re.match(r"(?i)with recursive\b", body))
        rest = re.sub(r"(?i)^with(\s+recursive)?\s", "", body)
        body = f"WITH {'RECURSIVE ' if recursive else ''}{chain(*names)}" + (f",\n{rest}" if rest != body else f"\n{body}")
    return re.sub(r"\{(\w+)\}", r"\1", body)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = f"WITH {chain(name)} SELECT * FROM {name}"
    return spark.sql(re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", sql))


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
