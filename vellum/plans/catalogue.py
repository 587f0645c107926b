"""All registered queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.plans import chunk_queries, document_queries, extra_queries, layout_queries, more_queries, page_queries, service_queries, source_queries, stream_queries, table_queries, text_queries, tree_queries
from vellum.plans.fixtures import for_duckdb

MODULES = (layout_queries, table_queries, document_queries, text_queries, more_queries, extra_queries, tree_queries, page_queries, source_queries, chunk_queries, stream_queries, service_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for m in MODULES for f in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: for_duckdb(sql) for m in MODULES for name, sql in m.SQL.items()}
