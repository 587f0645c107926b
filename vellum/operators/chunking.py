"""Retrieval chunks: headings in force, greedy token windows, merging of neighbours, and pages."""

from __future__ import annotations

from bisect import bisect_left
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.grouped import in_tables
from vellum.operators.serialize import markdown_part, markdown_parts, marked, together


class InForce:
    """The headings in force at a place of a document that is read in order: of those before, the last of each level that no shallower one has ended."""

    def __init__(self) -> None:
        self.levels: list[int] = []
        self.texts: tuple[str | None, ...] = ()

    def add(self, level: int | None, text: str | None) -> None:
        if level is None:
            return
        keep = bisect_left(self.levels, level)
        self.levels = [*self.levels[:keep], level]
        self.texts = (*self.texts[:keep], text)


def with_headings(rows: DataFrame, order: str, heading: Column, level: Column, text: Column) -> DataFrame:
    """``rows`` with ``headings``: those in force before each row, in the order of a column within its document."""
    given = rows.withColumns({"head_level_": F.when(heading, level).cast("bigint"), "head_text_": F.when(heading, text)})
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema.fields], T.StructField("headings", T.ArrayType(T.StringType()))])

    def document(table: pa.Table, edges: np.ndarray) -> pa.Table:
        levels, texts = table.column("head_level_").to_pylist(), table.column("head_text_").to_pylist()
        known = table.column("doc_id").is_valid().to_pylist()
        found: list[tuple] = []
        for a, b in pairwise(edges.tolist()):
            now = InForce()
            for i in range(a, b):
                found.append(now.texts)
                if levels[i] is not None and known[i]:
                    now.add(levels[i], texts[i])
        return table.append_column("headings", pa.array(found, pa.list_(pa.string())))

    return in_tables(given, "doc_id", [order], document, schema)


def heading_context(nodes: DataFrame) -> DataFrame:
    """(doc_id, node_id, headings): of the headings before a node, the last of each level that no shallower one has ended.

    nodes (doc_id, node_id, label, level, text) are in the order of node_id.
    """
    found = with_headings(nodes.select("doc_id", "node_id", "label", "level", "text"), "node_id", F.col("label") == "section_header", F.col("level"), F.col("text"))
    return found.select("doc_id", "node_id", "headings")


def contextualized(headings: Column, text: Column) -> Column:
    return F.concat_ws("\n", headings, text)


def tokens_of(text: Column) -> Column:
    """A plain token count: runs of characters other than white space."""
    return F.size(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0)))


def greedy_chunks(items: DataFrame, limit: int, *, key: str = "doc_id", count=tokens_of) -> DataFrame:  # noqa: ANN001
    """(key, chunk_id, text, n_tokens): lines of one heading packed in order into chunks of at most ``limit`` tokens.

    items (key, pos, heading, text) are folded within each run of one heading: a line opens a new chunk if its
    heading differs or it does not fit; a line over the limit is cut into pieces of ``limit`` tokens.
    """
    pieces = F.when(
        count(F.col("text")) > limit,
        F.transform(
            F.sequence(F.lit(0), F.floor((count(F.col("text")) - 1) / limit).cast("int")),
            lambda i: F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(r"\S+"), F.lit(0)), i * limit + 1, limit), " "),
        ),
    ).otherwise(F.array("text"))
    lines = items.select(key, "pos", F.coalesce("heading", F.lit("")).alias("heading"), F.posexplode(pieces).alias("part", "text"))
    order = Window.partitionBy(key).orderBy("pos", "part")
    turn = F.when(F.col("heading") == F.lag("heading").over(order), 0).otherwise(1)
    lines = lines.withColumn("n", count(F.col("text")).cast("bigint")).withColumn("turn", turn)
    lines = lines.withColumn("run", F.sum("turn").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ordered = lines.groupBy(key, "run", "heading").agg(F.array_sort(F.collect_list(F.struct("pos", "part", "text", "n"))).alias("lines"))
    start = F.struct(F.lit(-1).cast("bigint").alias("chunk"), F.lit(0).cast("bigint").alias("n"), F.array().cast("array<bigint>").alias("ids"))

    def step(acc: Column, line: Column) -> Column:
        fits = (acc.chunk >= 0) & (acc.n + line.n <= limit)
        chunk = F.when(fits, acc.chunk).otherwise(acc.chunk + 1)
        return F.struct(chunk.alias("chunk"), F.when(fits, acc.n + line.n).otherwise(line.n).alias("n"), F.concat(acc.ids, F.array(chunk)).alias("ids"))

    placed = ordered.select(key, "run", "heading", F.explode(F.arrays_zip("lines", F.aggregate("lines", start, step, lambda a: a.ids).alias("ids"))).alias("x"))
    placed = placed.select(key, "run", "heading", F.col("x.ids").alias("own"), "x.lines.*")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "part", "text"))), lambda p: p.text), "\n")
    chunks = placed.groupBy(key, "run", "heading", "own").agg(text.alias("text"), F.sum("n").alias("n_tokens"))
    number = F.row_number().over(Window.partitionBy(key).orderBy("run", "own")) - 1
    return chunks.select(key, number.cast("bigint").alias("chunk_id"), "text", "n_tokens", "heading")


def lines_of(documents: DataFrame) -> DataFrame:
    """(doc_id, pos, text) of the lines that are not blank; positions count all lines."""
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    return lines.where(F.trim("text") != "").select("doc_id", F.col("pos").cast("bigint").alias("pos"), "text")


def hierarchical(walk: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, headings, text, nodes): a chunk for each node with a text, one for a whole outermost list,
    none for headings, which are the context of what follows.

    walk is of ``tree.walked``; a title is a heading over all levels.
    """
    heading = F.col("label").isin("title", "section_header")
    level = F.when(F.col("label") == "title", 0).otherwise(F.col("level"))
    parts = marked(walk).select("doc_id", "pos", "node_id", heading.alias("heading"), level.alias("level"), F.when(heading, F.col("text")).alias("text"), F.get("lists", 0).alias("list_id"), F.when(heading, "").otherwise(markdown_part(escape=False)).alias("part"))
    found = with_headings(parts.where("heading or part <> ''"), "pos", F.col("heading"), F.col("level"), F.col("text"))
    flow = found.where("part <> ''").select("doc_id", "pos", "node_id", "list_id", "part", "headings").repartition("doc_id")
    first = F.coalesce("list_id", -1 - F.col("pos"))  # nodes outside of lists stand alone
    in_order = F.array_sort(F.collect_list(F.struct("pos", "part", "node_id")))
    chunks = flow.groupBy("doc_id", first.alias("of")).agg(F.min("pos").alias("pos"), F.min_by("headings", "pos").alias("headings"), in_order.alias("items"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")) - 1
    return chunks.select("doc_id", number.cast("bigint").alias("chunk_id"), "headings", F.array_join("items.part", "\n").alias("text"), F.col("items.node_id").alias("nodes"))


def by_page(walk: DataFrame) -> DataFrame:
    """(doc_id, page_no, text): one chunk for each page; a document without pages is one chunk."""
    return together(markdown_parts(walk), "doc_id", "page_no")


def hybrid(walk: DataFrame, limit: int, *, count=tokens_of) -> DataFrame:  # noqa: ANN001
    """Hierarchical chunks cut where they exceed ``limit`` tokens, and neighbours of the same headings put together up to it."""
    items = hierarchical(walk).select("doc_id", F.col("chunk_id").alias("pos"), F.array_join("headings", "\n").alias("heading"), "text")
    return greedy_chunks(items, limit, count=count)
