"""Ranked lexical search as a blocked sparse matrix product.

Items times terms is a sparse matrix A, of each item's multiplicities of its terms, and terms times
documents a sparse matrix B of int64 impacts. Items are dealt in blocks of bounded size; a block's A goes
to all tasks. A task makes B of a slice of its documents at a time and multiplies row by row as Gustavson
does: an item's row of the product is the merge of the rows of B that its terms name. Of each
item's row only the k best leave the task, and those of all tasks are reduced in two steps.

The documents are read twice for a block of items: for N, L and df, and for the product. Nothing of a
document is shuffled but its id and score where it is among a task's k best.

Terms are runs of ASCII letters, digits and characters from U+0080 on, with A-Z lower-cased. In UTF-8 the
latter are the bytes from 0x80 on, so terms are found on bytes.

Defined cases: null and empty texts, and texts without a term, are found by no item and not counted in N; rows that
repeat a doc_id are documents of their own; equal scores go by ascending doc_id, a null one last; rows that repeat an
item_id are one item with the terms of all; items without terms have no rows; no documents or no items give no rows;
of the columns of both tables only ids and texts are read, so other names cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.hashing import LOWER, flat, slices, word_spans
from llm.tables import in_batches, table, written

#: Bytes that separate terms.
GAP = np.ones(256, dtype=bool)
GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Bytes of item texts in a block, and of documents in a slice.
ITEM_BYTES, SLICE = 1 << 21, 1 << 21
#: Salts of the first reduction, each of which keeps k rows an item.
SALTS = 64
DOCUMENTS, TERMS = -1, -2


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(the terms one after another as a binary array, offsets of the rows in it)."""
    starts, stops, rows = word_spans(data, offsets, GAP)
    at = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    buffers = [None, pa.py_buffer(at), pa.py_buffer(LOWER[data[~GAP[data]]])]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), rows


@dataclass
class Block:
    """The rows of A of some items: item i has the terms ``term[start[i]:start[i + 1]]`` of the vocabulary, ``times`` each."""

    items: pa.Array
    vocabulary: pa.Array
    start: np.ndarray
    term: np.ndarray
    times: np.ndarray

    def numbers(self, found: pa.Array) -> np.ndarray:
        """The vocabulary's number of each term, -1 for those that it lacks."""
        return pc.fill_null(pc.index_in(found, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False)


def block_of(items: pa.Table, *, multiplicity: bool) -> Block:
    """The block of the items (item_id, text) of a table, rows of one id taken together."""
    texts = items.column(1).combine_chunks()
    found, rows = terms(*flat(texts))
    words, counts = found.to_pylist(), {}
    for i, item in enumerate(items.column(0).to_pylist()):
        counts.setdefault(item, Counter()).update(words[rows[i] : rows[i + 1]])
    number = {w: i for i, w in enumerate(sorted({w for c in counts.values() for w in c}))}
    times = [n if multiplicity else 1 for c in counts.values() for n in c.values()]
    return Block(
        pa.array(list(counts), items.schema.field(0).type),
        pa.array(list(number), pa.large_binary()),
        np.concatenate([[0], np.cumsum([len(c) for c in counts.values()])]).astype(np.int64),
        np.array([number[w] for c in counts.values() for w in c], dtype=np.int64),
        np.array(times, dtype=np.int64),
    )


def statistics(documents: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """(N, L, df of the block's terms): documents with a term, terms of all documents, documents with each term."""
    size = len(block.vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_documents, n_terms = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(1), SLICE):
                found, rows = terms(data, offsets)
                lengths = np.diff(rows)
                n_documents, n_terms = n_documents + int((lengths > 0).sum()), n_terms + len(found)
                number = block.numbers(found)
                own = np.repeat(np.arange(len(lengths)), lengths)[number >= 0]
                df += np.bincount(np.unique(own * size + number[number >= 0]) % size, minlength=size) if size else 0
        hit = np.flatnonzero(df)
        term = np.concatenate([[DOCUMENTS, TERMS], hit]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.concatenate([[n_documents, n_terms], df[hit]]).astype(np.int64))], names=["term", "n"])

    sums = in_batches(documents, counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # at most a row for each term of the block
    df, total = np.zeros(size, dtype=np.int64), {r.term: r.n for r in sums}
    for term, n in total.items():
        if term >= 0:
            df[term] = n
    return total.get(DOCUMENTS, 0), total.get(TERMS, 0), df


def impacts(block: Block, weight: np.ndarray, n: int, total: int, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """B of a slice by rows: (where each term's row starts, documents, impacts)."""
    found, rows = terms(data, offsets)
    lengths, size = np.diff(rows), len(offsets) - 1
    number = block.numbers(found)
    own = np.repeat(np.arange(size), lengths)[number >= 0]
    cell, tf = np.unique(number[number >= 0].astype(np.int64) * size + own, return_counts=True)
    term, document = cell // size, cell % size
    m = 50 + (50 * lengths.astype(np.int64) * n) // max(total, 1)
    impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[document]))
    return np.searchsorted(term, np.arange(len(block.vocabulary) + 1)), document, impact


def kept(item: np.ndarray, score: np.ndarray, ids: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions of each item's k best, their ranks from 0): the highest scores, ties to smaller ids."""
    order = np.lexsort((pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy(), -score, item))
    first = np.searchsorted(item[order], item[order], side="left")
    rank = np.arange(len(order)) - first
    return order[rank < k], rank[rank < k]


def product(documents: DataFrame, block: Block, k: int) -> DataFrame:
    """(item, doc_id, score): of each task the k documents with the highest scores over 0 for each item of the block."""
    n, total, df = statistics(documents, block)
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", documents.schema[0].dataType), T.StructField("score", T.LongType())])

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, least = None, np.ones(len(block.items), dtype=np.int64)  # of each item the score that a document has to reach
        for batch in batches:
            for begin, stop, data, offsets in slices(batch.column(1), SLICE):
                row, document, impact = impacts(block, weight, n, total, data, offsets)
                items, scores, places = [], [], []
                merged = np.zeros(stop - begin, dtype=np.int64)
                for i in range(len(block.items)):
                    merged[:] = 0
                    for j in range(block.start[i], block.start[i + 1]):  # a document comes once at most in each row of B
                        part = slice(row[block.term[j]], row[block.term[j] + 1])
                        merged[document[part]] += block.times[j] * impact[part]
                    hit = np.flatnonzero(merged >= least[i])
                    items.append(np.full(len(hit), i, dtype=np.int64))
                    scores.append(merged[hit])
                    places.append(hit + begin)
                found = np.concatenate(items), np.concatenate(scores), batch.column(0).take(pa.array(np.concatenate(places)))
                if best is not None:
                    found = np.concatenate([best[0], found[0]]), np.concatenate([best[1], found[1]]), pa.concat_arrays([best[2], found[2]])
                keep, rank = kept(*found, k)
                best = found[0][keep], found[1][keep], found[2].take(pa.array(keep))
                least[best[0][rank == k - 1]] = best[1][rank == k - 1]
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array(best[0]), best[2], pa.array(best[1])], names=["item", "doc_id", "score"])

    return in_batches(documents, multiplied, schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``found`` with each item's k best and their ``rank``; each salt's k best first, so that no task reads all rows of an item."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return salted.drop("salt").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def search(documents: DataFrame, items: DataFrame, *, k: int = 50, multiplicity: bool = False) -> DataFrame:
    """(item_id, rank int, doc_id, score long): the k documents with the highest scores over 0 of each item.

    With ``multiplicity`` a term counts as often as the item has it, else once. An item's text may
    be as long as one value can be; ``ITEM_BYTES`` bounds the blocks of several items.
    """
    spark = documents.sparkSession
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    items = items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    size = F.sum(F.octet_length("text")).alias("size")
    parts = 1
    while True:  # an item is in one block; a block with over twice ITEM_BYTES has one item
        part = F.pmod(F.xxhash64("item_id", F.lit(11)), F.lit(parts))
        worst = items.groupBy(part.alias("part")).agg(size, F.count_distinct("item_id").alias("n")).where(f"size > {2 * ITEM_BYTES} and n > 1")
        if worst.isEmpty():
            break
        parts *= 2
    schema = T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()), T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
    out = []
    for at in range(parts):
        block = block_of(items.where(part == at).toArrow(), multiplicity=multiplicity)
        if not len(block.vocabulary):
            continue
        found = ranked(product(documents, block, k), k)
        names = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(block.items))), "item_id": block.items}))
        named = found.join(F.broadcast(names), "item").select(F.col("item_id").cast(schema["item_id"].dataType), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out.append(written(named, "ranked"))  # the next block's matrix takes this one's place
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], schema)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


#: DuckDB: postings of the items' terms joined with the items.
ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM counts, totals GROUP BY term),
impacts AS (
  SELECT c.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))) AS impact
  FROM counts c JOIN weights USING (term) JOIN lengths USING (doc_id), totals),
scores AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""
