"""Finding windows that recur, for the two dedup operators: anchors, pieces and spans.

``found`` has a row (doc_id, row, fp, ph, start, n) for each anchor of each document: fp is the
anchor's hash, and ph that of its piece, which is all ``n`` windows assigned to the anchor, the
first at ``start``. ``row`` is a hash of the document's id and text and stands for the document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.tables import drop, fresh, in_batches, written

#: From how many places on an anchor's places are dealt by salt, and how many salts there are.
CROWD, SALTS = 1000, 1024
SPAN = "doc_id bigint, row bigint, start int, stop int"
PIECE = "fp bigint, kinds bigint, doc_id bigint, row bigint, start int, n int, words binary"


def row_key(documents: DataFrame, text: str = "text") -> Column:
    """What stands for a document: a hash of its id, of any integer type, and its text, null counting as empty."""
    kind = documents.schema["doc_id"].dataType
    if not isinstance(kind, T.IntegralType | T.NullType):
        raise TypeError(f"doc_id has to be of an integer type, not {kind.simpleString()}")
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce(F.col(text), F.lit("")))


def keyed(documents: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, row, text) of the documents; a null text is empty. Ids of another than an integer type raise TypeError."""
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key(documents, text).alias("row"), body.alias("text"))


def recurring(found: DataFrame, recurs: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of ``found`` whose anchors recur, their distinct pieces, anchors with several); drops ``found``.

    ``recurs`` is a condition on an anchor's n (places), lo and hi (least and greatest doc_id).
    Distinct pieces have fp, ph, first (the first place), lo, hi and places; the anchors have fp and
    kinds, how many distinct pieces there are, which is 2 at least. ``crowd`` is how many places an anchor has.
    """
    by = found.groupBy("fp").agg(F.count("*").alias("places"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where(recurs)
    # written apart, so that the joins are plain ones, whose hot keys Spark splits
    by = written(by.select("fp", F.col("places").alias("crowd")), "anchors-again")
    again = written(found.join(by, "fp"), "recurring")
    drop(found)
    drop(by)
    pieces = again.groupBy("fp", "ph").agg(
        F.min(F.struct("doc_id", "row", "start", "n")).alias("first"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("places")
    )
    pieces = written(pieces, "distinct")
    kinds = written(pieces.groupBy("fp").agg(F.count("*").alias("kinds")).where("kinds > 1"), "kinds")
    return again, pieces, kinds


def at_places(again: DataFrame, pieces: DataFrame, keep: Callable[[Callable[[str], Column]], Column]) -> DataFrame:
    """The rows of ``again`` that ``keep`` keeps of those whose piece is one of ``pieces`` (fp, ph, and what else they are to get).

    Rows of an anchor with over ``CROWD`` places are gathered in ``SALTS`` lists a piece first, so that no
    task joins all places of one piece; the lists are dealt out again before they are taken apart. ``keep`` gets a
    function from the name of a place's column to the column.
    """
    few = again.where(F.col("crowd") <= CROWD).join(pieces, ["fp", "ph"]).where(keep(F.col))
    place = ["doc_id", "row", "start", "n"]
    salt = F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).alias("salt")
    lists = again.where(F.col("crowd") > CROWD).groupBy("fp", "ph", "crowd", salt).agg(F.collect_list(F.struct(*place)).alias("places"))
    kept = lists.join(pieces, ["fp", "ph"]).withColumn("places", F.filter("places", lambda p: keep(lambda name: p[name]))).where(F.size("places") > 0)
    many = kept.repartition("fp", "ph", "salt").withColumn("place", F.explode("places"))
    return few.unionByName(many.select(*["place." + c if c in place else c for c in few.columns]))


def cut(documents: DataFrame, wanted: DataFrame, take: Callable[[bytes], Callable[[int, int], bytes]]) -> DataFrame:
    """The content of the wanted pieces (fp, kinds, doc_id, row, start, n): ``take`` of a text gives it by start and n."""
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("fp", "kinds", "start", "n")).alias("pieces"))
    rows = documents.join(lists, "row").select("doc_id", "row", "text", "pieces")
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # rows that are repeated give their pieces once; copies of one row lie in one task
        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                doc_id, row = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if row in seen:
                    continue
                seen.add(row)
                part = take(batch.column(2)[i].as_py().encode())
                out += [(p["fp"], p["kinds"], doc_id, row, p["start"], p["n"], part(p["start"], p["n"])) for p in batch.column(3)[i].as_py()]
                if len(out) > 4096 or i == batch.num_rows - 1:
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in PIECE.split(", ")])
                    out = []
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in PIECE.split(", ")])

    return in_batches(rows, run, PIECE)


def with_spans(documents: DataFrame, spans: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``documents`` with its spans (start, stop) as column ``name``, null if it has none."""
    key = fresh(documents, "row")
    lists = spans.groupBy(F.col("row").alias(key)).agg(F.collect_list(F.struct("start", "stop")).alias(name))
    return documents.withColumn(key, row_key(documents, text)).join(lists, key, "left").drop(key)
