"""Suffix-array dedup of bytes: every byte under a string of ``WINDOW`` bytes that starts twice goes.

1. Each window (``WINDOW`` bytes of a document) is assigned to an anchor, the ``ANCHOR``-byte string
   in it with the smallest hash. Equal windows have equal anchors, so only windows whose anchors
   recur can recur. The piece of an anchor is all windows assigned to it, some 280 bytes; a window
   lies in one piece only.
2. Pieces that are equal byte for byte (two 64-bit hashes) and occur twice go whole. This takes hot
   groups of copies down to one piece each.
3. Where an anchor has several different pieces, those of each anchor meet in a shard. A shard's
   text is its distinct pieces with separators; its suffix array is made by induced sorting, and
   permuted common prefixes of WINDOW or more mark both suffixes as repeated.
   The windows of an anchor with over ``HOT`` pieces, where the core that ``GRID`` neighbours share
   recurs, are first counted over all tasks; its pieces are
   dealt by a salt, and each salt also gets the pieces that hold the first or last place of a
   recurring window; no limit drops anything.

Defined cases: a null text is empty; a text of under WINDOW bytes loses nothing and is no source;
matches never cross documents; repeated rows are documents of their own, so both go; rows with a
null doc_id are documents too; an empty table has no rows; columns named like the outputs are
replaced. Kept bytes need not be valid UTF-8, so ``kept`` is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.hashing import assigned, flat, merged, mix, prefix, ranges, slices, windows
from llm.recurrence import SPAN, at_places, cut, keyed, recurring, with_spans
from llm.suffix_array import permuted_prefixes, suffix_array
from llm.tables import fresh, in_batches, in_groups, others, table, written

WINDOW = 200
ANCHOR = 40
HOT = 1000
SHARD = 6000
GRID = 20
PLACE = np.uint64(0x9E3779B97F4A7C15)


def anchors(documents: DataFrame, window: int, anchor: int) -> DataFrame:
    """(doc_id, row, fp, ph, start, n): each anchor's hash, and hash and place of its n windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in slices(batch.column(2)):
                at = np.repeat(np.arange(last - first, dtype=np.int32), np.diff(offsets))
                sums = prefix(data)
                hashes = mix(windows(sums, anchor))
                ok = offsets[1:][at] - np.arange(len(data)) >= window
                pos, begin, end = assigned(hashes, window - anchor + 1, ok)
                ph = mix(ranges(sums, begin, end + window) + (pos - begin).astype(np.uint64) * PLACE)
                own = at[pos]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(first + own.astype(np.int64))), pa.array(keys[first + own]), pa.array(hashes[pos].view(np.int64)),
                        pa.array(ph.view(np.int64)), pa.array((begin - offsets[own]).astype(np.int32)), pa.array((end - begin + 1).astype(np.int32)),
                    ],
                    names=["doc_id", "row", "fp", "ph", "start", "n"],
                )

    return in_batches(documents, run, "doc_id bigint, row bigint, fp bigint, ph bigint, start int, n int")


def repeated(pieces: list[bytes], counts: np.ndarray, window: int) -> np.ndarray:
    """For the windows of all pieces in turn (``counts`` each), whether each starts twice or more."""
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    data = np.frombuffer(b"\0".join(pieces) + b"\0\0", dtype=np.uint8).astype(np.uint16) + 2
    offsets = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    data[offsets + lengths] = 1
    data[-1] = 0
    shared, before = permuted_prefixes(data, suffix_array(data))
    twice = np.flatnonzero(shared >= window)
    mark = np.zeros(len(data) + 1, dtype=bool)
    mark[twice] = True
    mark[before[twice]] = True
    starts = np.repeat(offsets, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return mark[starts]


def grid(sums: np.ndarray, offsets: np.ndarray, n: np.ndarray, fps: np.ndarray, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first window, last window + 1, start of what they share) of runs of windows whose distance
    to the anchor is the same multiple of GRID, rounded down."""
    at = np.repeat(np.arange(len(n)), np.diff(offsets))
    hashes = mix(windows(sums, anchor))
    place = np.arange(len(hashes))
    hit = np.flatnonzero((hashes == fps[at[: len(hashes)]]) & (place >= (offsets[:-1] + n - 1)[at[: len(hashes)]]))
    pieces, first = np.unique(at[hit], return_index=True)
    pos = hit[first]
    begin, stop = offsets[:-1][pieces], (offsets[:-1] + n)[pieces]
    least, most = (pos - stop + 1) // GRID, (pos - begin) // GRID
    runs = most - least + 1
    own = np.repeat(np.arange(len(pieces)), runs)
    j = np.repeat(least, runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    low = np.maximum(begin[own], pos[own] - GRID * j - GRID + 1)
    high = np.minimum(stop[own], pos[own] - GRID * j + 1)
    return pieces[own], low, high, pos[own] - GRID * j


def locate(pieces: DataFrame, window: int, anchor: int, hot: int, shard: int) -> DataFrame:
    """Spans of the pieces' documents that recur; pieces are read repeatedly."""
    count = pieces.count()
    if not count:
        return pieces.sparkSession.createDataFrame([], SPAN)
    common = pieces.where(F.col("kinds") > hot)

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for first, last, data, offsets in slices(batch.column(2), 1 << 18):
                n = batch.column(1).to_numpy()[first:last].astype(np.int64)
                sums = prefix(data)
                own, low, high, at = grid(sums, offsets, n, fps[first:last], anchor)
                core = mix(ranges(sums, at, at + window - GRID + 1)).view(np.int64)
                rows = pa.array(first + own)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array(core), batch.column(3).take(rows), pa.array((low - offsets[own]).astype(np.int32)), pa.array((high - offsets[own]).astype(np.int32))],
                    names=["fp", "core", "id", "low", "high"],
                )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(2), 1 << 18):
                low = batch.column(1).to_numpy()[first:last].astype(np.int64) + offsets[:-1]
                n = batch.column(4).to_numpy()[first:last].astype(np.int64) + offsets[:-1] - low
                begin = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                h = mix(ranges(prefix(data), begin, begin + window)).view(np.int64)
                own = pa.array(np.repeat(np.arange(first, last), n))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), pa.array(h), batch.column(3).take(own)], names=["fp", "h", "id"])

    # Hot anchors: which windows recur is counted over all tasks, and the pieces of each one's first and last
    # places are sources: every other place meets the first, and the first meets the last. GRID neighbouring windows share a core; only windows whose core recurs can, so the others are not made.
    named = common.select("fp", "n", "words", F.xxhash64("row", "start").alias("id"))
    core = in_batches(named, cores, "fp bigint, core bigint, id bigint, low int, high int")
    again = core.groupBy("fp", "core").agg(F.count("*").alias("places")).where("places > 1").select("fp", "core")
    open_ = core.join(again, ["fp", "core"]).join(named.select("fp", "id", "words"), ["fp", "id"])
    found = in_batches(open_.select("fp", "low", "words", "id", "high"), hashed, "fp bigint, h bigint, id bigint")
    ends = found.groupBy("fp", "h").agg(F.count("*").alias("places"), F.array(F.min("id"), F.max("id")).alias("ids")).where("places > 1")
    sources = ends.select("fp", F.explode("ids").alias("id")).distinct()
    salts = F.ceil(F.col("kinds") / hot).cast("int")
    rows = pieces.withColumn("id", F.xxhash64("row", "start")).withColumn("own", F.when(F.col("kinds") > hot, F.pmod(F.hash("id"), salts)).otherwise(0).cast("int"))
    shared = rows.where(F.col("kinds") > hot).join(sources, ["fp", "id"]).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).where("salt <> own")
    columns = ["fp", "salt", "doc_id", "row", "start", "n", "words", "source"]
    rows = rows.select(*(F.col("own").alias("salt") if c == "salt" else F.lit(False).alias(c) if c == "source" else F.col(c) for c in columns))
    rows = rows.unionByName(shared.select(*(F.lit(True).alias(c) if c == "source" else F.col(c) for c in columns)))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("fp", "salt"), F.lit(-(-count // shard))))

    def one_shard(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("source", kind="stable").drop_duplicates(["row", "start"])  # no piece meets itself
        n = group.n.to_numpy().astype(np.int64)
        mark = repeated(group.words.tolist(), n, window)
        own = np.repeat(np.arange(len(n)), n)
        turn = np.ones(len(mark), dtype=bool)
        turn[1:] = (mark[1:] != mark[:-1]) | (own[1:] != own[:-1])
        begin = np.flatnonzero(turn)
        stop = np.append(begin[1:], len(mark))
        keep = mark[begin] & ~group.source.to_numpy().astype(bool)[own[begin]]
        begin, stop = begin[keep], stop[keep]
        at = own[begin]
        offset = group.start.to_numpy()[at] - (np.cumsum(n) - n)[at]
        return pd.DataFrame({"doc_id": group.doc_id.to_numpy()[at], "row": group.row.to_numpy()[at], "start": begin + offset, "stop": stop + offset + window - 1})

    return in_groups(rows.groupBy("shard"), one_shard, SPAN)


def removed_spans(documents: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """(doc_id, row, start, stop): byte spans to remove; ``documents`` has doc_id, row and text."""
    found = written(anchors(documents, window, anchor), "anchors")
    again, distinct, kinds = recurring(found, F.col("places") > 1)
    copies = at_places(again, distinct.where("places > 1").select("fp", "ph"), lambda of: F.lit(True))
    whole = copies.select("doc_id", "row", "start", (F.col("start") + F.col("n") + window - 1).cast("int").alias("stop"))
    wanted = distinct.select("fp", "first.*").join(kinds, "fp").select("fp", "kinds", "doc_id", "row", "start", "n")
    pieces = written(cut(documents, wanted, lambda text: lambda start, n: text[start : start + n + window - 1]), "pieces")
    return whole.unionByName(locate(pieces, window, anchor, hot, shard))


def dedup(documents: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """``documents`` with n_bytes, n_removed, n_spans, removed (the spans) and kept (the bytes left)."""
    made = ["n_bytes", "n_removed", "n_spans", "removed", "kept"]
    own = others(documents, made)
    name = fresh(documents, "spans")
    spans = removed_spans(keyed(documents), window=window, anchor=anchor, hot=hot, shard=shard)
    rows = with_spans(documents.select(*own), spans, name)
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
    schema = T.StructType([
        *[documents.schema[c] for c in own], T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("removed", span), T.StructField("kept", T.BinaryType()),
    ])
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                data, offsets = flat(part.column(part.schema.get_field_index("text")))
                out: list[tuple] = []
                for i, found in enumerate(part.column(part.schema.get_field_index(name))):
                    text = data[offsets[i] : offsets[i + 1]].tobytes()
                    a = b = np.empty(0, dtype=np.int64)
                    kept = text
                    if found.is_valid:
                        pairs = np.array([(s["start"], s["stop"]) for s in found.as_py()], dtype=np.int64)
                        a, b = merged(pairs[:, 0], pairs[:, 1])
                        edges = [0, *np.column_stack([a, b]).ravel().tolist(), len(text)]
                        kept = b"".join(text[edges[j] : edges[j + 1]] for j in range(0, len(edges), 2))
                    out.append((len(text), len(text) - len(kept), len(a), [{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)], kept))
                columns = [part.column(part.schema.get_field_index(c)) for c in own]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))], names=[*own, *made])

    return in_batches(rows, run, schema)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(documents).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
