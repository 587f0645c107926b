"""Substring dedup by word windows: recurring passages located by sharded Aho-Corasick automata.

A window is ``WINDOW`` consecutive words (runs of characters other than \\x20 and \\x09-\\x0D). A word
goes if a window over it also starts in a document with a smaller doc_id.

1. Each window is assigned to an anchor, the ``ANCHOR``-word phrase in it with the smallest hash.
   Equal windows have equal anchors, so only windows whose anchors recur in another document can
   recur. The piece of an anchor is all windows assigned to it, some 70 words.
2. Pieces that are equal word for word (two 64-bit hashes) are one: of their documents all but the
   first lose the whole piece. This takes hot groups of copies down to one piece each. Pieces that
   very many places have are looked up document by document, and give merged spans.
3. Where an anchor has several different pieces, those of each anchor meet in a shard. Windows
   that recur there are confirmed, compiled into an Aho-Corasick automaton over words, and every
   piece is streamed through it; each hit on a window from a smaller doc_id goes, at every place
   where the first document has the piece.
   An anchor with over ``HOT`` pieces is confirmed by a distributed count first: sorted by the words
   after their anchor, and by those before it, pieces lie beside the ones with which they have most in
   common, so all windows that reach farther are in one piece alone; what is left of the pieces
   is mostly equal, and its windows are counted once for each different text. The pieces are
   dealt by a salt, each salt with the confirmed windows; no limit drops anything.

Defined cases: a null or empty text has no words; documents of under WINDOW words lose nothing and
are no source; a window that repeats in one document only is kept; rows with one doc_id never take
from each other, whatever their texts; rows with a null doc_id are kept whole and are no source;
an empty table has no rows; columns named like the outputs are replaced.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.hashing import assigned, merged, mix, prefix, ranges, slices, windows, word_hashes
from llm import recurrence
from llm.recurrence import SPAN, at_places, cut, keyed, recurring, with_spans
from llm.tables import fresh, in_batches, in_groups, others, table, written

WINDOW = 50
ANCHOR = 10
HOT = 256
SHARD = 2000
#: The most pieces that are looked up from a copy in each task (24 bytes a piece); where more are crowded, places are joined.
LOOKED_UP = 1_000_000
HIT = "fp bigint, row bigint, at int, doc_id bigint, start int, stop int"


def anchors(documents: DataFrame, window: int, anchor: int) -> DataFrame:
    """(doc_id, row, fp, ph, start, n): each anchor's hash, and hash and place of its n windows."""
    schema = "doc_id bigint, row bigint, fp bigint, ph bigint, start int, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in slices(batch.column(2)):
                words, rows = word_hashes(data, offsets)
                n = np.diff(rows)
                at = np.repeat(np.arange(last - first), n)
                sums = prefix(words)
                hashes = mix(windows(sums, anchor))
                ok = rows[1:][at] - np.arange(len(words)) >= window
                pos, begin, end = assigned(hashes, window - anchor + 1, ok)
                ph = mix(ranges(sums, begin, end + window) + (pos - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                own = at[pos]
                columns = [ids[first + own], keys[first + own], hashes[pos].view(np.int64), ph.view(np.int64), (begin - rows[own]).astype(np.int32), (end - begin + 1).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "row", "fp", "ph", "start", "n"])

    return in_batches(documents, run, schema)


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each word, offsets by text); equal words have equal numbers."""
    numbers: dict[bytes, int] = {}
    split = [t.split(b" ") for t in texts]
    codes = [numbers.setdefault(w, len(numbers)) for words in split for w in words]
    return np.array(codes, dtype=np.int64), np.concatenate([[0], np.cumsum([len(w) for w in split])])


def confirmed(codes: np.ndarray, offsets: np.ndarray, docs: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(start in codes, smallest document) of each window that more than one document has."""
    begin = np.repeat(offsets[:-1], counts) + np.concatenate([np.arange(c) for c in counts])
    doc = np.repeat(docs, counts)
    h = ranges(prefix(codes), begin, begin + window)
    order = np.lexsort((doc, h))
    h, begin, doc = h[order], begin[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    last = np.append(first[1:], len(h)) - 1
    many = doc[first] < doc[last]
    return begin[first[many]], doc[first[many]]


def located(texts: list[bytes], docs: np.ndarray, patterns: list[tuple[tuple[int, ...], int]], codes: np.ndarray, offsets: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(text, first word, last word + 1) of each stretch that windows of smaller documents cover."""
    import ahocorasick

    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    owners = np.array([doc for _, doc in patterns], dtype=np.int64)
    smallest: dict[tuple[int, ...], int] = {}
    for i, (words, doc) in enumerate(patterns):
        if words not in smallest or doc < owners[smallest[words]]:
            smallest[words] = i
            automaton.add_word(words, i)
    if not smallest:
        return []
    automaton.make_automaton()
    out = []
    for t in range(len(texts)):
        hits = [(end, k) for end, k in automaton.iter(tuple(codes[offsets[t] : offsets[t + 1]].tolist()))]
        stops = np.array([end + 1 for end, k in hits if owners[k] < docs[t]], dtype=np.int64)
        for a, b in zip(*merged(stops - window, stops), strict=True):
            out.append((t, int(a), int(b)))
    return out


def beside(batch: pa.RecordBatch, anchor: int) -> list[int]:
    """The word that each piece's anchor (``fp``) begins at."""
    out: list[int] = []
    fp = batch.column("fp").to_numpy()
    for first, last, data, offsets in slices(batch.column("words")):
        words, rows = word_hashes(data, offsets)
        phrases = mix(windows(prefix(words), anchor)).view(np.int64)
        own = np.repeat(np.arange(first, last), np.diff(rows))[: len(phrases)]
        hits = np.flatnonzero(phrases == fp[own])
        _, leftmost = np.unique(own[hits], return_index=True)
        out += (hits[leftmost] - rows[:-1]).tolist()
    return out


def most_shared(pieces: DataFrame, most: int, then: Callable[[dict, int], dict | None], schema: str) -> DataFrame:
    """What ``then`` makes of each piece and of how many words of ``beside`` it has in common with another piece of its anchor.

    A piece at the edge of a partition, whose neighbour is not seen, counts as having ``most``.
    """
    # a salt parts pieces that are alike, so that a partition holds no whole group
    dealt = pieces.repartitionByRange("fp", "beside", F.xxhash64("row", "start")).sortWithinPartitions("fp", "beside")
    types = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    to = [(name, types[kind]) for name, kind in map(str.split, schema.split(", "))]

    def shared(a: dict, b: dict) -> int:
        return os.path.commonprefix([a["beside"], b["beside"]]).count(b" ") if a["fp"] == b["fp"] else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = None, most
        arrow = pa.schema(to)
        for batch in batches:
            out = []
            for piece in batch.to_pylist():
                after = most if last is None else shared(last, piece)
                if last is not None:
                    out.append(then(last, max(before, after)))
                last, before = piece, after
            yield pa.RecordBatch.from_pylist([x for x in out if x], arrow)
        if last is not None:
            yield pa.RecordBatch.from_pylist([x for x in [then(last, most)] if x], arrow)

    return in_batches(dealt, run, schema)


def trimmed(pieces: DataFrame, window: int, anchor: int) -> DataFrame:
    """(fp, words, first, hi): the different texts that are left of the pieces of each anchor without windows that only one piece has.

    A window reaches so many words to the left of its anchor and the others to the right; a piece that
    has it shares both with another. ``first`` is the first place (doc_id, row, start) and ``hi`` the greatest doc_id.
    """
    around = window - anchor
    place = "fp bigint, doc_id bigint, row bigint, start int, n int, words binary, at int, beside binary"

    def outwards(words: list[bytes]) -> bytes:
        return b"".join(w + b" " for w in words)

    def to_right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = beside(batch, anchor)
            right = [outwards(x.as_py().split(b" ")[k + anchor :]) for k, x in zip(at, batch.column("words"), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32()), pa.array(right, pa.binary())], names=[*batch.schema.names, "at", "beside"])

    def to_left(piece: dict, reach: int) -> dict | None:
        if around - reach > piece["at"]:
            return None
        return {**piece, "beside": outwards(piece["words"].split(b" ")[: piece["at"]][::-1]), "right": reach}

    def part(piece: dict, reach: int) -> dict | None:
        low, high = max(0, piece["at"] - reach), min(piece["n"] - 1, piece["at"] - around + piece["right"])
        if low > high:
            return None
        return {**piece, "start": piece["start"] + low, "words": b" ".join(piece["words"].split(b" ")[low : high + window])}

    sides = in_batches(pieces.select("fp", "doc_id", "row", "start", "n", "words"), to_right, place)
    sides = most_shared(sides, around, to_left, place + ", right int")
    left = most_shared(sides, around, part, "fp bigint, doc_id bigint, row bigint, start int, words binary")
    return left.groupBy("fp", "words").agg(F.min(F.struct("doc_id", "row", "start")).alias("first"), F.max("doc_id").alias("hi"))


def locate(pieces: DataFrame, window: int, anchor: int, hot: int, shard: int) -> DataFrame:
    """Spans of the pieces that recur in a smaller document, from the piece's place ``at``; pieces are read repeatedly."""
    count = pieces.count()
    if not count:
        return pieces.sparkSession.createDataFrame([], HIT)
    common = pieces.where(F.col("kinds") > hot)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                words, rows = word_hashes(data, offsets)
                n = np.diff(rows) - window + 1
                own, step = np.repeat(np.arange(first, last), n), np.concatenate([np.arange(c) for c in n])
                begin = np.repeat(rows[:-1], n) + step
                h = mix(ranges(prefix(words), begin, begin + window)).view(np.int64)
                fp, doc, row, hi = (batch.column(c).take(pa.array(own)) for c in (0, 2, 3, 5))
                start = (batch.column(4).to_numpy()[own] + step).astype(np.int32)
                yield pa.RecordBatch.from_arrays([fp, pa.array(h), doc, row, pa.array(start), hi], names=["fp", "h", "doc_id", "row", "start", "hi"])

    # hot anchors: which windows recur is counted over all tasks; the first of each becomes a pattern
    texts = trimmed(common, window, anchor).select("fp", "words", "first.*", "hi")
    found = in_batches(texts, hashed, "fp bigint, h bigint, doc_id bigint, row bigint, start int, hi bigint")
    recurring = found.groupBy("fp", "h").agg(F.min(F.struct("doc_id", "row", "start")).alias("first"), F.max("hi").alias("hi"))
    recurring = recurring.where("first.doc_id < hi").select("fp", F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row"), F.col("first.start").alias("at"))
    source = common.select("fp", "doc_id", "row", "start", "n", "words", "kinds")
    patterns = recurring.join(source, ["fp", "doc_id", "row"]).where("at >= start and at < start + n")
    salts = F.ceil(F.col("kinds") / hot).cast("int")
    patterns = patterns.select(
        "fp", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "doc_id", "row", F.col("at").alias("start"), F.lit(1).alias("n"),
        F.array_join(F.slice(F.split(F.decode("words", "UTF-8"), " "), F.col("at") - F.col("start") + 1, window), " ").cast("binary").alias("words"), F.lit(1).alias("kind"),
    )
    salt = F.when(F.col("kinds") > hot, F.pmod(F.xxhash64("doc_id", "start"), salts)).otherwise(0).cast("int")
    rows = pieces.select("fp", salt.alias("salt"), "doc_id", "row", "start", "n", "words", F.when(F.col("kinds") > hot, 2).otherwise(0).alias("kind"))
    rows = rows.unionByName(patterns)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("fp", "salt"), F.lit(-(-count // shard))))

    def one_shard(group: pd.DataFrame) -> pd.DataFrame:
        texts, docs, kind = group.words.tolist(), group.doc_id.to_numpy(), group.kind.to_numpy()
        codes, offsets = coded(texts)
        patterns = []
        plain = np.flatnonzero(kind == 0)
        if len(plain):
            n = np.where(kind == 0, group.n.to_numpy(), 0)
            for begin, doc in zip(*confirmed(codes, offsets, docs, n, window), strict=True):
                patterns.append((tuple(codes[begin : begin + window].tolist()), int(doc)))
        for i in np.flatnonzero(kind == 1):
            patterns.append((tuple(codes[offsets[i] : offsets[i + 1]].tolist()), int(docs[i])))
        hits = [x for x in located(texts, docs, patterns, codes, offsets, window) if kind[x[0]] != 1]
        at = np.array([x[0] for x in hits], dtype=np.int64)
        return pd.DataFrame({
            "fp": group.fp.to_numpy()[at], "row": group.row.to_numpy()[at], "at": group.start.to_numpy()[at], "doc_id": docs[at],
            "start": np.array([x[1] for x in hits], dtype=np.int64), "stop": np.array([x[2] for x in hits], dtype=np.int64),
        })

    return in_groups(rows.groupBy("shard"), one_shard, HIT)


def more_places(again: DataFrame, distinct: DataFrame, kinds: DataFrame) -> DataFrame:
    """(fp, row, at, own, to): the other places (own, to) that the first document of a piece has it at, its first being (row, at)."""
    first = distinct.where("places > 1").join(kinds, "fp", "left_semi").select("fp", "ph", "first.row", F.col("first.start").alias("at"), "lo")
    first = first.withColumnRenamed("row", "first_row")
    same = at_places(again, first, lambda of: (of("doc_id") == F.col("lo")) & ((of("row") != F.col("first_row")) | (of("start") != F.col("at"))))
    return same.select("fp", F.col("first_row").alias("row"), "at", F.col("row").alias("own"), F.col("start").alias("to")).distinct()


def looked_up(again: DataFrame, crowded: DataFrame, window: int) -> DataFrame:
    """Spans of the crowded pieces (fp, ph, lo) in documents after the first that has them, merged in each document."""
    pieces = crowded.toPandas()
    held = again.sparkSession.sparkContext.broadcast([pieces[c].to_numpy() for c in ("fp", "ph", "lo")])
    lists = again.where(F.col("crowd") > recurrence.CROWD).groupBy("doc_id", "row").agg(F.collect_set(F.struct("fp", "ph", "start", "n")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp, ph, lo = held.value
        index = pd.MultiIndex.from_arrays([fp, ph])
        for batch in batches:
            of = pc.list_parent_indices(batch.column(2)).to_numpy()
            fp, ph, start, n = (c.to_numpy(zero_copy_only=False) for c in batch.column(2).flatten().flatten())
            at = index.get_indexer(pd.MultiIndex.from_arrays([fp, ph]))
            gone = (at >= 0) & (batch.column(0).to_numpy()[of] > lo[at])
            # each document has a stretch of numbers of its own, so that all are merged at once
            begin = (of[gone].astype(np.int64) << 32) + start[gone]
            begin, end = merged(begin, begin + n[gone] + window - 1)
            own = begin >> 32
            places = [(x - (own << 32)).astype(np.int32) for x in (begin, end)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)), *map(pa.array, places)], names=["doc_id", "row", "start", "stop"])

    return in_batches(lists, run, SPAN)


def copied(again: DataFrame, distinct: DataFrame, window: int) -> DataFrame:
    """Spans of the pieces that a smaller document has word for word."""
    later = distinct.where("lo < hi").select("fp", "ph", "lo", "places")
    crowded = later.where(F.col("places") > recurrence.CROWD).drop("places")
    found = None
    if 0 < crowded.count() <= LOOKED_UP:
        found = looked_up(again, crowded, window)
        again = again.join(F.broadcast(crowded.select("fp", "ph")), ["fp", "ph"], "left_anti")
        later = later.where(F.col("places") <= recurrence.CROWD)
    copies = at_places(again, later.drop("places"), lambda of: of("doc_id") > F.col("lo"))
    whole = copies.select("doc_id", "row", "start", (F.col("start") + F.col("n") + window - 1).cast("int").alias("stop"))
    return whole if found is None else whole.unionByName(found)


def removed_spans(documents: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """(doc_id, row, start, stop): word spans to remove; ``documents`` has doc_id, row and text."""
    documents = documents.where("doc_id is not null")
    found = written(anchors(documents, window, anchor), "anchors")
    again, distinct, kinds = recurring(found, F.col("lo") < F.col("hi"))
    whole = copied(again, distinct, window)
    wanted = distinct.select("fp", "first.*").join(kinds, "fp").select("fp", "kinds", "doc_id", "row", "start", "n")

    def take(text: bytes):
        words = text.split()
        return lambda start, n: b" ".join(words[start : start + n + window - 1])

    more = written(more_places(again, distinct, kinds), "more-places")
    pieces = written(cut(documents, wanted, take), "pieces")
    hits = written(locate(pieces, window, anchor, hot, shard), "hits")
    span = lambda row, at: ["doc_id", F.col(row).alias("row"), *[(F.col(at) + F.col(c)).alias(c) for c in ("start", "stop")]]
    repeats = hits.join(more, ["fp", "row", "at"]).select(*span("own", "to"))
    return whole.unionByName(hits.select(*span("row", "at"))).unionByName(repeats)


def dedup(documents: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """``documents`` with n_words, n_removed, and kept: the kept words joined by one space."""
    made = ["n_words", "n_removed", "kept"]
    own = others(documents, made)
    name = fresh(documents, "spans")
    spans = removed_spans(keyed(documents), window=window, anchor=anchor, hot=hot, shard=shard)
    rows = with_spans(documents.select(*own), spans, name)
    schema = T.StructType([*[documents.schema[c] for c in own], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts, spans = part.column(part.schema.get_field_index("text")), part.column(part.schema.get_field_index(name))
                total, gone, left = [], [], []
                for text, found in zip(texts, spans, strict=True):
                    words = (text.as_py() or "").encode().split()
                    keep = words
                    if found.is_valid:
                        pairs = np.array([(s["start"], s["stop"]) for s in found.as_py()], dtype=np.int64)
                        a, b = merged(pairs[:, 0], pairs[:, 1])
                        edges = [0, *np.column_stack([a, b]).ravel().tolist(), len(words)]
                        keep = [w for i in range(0, len(edges), 2) for w in words[edges[i] : edges[i + 1]]]
                    total.append(len(words))
                    gone.append(len(words) - len(keep))
                    left.append(b" ".join(keep).decode())
                columns = [part.column(part.schema.get_field_index(c)) for c in own]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.string())], names=[*own, *made])

    return in_batches(rows, run, schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(documents).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
