"""Best-fit packing of tokenised documents into sequences, after dominance reduction.

Only how many pieces have each length matters to the packing, and lengths are at most the
capacity; so the plan is made on that histogram (at most ``capacity`` rows reach the driver,
whatever the input) and then dealt to the pieces by rank within their length.

The reduction is Martello and Toth's: for a piece, a small set that holds it and dominates every
other set that could share its sequence is fixed for good and taken out, the longest pieces first.
Dominance used here, for a piece j and the longest piece a that fits beside it:
- nothing fits beside j: {j};
- j and a fill the sequence exactly: {j, a};
- no two pieces fit beside j, or no three do and the best two are together no longer than a: {j, a}.
What is left is packed by best fit in order of decreasing length. Runs of equal steps are taken
at once, so the time depends on the number of distinct lengths and not on the number of pieces.

Defined cases: a null text is an empty document, whose only id is the separator; documents longer
than the capacity are cut into capacity-long pieces, the last of which may be shorter; equal
lengths are dealt in the order of (salt, doc_id, piece); repeated rows with one doc_id are packed
once each; no documents: no rows. Columns named like the outputs are replaced.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.hashing import slices
from llm.tables import in_batches, others, shuffles, table, written
from llm.vocab import encoder, public_path

CAPACITY = 2048
RUN = 1 << 16
SEPARATOR = (0).to_bytes(4, "little")


def pieces_of(documents: DataFrame, path: str, capacity: int = CAPACITY, *, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's ids and its separator."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for first, last, _, _ in slices(batch.column(1)):
                part, rows = batch.slice(first, last - first), []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder(path, False).encode(part.column(1)), strict=True):
                    ids += SEPARATOR
                    for k, at in enumerate(range(0, len(ids), step)):
                        own = ids[at : at + step]
                        rows.append((doc_id, k, at // 4, len(own) // 4, zlib.crc32(own), own))
                columns = list(zip(*rows, strict=True))[: len(names)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names)

    return in_batches(documents.select(F.col("doc_id").cast("bigint"), "text"), run, schema)


def reduce_histogram(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, tuple[int, ...]]], dict[int, int]]:
    """(how often, lengths) of the fixed sets, and the counts that are left."""
    left = Counter({k: v for k, v in counts.items() if v > 0})
    lengths = sorted(left)
    fixed: list[tuple[int, tuple[int, ...]]] = []

    def drop(x: int, n: int) -> None:
        left[x] -= n
        if not left[x]:
            del left[x]
            lengths.remove(x)

    for j in sorted(left, reverse=True):
        while left[j]:
            room = capacity - j
            at = bisect_right(lengths, room) - 1
            if at >= 0 and lengths[at] == j and left[j] == 1:
                at -= 1  # the only piece of its length cannot stand beside itself
            if at < 0:
                fixed.append((left[j], (j,)))
                drop(j, left[j])
                break
            a = lengths[at]  # the longest that fits beside j, be it longer or shorter than j
            if j + a != capacity and (_three_fit(lengths, left, room, j) or _best_pair(lengths, left, room, j) > a):
                break
            n = left[j] // 2 if a == j else min(left[j], left[a])
            fixed.append((n, (j, a)))
            drop(j, n)
            drop(a, n)
    return fixed, dict(left)


def _three_fit(lengths: list[int], left: Counter, room: int, j: int) -> bool:
    """Whether the three shortest pieces beside one of length j come to at most ``room``."""
    need = 3
    for x in lengths:
        n = min(need, left[x] - (x == j))
        need, room = need - n, room - n * x
        if not need or room < 0:
            break
    return not need and room >= 0


def _best_pair(lengths: list[int], left: Counter, room: int, j: int) -> int:
    """The greatest sum, up to ``room``, of two pieces beside one of length j; 0 if no two fit."""
    low, high, best = 0, bisect_right(lengths, room) - 1, 0
    have = lambda x: left[x] - (x == j)
    while low <= high:
        x, y = lengths[low], lengths[high]
        enough = have(x) >= 2 if x == y else have(x) and have(y)
        if x + y > room:
            high -= 1
        elif not enough:
            low, high = (low + 1, high) if low < high and not have(x) else (low + (low == high), high - (low < high))
        else:
            best = max(best, x + y)
            low += 1
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(how often, lengths) by best fit in decreasing order; open sequences are kept by the room left."""
    opened: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, n: int, lengths: tuple[int, ...]) -> None:
        if not opened[room]:
            insort(rooms, room)
        opened[room].append((n, lengths))

    for x in sorted(counts, reverse=True):
        c = counts[x]
        while c:
            at = bisect_right(rooms, x - 1)
            if at < len(rooms):
                room = rooms[at]
                n, lengths = opened[room].pop()
                if not opened[room]:
                    rooms.pop(at)
                m = min(n, c)
                if n > m:
                    put(room, n - m, lengths)
                put(room - x, m, (*lengths, x))
                c -= m
            else:
                each = capacity // x
                if full := c // each:
                    put(capacity - each * x, full, (x,) * each)
                if c % each:
                    put(capacity - c % each * x, 1, (x,) * (c % each))
                c = 0
    return [p for room in sorted(opened) for p in opened[room]]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    fixed, left = reduce_histogram(counts, capacity)
    return fixed + best_fit(left, capacity)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset. They are read several times: pass a written table."""
    spark = pieces.sparkSession
    salts = shuffles(spark)
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, used, sequence = [], Counter(), 0
    for n, lengths in plan(counts, capacity):
        offset = 0
        for x in lengths:
            slots += [(x, used[x] + k, min(RUN, n - k), sequence + k, offset) for k in range(0, n, RUN)]
            used[x] += n
            offset += x
        sequence += n
    made = spark.createDataFrame(slots, "length bigint, first bigint, n bigint, sequence bigint, offset bigint")
    rank = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("k")
    slot = made.repartition(max(1, min(salts, len(slots)))).select("length", "first", "sequence", "offset", rank).select(
        "length", (F.col("first") + F.col("k")).alias("rank"), (F.col("sequence") + F.col("k")).alias("sequence_id"), "offset"
    )
    kept = others(pieces, ["sequence_id", "offset", "salt", "rank", "before", "at"])
    salted = pieces.select(*kept, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).alias("salt"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("at", F.row_number().over(within) - 1).join(sizes, ["length", "salt"])
    ranked = ranked.select(*kept, (F.col("before") + F.col("at")).alias("rank"))
    return ranked.join(slot, ["length", "rank"]).select(*kept, "sequence_id", "offset")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    pieces = written(pieces_of(documents, public_path("word_bpe_49k.json")), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
