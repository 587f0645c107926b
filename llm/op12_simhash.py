"""Near duplicates by SimHash fingerprints and BK-trees, exact within a Hamming radius.

1. Fingerprints: a bit is 1 if it is set in over half of the XXH64 hashes of a document's word shingles.
2. Equal fingerprints are one node, whatever their number.
3. Shards: 64 bits are cut into ``radius`` + e ranges. Two fingerprints within the radius agree in e of
   them at least, so a fingerprint goes to a shard for each choice of e ranges, with those that have the same bits
   there. e follows the number of fingerprints, so that shards stay small on average; any e gives the same links. Shards
   with over ``PART`` members are cut into parts, each part's tree meeting its own members and those of later parts.
4. In each shard a BK-tree is grown, children keyed by their integer distance to the parent, and its members walk it
   from the root, following only edges within the radius of their own distance. The trees of all shards of a task are
   grown and walked together. A member that is known to be linked with all of a subtree does not walk it, so that dense
   groups cost little. What leaves a shard is a link from each member to the least of its group.
5. Components of these links, over all shards.

All fingerprints against the trees of all would be a quadratic amount of work, and those trees grow with the data; so a tree is
not broadcast to all tasks but goes where the fingerprints are that can have a link with it.

Defined cases: null and empty texts and those without a word have fingerprint zero, linked like any other; texts with fewer
words than a shingle have one shingle; repeated rows are kept; rows with a null doc_id are linked, but no
component is named after them unless all ids of it are null; columns named like an output are replaced; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.components import components, settled
from llm.hashing import LOWER, SPACE, slices, word_spans
from llm.tables import fresh, give_back, in_batches, others, shuffles, table, written

WIDTH, RADIUS, SEED = 4, 4, 42
#: Members that a shard may have on average before one more range is agreed on, and at most before it is cut into parts.
ROOM, PART = 1024, 1 << 18
#: Members whose shards are handled together, members of one wave, and pairs of member and node looked at together.
TOGETHER, WAVE, PAIRS = 1 << 18, 1 << 16, 1 << 17
#: A fingerprint that over one in so many documents has is joined by broadcast; there are at most so many.
SHARE = 256


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of each shingle of ``k`` words joined by one space, offsets of the rows in it)."""
    starts, stops, rows = word_spans(data, offsets)
    at = np.concatenate([[0], np.cumsum(stops - starts + 1)])  # where each word starts when one space follows each
    joined = np.full(at[-1], 0x20, dtype=np.uint8)
    solid = np.ones(at[-1], dtype=bool)
    solid[at[1:] - 1] = False
    joined[solid] = LOWER[data[~SPACE[data]]]
    words = np.diff(rows)
    counts = np.where(words > 0, np.maximum(words - k + 1, 1), 0)
    out = np.concatenate([[0], np.cumsum(counts)])
    first = np.arange(out[-1]) + np.repeat(rows[:-1] - out[:-1], counts)
    last = np.minimum(first + k, np.repeat(rows[1:], counts))
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)
    return np.fromiter((digest(text[a:b], SEED) for a, b in spans), dtype=np.uint64, count=int(out[-1])), out


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each row: the bits that over half of its hashes have."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.array([bits[a:b].sum(axis=0, dtype=np.int64) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]).reshape(-1, 64)
    over = 2 * counts > np.diff(offsets)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(documents: DataFrame, name: str, *, text: str = "text", k: int = WIDTH, with_text: bool = True) -> DataFrame:
    """``documents``, without ``text`` if so asked, with the fingerprint as a signed 64-bit integer."""
    kept = [c for c in documents.columns if with_text or c != text]
    body = fresh(documents, "body")
    rows = documents.select(F.col(text).cast("string").alias(body), *kept)
    schema = T.StructType([*[documents.schema[c] for c in kept], T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [majority(*shingle_hashes(data, offsets, k)) for _, _, data, offsets in slices(batch.column(0))]
            prints = np.concatenate([np.empty(0, dtype=np.uint64), *prints]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(prints)], names=[*kept, name])

    return in_batches(rows, run, schema)


def agreements(count: int, radius: int) -> list[int]:
    """Masks of the bits that a shard agrees on, one for each choice of ranges, as signed 64-bit integers."""
    e = 1
    while e < radius and count / 2 ** (64 * e // (radius + e)) > ROOM:
        e += 1
    cuts = [64 * i // (radius + e) for i in range(radius + e + 1)]
    ranges = [(1 << b) - (1 << a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [m - (1 << 64) if m >> 63 else m for m in (sum(c) for c in combinations(ranges, e))]


def grown(prints: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(parent, distance to it, nodes by level below the roots) of BK-trees; ``root`` is the place of the first of a node's tree."""
    parent, edge = np.full(len(prints), -1), np.zeros(len(prints), dtype=np.int64)
    left = np.flatnonzero(root != np.arange(len(prints)))
    at, levels = root[left], []
    while len(left):
        distance = np.bitwise_count(prints[left] ^ prints[at]).astype(np.int64)
        _, first, same = np.unique(at * 65 + distance, return_index=True, return_inverse=True)
        child = left[first]
        parent[child], edge[child] = at[first], distance[first]
        levels.append(child)
        lower = np.ones(len(left), dtype=bool)
        lower[first] = False
        at, left = child[same][lower], left[lower]
    return parent, edge, levels


def walked(prints: np.ndarray, tree: np.ndarray, asking: np.ndarray, root: np.ndarray, turn: np.ndarray, radius: int) -> np.ndarray:
    """The least member that each member is linked with, over links within its shard.

    ``tree`` marks the members that are nodes, ``root`` is the place of the root that a member starts at, and
    ``asking`` marks those that do, in waves by ``turn``, their number among those of the shard.
    """
    nodes = np.flatnonzero(tree)
    place = np.full(len(prints), -1)
    place[nodes] = np.arange(len(nodes))
    parent, edge, levels = grown(prints[nodes], place[root[nodes]])
    order = np.argsort(parent * 65 + edge, kind="stable")
    keys = (parent * 65 + edge)[order]
    label = np.arange(len(prints))
    wave = np.where(turn > 0, np.floor(np.log2(np.maximum(turn, 1)) / 2).astype(np.int64) + 1, 0)
    waves = [np.flatnonzero(asking & (wave == w)) for w in np.unique(wave[asking])]
    for members in (m[i : i + WAVE] for m in waves for i in range(0, len(m), WAVE)):
        low, high = label[nodes], label[nodes]
        for level in reversed(levels):  # the least and greatest labels of each subtree
            np.minimum.at(low, parent[level], low[level])
            np.maximum.at(high, parent[level], high[level])
        linked, todo = [], [(members, place[root[members]])]
        while todo:
            member, node = todo.pop()
            if len(member) > PAIRS:
                todo.append((member[PAIRS:], node[PAIRS:]))
                member, node = member[:PAIRS], node[:PAIRS]
            new = (low[node] != label[member]) | (high[node] != label[member])
            member, node = member[new], node[new]
            distance = np.bitwise_count(prints[member] ^ prints[nodes[node]]).astype(np.int64)
            near = (distance <= radius) & (member != nodes[node])
            linked.append(np.column_stack([member[near], nodes[node[near]]]))
            begin = np.searchsorted(keys, node * 65 + np.maximum(distance - radius, 0))
            count = np.searchsorted(keys, node * 65 + np.minimum(distance + radius, 64), side="right") - begin
            if total := int(count.sum()):
                step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
                todo.append((np.repeat(member, count), order[np.repeat(begin, count) + step]))
        a, b = np.concatenate(linked).T
        label = settled(label, a, b)
    return label


def shards(nodes: DataFrame, masks: list[int]) -> DataFrame:
    """(agreed, bits, low, high, print, tree, asking) of the members of all shards and parts."""
    agreed = F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(m)) for m in masks])).alias("agreed", "bits")
    members = nodes.select("print", agreed)
    crowded = members.groupBy("agreed", "bits").agg(F.count("*").alias("n")).where(F.col("n") > PART)
    crowded = written(crowded.select("agreed", "bits", F.ceil(F.col("n") / PART).alias("parts")), "crowded")
    if crowded.isEmpty():
        return members.select("agreed", "bits", F.lit(0).alias("low"), F.lit(0).alias("high"), "print", F.lit(True).alias("tree"), F.lit(True).alias("asking"))
    parts = members.join(crowded, ["agreed", "bits"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)).cast("int"))
    parts = parts.withColumn("own", F.pmod(F.xxhash64("print", F.lit(12)), F.col("parts")).cast("int"))
    parts = parts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return parts.select("agreed", "bits", low.alias("low"), high.alias("high"), "print", (low == F.col("own")).alias("tree"), (high == F.col("own")).alias("asking"))


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between the distinct ``print``s of ``nodes`` that connect all within the radius, one a member and shard at most."""
    masks = agreements(nodes.count(), radius)
    shard = ["agreed", "bits", "low", "high"]
    rows = shards(nodes, masks).repartition(shuffles(nodes.sparkSession), *shard).sortWithinPartitions(*shard, F.desc("tree"), "print")

    def together(key: np.ndarray, prints: np.ndarray, tree: np.ndarray, asking: np.ndarray) -> pa.RecordBatch:
        begin = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1])
        sizes = np.diff(np.append(begin, len(prints)))
        root = np.repeat(begin, sizes)
        many = np.repeat((sizes > 1) & tree[begin], sizes)  # a part without nodes, or a single member, has no links
        at = np.flatnonzero(many)
        place = np.cumsum(many) - 1
        before = np.cumsum(asking) - asking
        label = walked(prints[at], tree[at], asking[at], place[root[at]], (before - before[root])[at], radius)
        linked = np.flatnonzero(label != np.arange(len(at)))
        a, b = prints[at[linked]], prints[at[label[linked]]]
        give_back()
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held.append((np.column_stack([c.astype(np.int64) for c in columns[:4]]), columns[4].view(np.uint64), columns[5].astype(bool), columns[6].astype(bool)))
            if sum(len(h[1]) for h in held) < TOGETHER:
                continue
            parts = [np.concatenate(c) for c in zip(*held, strict=True)]
            last = np.flatnonzero((parts[0] != parts[0][-1]).any(axis=1))
            stop = int(last[-1]) + 1 if len(last) else 0  # the last shard may go on
            held = [tuple(p[stop:] for p in parts)]
            if stop:
                yield together(*[p[:stop] for p in parts])
        if held and len(held[0][1]) + len(held) > 1:
            yield together(*[np.concatenate(c) for c in zip(*held, strict=True)])

    return in_batches(rows, run, "a bigint, b bigint")


def near_duplicates(documents: DataFrame, *, text: str = "text", k: int = WIDTH, radius: int = RADIUS, with_text: bool = True) -> DataFrame:
    """``documents``, without ``text`` if so asked, with ``fingerprint`` (16 hex digits) and ``component_id``.

    The component is the least doc_id that can be reached over fingerprints within the radius of each other.
    """
    kept = [c for c in others(documents, ["fingerprint", "component_id"]) if with_text or c != text]
    key = fresh(documents, "print")
    rows = written(fingerprints(documents.select(*dict.fromkeys([*kept, text])), key, text=text, k=k, with_text=text in kept), "fingerprints")
    nodes = rows.groupBy(F.col(key).alias("print")).agg(F.min("doc_id").alias("least"), F.count("*").alias("places"))
    nodes = written(nodes, "nodes")
    label = components(links(nodes.select("print"), radius), "prints")
    rooted = nodes.join(label.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("label", "print"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    mapped = written(rooted.join(least, "root").select(F.col("print").alias(key), "component_id", "places"), "mapped")
    of = fresh(rows, "of")
    hot = mapped.where(F.col("places") * SHARE > rows.count()).select(key, F.struct("component_id").alias(of))
    rows = rows.join(F.broadcast(hot), key, "left")  # at most SHARE rows
    done = rows.where(F.col(of).isNotNull()).withColumn("component_id", F.col(of)["component_id"])
    rest = rows.where(F.col(of).isNull()).join(mapped.select(key, "component_id"), key)
    digits = F.lower(F.lpad(F.hex(key), 16, "0")).alias("fingerprint")
    return done.select(*kept, digits, "component_id").unionByName(rest.select(*kept, digits, "component_id"))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(documents, with_text=False)
