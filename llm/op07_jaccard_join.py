"""Exact Jaccard join of word n-gram sets in their metric space, up to connected components.

The distance 1 - |x & y| / |x | y| is a metric, so with a pivot p two documents within e of each
other differ by at most e in their distance to p, and documents far from a pivot cannot be near
ones close to it. Between unrelated texts all distances are about 1, so pivots picked at random
tell nothing; here every pivot comes with documents that may be near it.

1. Classes: documents with one set are one node, whatever their number.
2. Regions: in a fixed order of all shingles, two linked sets share one of their first
   n - ceil(t n) + 1 shingles (their sketches), and their sizes lie in one band or in neighbouring
   ones. For each such shingle and band, the class of least hash is the pivot for all that have
   it: a linked pair lies in a common pivot's region. Common shingles, all of which are
   counted in all documents, come last in the order; this affects speed only.
3. A sketch holds all of a set's shingles up to its last one, so two sketches give a lower bound
   of the distance. Documents that may be near their pivot join it; the others are compared with all
   of their region, boundary documents being replicated to each block of a large region. Clusters
   are the components of "may be linked", so that every link lies within a cluster.
4. Clusters join exactly on whole sets, each set going to one region: distances to a first
   pivot give the windows, and a document already known to be in the main component is
   not compared again. Large clusters are cut into shells by that distance, and documents that the
   pivot does not link are replicated to the shells within their window.

Nothing is capped. No cell holds more than about ``OPEN_BLOCK`` members and as many queries in step 3, where only
sketches meet, and ``BLOCK`` of each in step 4.

Defined cases: words are runs of characters other than \\x20 and \\x09-\\x0D, A-Z lower-cased; a text of
under ``k`` words has its whole sequence as its one shingle; a null or empty text has none and is
linked with nothing; its component is itself. Rows that share a doc_id are nodes of their own with
that doc_id; a null doc_id takes part, but names no component unless nothing else does. An
empty table has no rows; columns named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.components import components
from llm.hashing import LOWER, mix, prefix, ranges, slices, windows, word_hashes
from llm.tables import drop, fresh, in_batches, in_groups, others, table, written

K = 4
PERCENT = 85
BLOCK = 420
OPEN_BLOCK = 640
SHARD = 400
FEW = 1_000_000
PARTS = 3
COMMON = 24
COMMON_MOST = 1_000_000
LAST = np.uint64(1 << 62)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int, common: np.ndarray, part: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles of each row in the fixed order, offsets by row); of one of ``PARTS`` equal ranges of hashes, if ``part`` is given."""
    words, rows = word_hashes(LOWER[data], offsets)
    n = np.diff(rows)
    sums = prefix(words)
    at = np.repeat(np.arange(len(n)), n)
    full = np.flatnonzero(rows[1:][at] - np.arange(len(words)) >= k)
    short = np.flatnonzero((n > 0) & (n < k))
    g = np.concatenate([windows(sums, k)[full], ranges(sums, rows[short], rows[short + 1])])
    own = np.concatenate([at[full], short])
    g = mix(g) >> np.uint64(2)
    if part is not None:
        inside = (g >= np.uint64((1 << 62) * part // PARTS)) & (g < np.uint64((1 << 62) * (part + 1) // PARTS))
        g, own = g[inside], own[inside]
    if len(common):
        i = np.minimum(np.searchsorted(common, g), len(common) - 1)
        g = g | np.where(common[i] == g, LAST, np.uint64(0))
    order = np.lexsort((g, own))
    g, own = g[order], own[order]
    keep = np.ones(len(g), dtype=bool)
    keep[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
    return g[keep], np.concatenate([[0], np.cumsum(np.bincount(own[keep], minlength=len(n)))]).astype(np.int64)


def sketch_size(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - -(-n * percent // 100) + 1, 0)


def shingles_of(documents: DataFrame, k: int, part: int) -> DataFrame:
    """(row, g): the shingles of every document in one part of the hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for first, last, data, offsets in slices(batch.column(1)):
                g, at = shingles(data, offsets, k, np.empty(0, dtype=np.uint64), part)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rows[first:last], np.diff(at))), pa.array(g.view(np.int64))], names=["row", "g"])

    return in_batches(documents.select("row", "text"), run, "row bigint, g bigint")


def common_of(documents: DataFrame, k: int, part: int) -> DataFrame:
    """(g): the shingles in one part of the hashes that ``COMMON`` documents or more have, counted in all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shingles(data, offsets, k, np.empty(0, dtype=np.uint64), part)[0] for _, _, data, offsets in slices(batch.column(0))]
            found, times = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times.astype(np.int32))], names=["g", "times"])

    counts = in_batches(documents.select("text"), run, "g bigint, times int").groupBy("g").agg(F.sum("times").alias("times"))
    return counts.where(F.col("times") >= COMMON).select("g")


def common_shingles(documents: DataFrame, k: int, parts: Sequence[int] = (0,)) -> np.ndarray | list[DataFrame]:
    """All shingles of the given parts that ``COMMON`` documents or more have, sorted; over ``COMMON_MOST``, a table for each part.

    Parts are counted one after the other, so that the shuffle of only one is on disk at a time.
    """
    found = [written(common_of(documents, k, part), "common") for part in parts]
    if sum(f.count() for f in found) > COMMON_MOST:
        return found
    common = np.sort(np.concatenate([f.toPandas().g.to_numpy(dtype=np.int64) for f in found]).view(np.uint64))
    for f in found:
        drop(f)
    return common


def with_common(documents: DataFrame, k: int, common: list[DataFrame]) -> DataFrame:
    """``documents`` with ``common``, the list of the common shingles that each has, by a join for each part."""
    held = [written(shingles_of(documents, k, part).join(c, "g"), "held") for part, c in enumerate(common)]
    lists = reduce(DataFrame.unionByName, held).groupBy("row").agg(F.collect_set("g").alias("common"))
    return documents.join(lists, "row", "left").select(*documents.columns, "common")


def sketches(documents: DataFrame, k: int, percent: int, common: np.ndarray | list[DataFrame]) -> DataFrame:
    """(doc_id, row, n, node, sketch, short): node is a hash of the whole set, null if it is empty.

    ``short`` holds the sketch's distinct upper halves, in order. Two sets differ in at least as many
    shingles as upper halves, so bounds from these hold for the sets.
    """
    schema = "doc_id bigint, row bigint, n bigint, node bigint, sketch array<bigint>, short array<int>"
    joined = isinstance(common, list)
    flags = None if joined else common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(2)):
                # what is common for one document is so for all: the lists of these rows hold all that they need
                known = np.unique(batch.column(3).slice(first, last - first).flatten().to_numpy()).view(np.uint64) if joined else flags
                g, at = shingles(data, offsets, k, known)
                n = np.diff(at)
                node = mix(ranges(prefix(g), at[:-1], at[1:]) + n.astype(np.uint64)).view(np.int64)
                size = sketch_size(n, percent)
                rank = np.arange(len(g)) - np.repeat(at[:-1], n)
                own = g[rank < np.repeat(size, n)].view(np.int64)
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(own))
                half = (own >> 32).astype(np.int32)
                keep = np.ones(len(half), dtype=bool)
                keep[1:] = half[1:] != half[:-1]
                keep[ends[:-1][size > 0]] = True
                kept = np.concatenate([[0], np.cumsum(keep)])[ends].astype(np.int32)
                short = pa.ListArray.from_arrays(pa.array(kept), pa.array(half[keep]))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), pa.array(node, mask=n == 0), lists, short], names=["doc_id", "row", "n", "node", "sketch", "short"])

    return in_batches(with_common(documents, k, common) if joined else documents, run, schema)


class Groups:
    """Union-find over positions 0..n-1 that also knows the largest group."""

    def __init__(self, n: int) -> None:
        self.root, self.size, self.largest = np.arange(n), np.ones(n, dtype=np.int64), 0

    def join(self, a: int, others: np.ndarray) -> list[int]:
        """Put ``others`` into a's group; those that were not in it yet, one for each group."""
        new = []
        for r in np.unique(self.root[others]):
            if r != self.root[a]:
                own, target = self.root == r, self.root[a]
                new.append(int(others[self.root[others] == r][0]))
                self.root[own] = target
                self.size[target] += self.size[r]
        if self.size[self.root[a]] >= self.size[self.root[self.largest]]:
            self.largest = a
        return new


def shared_counts(query: np.ndarray, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the sorted ``query`` are in each list of ``flat``."""
    i = np.minimum(np.searchsorted(query, flat), len(query) - 1)
    hit = np.concatenate([[0], np.cumsum(query[i] == flat)])
    return hit[at[1:]] - hit[at[:-1]]


def may_link(q: int, n: np.ndarray, flat: np.ndarray, at: np.ndarray, last: np.ndarray, percent: int) -> np.ndarray:
    """Whether sketches leave it open that query q and each list are linked.

    Under the smaller of two sketches' last values both are complete, and the sets differ in what
    they do not share there.
    """
    own = flat[at[q] : at[q + 1]]
    edge = np.minimum(last, own[-1])
    known = flat < np.repeat(edge, np.diff(at))
    i = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    sums = np.concatenate([[[0], [0]], np.cumsum([known, known & (own[i] == flat)], axis=1)], axis=1)
    under, both = sums[:, at[1:]] - sums[:, at[:-1]]
    differ = np.maximum(np.searchsorted(own, edge) + under - 2 * both, np.abs(n - n[q]))
    return (100 + percent) * differ <= (100 - percent) * (n + n[q])


def blocks(members: DataFrame, block: int) -> DataFrame:
    """Members (region, node, query, size, queries) dealt to (region, b, u) with a role: 1 member, 2 query, 3 both."""
    nb, nu = F.ceil(F.col("size") / block).cast("int"), F.ceil(F.col("queries") / block).cast("int")
    b, u = F.pmod(F.hash("node"), nb), F.pmod(F.hash("node", F.lit(1)), nu)
    one = (nb == 1) & (nu == 1)
    cells = F.when(one, F.array(F.struct(F.lit(0).alias("b"), F.lit(0).alias("u"), F.when(F.col("query"), 3).otherwise(1).alias("role")))).otherwise(
        F.concat(
            F.transform(F.sequence(F.lit(0), nu - 1), lambda x: F.struct(b.alias("b"), x.alias("u"), F.lit(1).alias("role"))),
            F.when(F.col("query"), F.transform(F.sequence(F.lit(0), nb - 1), lambda x: F.struct(x.alias("b"), u.alias("u"), F.lit(2).alias("role")))).otherwise(F.array()),
        )
    )
    return members.select("region", "node", F.explode(cells).alias("cell")).select("region", "node", "cell.*")


def open_links(regions: DataFrame, classes: DataFrame, percent: int, block: int, shard: int) -> DataFrame:
    """Edges (a, b), spanning all pairs of a query and a member that sketches leave open."""
    dealt = blocks(regions, block).join(classes.select("node", "n", "short"), "node")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("region", "b", "u"), F.lit(shard)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in group.groupby(["region", "b", "u"], sort=False):
            roles = own.role.to_numpy()
            if len(own) < 2:
                continue
            nodes, n = own.node.to_numpy(), own.n.to_numpy()
            lists = own.short.tolist()
            at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            flat = np.concatenate(lists)
            last = flat[at[1:] - 1]
            groups = Groups(len(own))
            for q in np.flatnonzero(roles >= 2):
                near = np.flatnonzero(may_link(q, n, flat, at, last, percent) & ((roles & 1) > 0))
                out += [(nodes[q], nodes[x]) for x in groups.join(int(q), near) if nodes[x] != nodes[q]]
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return in_groups(dealt.groupBy("shard"), run, "a bigint, b bigint")


def clusters_of(classes: DataFrame, percent: int, open_block: int) -> DataFrame:
    """(node, label) of the components of "may be linked"."""
    spread = max(1, classes.count() // SHARD)
    tokens = classes.select("node", "n", F.explode("sketch").alias("g"))
    shared = tokens.groupBy("g").agg(F.count("*").alias("times")).where("times > 1").select("g")
    # linked sets differ in size by less than a band, so those of a band and the next meet in its upper band
    band = F.floor(F.log(F.col("n").cast("double")) / (np.log(100 / percent) * (1 + 1e-9))).cast("int")
    placed = tokens.join(shared, "g").select("node", "g", band.alias("low")).select("node", "g", F.explode(F.array("low", F.col("low") + 1)).alias("band"))
    placed = written(placed, "placed")
    pivots = placed.groupBy("g", "band").agg(F.count("*").alias("times"), F.min("node").alias("pivot")).where("times > 1").select("g", "band", "pivot")
    star = placed.join(pivots, ["g", "band"]).where("node <> pivot").select("node", "pivot").distinct()
    own = star.join(classes.select("node", "n", "short"), "node")
    other = classes.select(F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("short").alias("ps"))
    pairs = own.join(other, "pivot").withColumn("edge", F.least(F.element_at("short", -1), F.element_at("ps", -1)))
    under = lambda c: F.size(F.filter(c, lambda x: x < F.col("edge")))
    differ = F.greatest(under("short") + under("ps") - 2 * under(F.array_intersect("short", "ps")), F.abs(F.col("n") - F.col("pn")))
    star = written(pairs.select("node", "pivot", ((100 + percent) * differ <= (100 - percent) * (F.col("n") + F.col("pn"))).alias("near")), "stars")
    sizes = star.groupBy("pivot").agg(F.count("*").alias("size"), F.count(F.when(~F.col("near"), 1)).alias("queries")).where("queries > 0 and size > 1")
    regions = star.join(sizes, "pivot").select(F.col("pivot").alias("region"), "node", (~F.col("near")).alias("query"), "size", "queries")
    edges = star.where("near").select(F.col("node").alias("a"), F.col("pivot").alias("b")).unionByName(open_links(regions, classes, percent, open_block, spread))
    return components(edges, "clusters")


def whole_sets(documents: DataFrame, places: DataFrame, k: int, few: int = 0) -> DataFrame:
    """``places`` (row, node, and a list ``cells`` of structs) as one line per cell with the document's set.

    Up to ``few`` places, their rows are broadcast, so that only their texts are shuffled.
    """
    cell = places.schema["cells"].dataType.elementType
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("cell", cell), T.StructField("set", T.BinaryType())])
    rows = documents.select("row", "text")
    if few and places.count() <= few:
        rows = rows.join(F.broadcast(places.select("row").distinct()), "row", "left_semi")
    rows = rows.join(places, "row").select("node", "cells", "text")
    none = np.empty(0, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()  # repeated rows lie in one task, and count once
        for batch in batches:
            nodes = batch.column(0).to_pylist()
            for first, last, data, offsets in slices(batch.column(2), 1 << 19):
                g, at = shingles(data, offsets, k, none)
                for i in range(first, last):
                    if nodes[i] in done:
                        continue
                    done.add(nodes[i])
                    cells = batch.column(1)[i].values
                    packed = g[at[i - first] : at[i - first + 1]].tobytes()
                    for c in range(0, len(cells), 256):
                        part = cells.slice(c, 256)
                        yield pa.RecordBatch.from_arrays([pa.array([nodes[i]] * len(part), pa.int64()), part, pa.array([packed] * len(part), pa.binary())], names=["node", "cell", "set"])

    return in_batches(rows, run, schema)


def linked(inter: np.ndarray, n: np.ndarray, m: int, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (n + m - inter)


def join_region(nodes: np.ndarray, roles: np.ndarray, sets: list[np.ndarray], away: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Spanning links of all pairs of a query and a member; ``away`` are distances to a common pivot."""
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    flat, n = np.concatenate(sets), np.diff(at)
    within = (100 - percent) / 100 + 1e-9
    groups, out, member = Groups(len(sets)), [], (roles & 1) > 0
    waiting = np.flatnonzero(roles >= 2).tolist()
    full = bool(member.all()) and bool((roles >= 2).all())
    while waiting:
        q = waiting.pop(0)
        if full and groups.size[groups.root[q]] > 1 and groups.root[q] == groups.root[groups.largest]:
            # of two linked documents in different groups, at least one is outside the largest and gets its turn
            if all(groups.root[w] == groups.root[q] for w in waiting):
                break
            others = [w for w in waiting if groups.root[w] != groups.root[q]]
            waiting = [w for w in waiting if groups.root[w] == groups.root[q]]
            waiting = [*others, q, *waiting]
            q = waiting.pop(0)
        inter = shared_counts(sets[q], flat, at)
        if away is None:
            away = 1 - inter / (n + n[q] - inter)
        near = np.flatnonzero(linked(inter, n, n[q], percent) & member & (np.abs(away - away[q]) <= within))
        out += [(int(nodes[q]), int(nodes[x])) for x in groups.join(int(q), near) if nodes[x] != nodes[q]]
    return out


def exact_links(documents: DataFrame, classes: DataFrame, clusters: DataFrame, k: int, percent: int, block: int) -> DataFrame:
    """Spanning links (a, b) of every cluster."""
    sizes = clusters.groupBy("label").agg(F.count("*").alias("size"))
    members = written(clusters.join(sizes, "label").join(classes.select("node", "row"), "node"), "members")
    shard = F.pmod(F.xxhash64("cell.region", "cell.b", "cell.u"), F.lit(max(1, members.count() // SHARD)))
    cell = "struct<region:bigint,b:int,u:int,role:int,away:double>"
    lone = F.lit(None).cast("double")

    def place(region: str, b, u, role, away=lone):  # noqa: ANN001
        return F.struct(F.col(region).alias("region"), b.cast("int").alias("b"), u.cast("int").alias("u"), role.cast("int").alias("role"), away.alias("away")).cast(cell)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        cells = pd.DataFrame(group.cell.tolist())
        cells["node"], cells["set"] = group.node.to_numpy(), group["set"].to_numpy()
        for _, own in cells.groupby(["region", "b", "u"], sort=False):
            if len(own) > 1:
                away = None if own.away.isna().any() else own.away.to_numpy()
                out += join_region(own.node.to_numpy(), own.role.to_numpy(), [np.frombuffer(s, dtype=np.uint64) for s in own["set"]], away, percent)
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    def to_pivot(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        cells = pd.DataFrame(group.cell.tolist())
        cells["node"], cells["set"] = group.node.to_numpy(), group["set"].to_numpy()
        for (region, _, _), own in cells.groupby(["region", "b", "u"], sort=False):
            sets = [np.frombuffer(s, dtype=np.uint64) for s in own["set"]]
            at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            p = int(np.flatnonzero(own.role.to_numpy() == 2)[0])
            inter, n = shared_counts(sets[p], np.concatenate(sets), at), np.diff(at)
            keep = np.flatnonzero(own.role.to_numpy() == 1)
            out.append(pd.DataFrame({"label": region, "node": own.node.to_numpy()[keep], "away": (1 - inter / (n + n[p] - inter))[keep], "linked": linked(inter, n, n[p], percent)[keep]}))
        return pd.concat(out)

    one = members.where(F.col("size") <= block).select("row", "node", F.array(place("label", F.lit(0), F.lit(0), F.lit(3))).alias("cells"))
    small = in_groups(whole_sets(documents, one, k, FEW).withColumn("shard", shard).groupBy("shard"), run, "a bigint, b bigint")
    large = members.where(F.col("size") > block)
    if large.isEmpty():
        return small
    nb = F.ceil(F.col("size") / block).cast("int")
    pivot = F.col("node") == F.col("label")
    star = large.select("row", "node", F.when(pivot, F.transform(F.sequence(F.lit(0), nb - 1), lambda b: place("label", b, F.lit(0), F.lit(2)))).otherwise(F.array(place("label", F.pmod(F.hash("node"), nb), F.lit(0), F.lit(1)))).alias("cells"))
    dealt = whole_sets(documents, star, k, FEW).withColumn("shard", F.xxhash64("cell.region", "cell.b"))
    away = written(in_groups(dealt.groupBy("shard"), to_pivot, "label bigint, node bigint, away double, linked boolean"), "away")
    # shells as wide as the window: a document that the pivot does not link meets its own shell and the two beside it
    within = (100 - percent) / 100 + 1e-9
    ring = F.floor(F.col("away") / within)
    counts = away.groupBy("label", ring.alias("ring")).agg(F.count("*").alias("size"), F.count(F.when(~F.col("linked"), 1)).alias("queries"))
    rings = away.withColumn("ring", ring).join(counts, ["label", "ring"]).join(large.select("node", "row"), "node")
    asked = counts.groupBy("label").agg(F.collect_list(F.struct("ring", "size", "queries")).alias("all"))  # at most 1 / within rings
    rings = rings.join(asked, "label")
    nu = lambda r: F.ceil(r.queries / block).cast("int")
    parts = lambda r: F.ceil(r.size / block).cast("int")
    code = lambda ring, part: (ring * 1_000_000 + part).cast("int")
    mine = code(F.col("ring"), F.pmod(F.hash("node"), F.ceil(F.col("size") / block).cast("int")))
    own_u = code(F.col("ring"), F.pmod(F.hash("node", F.lit(1)), F.greatest(F.lit(1), F.ceil(F.col("queries") / block).cast("int"))))
    close = F.filter("all", lambda r: F.abs(r.ring - F.col("ring")) <= 1)
    as_member = F.flatten(F.transform(F.filter(close, lambda r: r.queries > 0), lambda r: F.transform(F.sequence(F.lit(0), nu(r) - 1), lambda u: place("label", mine, code(r.ring, u), F.lit(1), F.col("away")))))
    as_query = F.flatten(F.transform(close, lambda r: F.transform(F.sequence(F.lit(0), parts(r) - 1), lambda b: place("label", code(r.ring, b), own_u, F.lit(2), F.col("away")))))
    cells = F.concat(as_member, F.when(~F.col("linked"), as_query).otherwise(F.array().cast(f"array<{cell}>")))
    asked_for = rings.select("row", "node", cells.alias("cells")).where(F.size("cells") > 0)
    met = whole_sets(documents, asked_for, k, FEW).withColumn("shard", F.xxhash64("cell.region", "cell.b", "cell.u"))
    across = in_groups(met.groupBy("shard"), run, "a bigint, b bigint")
    stars = away.where("linked").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return small.unionByName(stars).unionByName(across)


def join(documents: DataFrame, *, k: int = K, percent: int = PERCENT, block: int = BLOCK, open_block: int = OPEN_BLOCK, distinct: bool = False) -> DataFrame:
    """``documents`` with n_shingles and component_id, the smallest doc_id reachable by links.

    ``distinct``: of rows that repeat both doc_id and text, one is returned.
    """
    made = ["n_shingles", "component_id"]
    own, key = others(documents, made), fresh(documents, "row")
    body = F.coalesce(F.col("text"), F.lit(""))
    row = F.xxhash64(F.col("doc_id").cast("bigint"), body)
    keyed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), row.alias("row"), body.alias("text"))
    found = written(sketches(keyed, k, percent, common_shingles(keyed, k, range(PARTS))), "sketches")
    sets = written(found.select("doc_id", "row", "n", "node"), "sets")
    classes = found.where("node is not null").groupBy("node").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("short").alias("short")
    )
    classes = written(classes, "classes")
    drop(found)
    clusters = clusters_of(classes, percent, open_block)
    links = components(written(exact_links(keyed, classes, clusters, k, percent, block), "links"), "linked")
    labelled = classes.select("node", "doc_id").join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = labelled.join(first, "label").select("node", "component_id")
    found = sets.select("doc_id", "row", "n", "node").dropDuplicates(["row"]).join(named, "node", "left")
    found = found.select(F.col("row").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    out = documents.select(*own).withColumn(key, row).join(found, key)
    return (out.dropDuplicates([key]) if distinct else out).select(*own, "n_shingles", "component_id")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return join(documents).select("doc_id", "n_shingles", "component_id")
