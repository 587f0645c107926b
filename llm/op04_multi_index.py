"""Approximate nearest neighbours with an inverted multi-index.

Each half of a vector is quantised by its own ``CENTROIDS`` centroids, so that the pairs of
centroids make a fine grid of cells with few distances to compute. A query sorts the centroids of
each half by distance and walks the pairs in order of the summed distance with a heap (the
multi-sequence algorithm) until the visited cells hold the asked share of all vectors; their
entries are reranked by the exact inner product in double precision.

The centroids are fitted on a sample (``SAMPLE`` vectors by default); every vector is indexed.
Nearness is the largest inner product: as vectors may differ in length, each is given one more
component in its second half, which makes all lengths equal, so that distance and inner product
agree; queries get a zero there.

``VISIT`` is the share of vectors that a query visits. On isotropic vectors, which have hardly any
clusters to find, 0.9 recall takes about 0.35 to 0.45 of the vectors, so the default is 0.6;
clustered vectors need far less.

Defined cases: null, zero or non-finite vectors take no part; vectors of another dimension than a
query's are no candidates of it; of repeated query ids the least vector is the query; ties go to the smaller vec_id; repeated rows with one vec_id are candidates once each, except for a
query of that id; a cell with many equal vectors is split over blocks; an empty table has no rows.
"""

from __future__ import annotations

import heapq
from functools import reduce
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.tables import in_batches, table
from llm.vectors import BLOCK, asked, best, by_dimension, divisible, matrix, meet, sampled, top, usable

CENTROIDS = 32
SAMPLE = 8192
VISIT = 0.6
RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def _dense(array: pa.ListArray) -> np.ndarray:
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(array), -1) if len(array) else flat.reshape(0, 1)


def kmeans(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly spaced rows in the order of their first components."""
    k = max(1, min(k, len(x)))
    order = np.lexsort(x.T[::-1])
    c = x[order[np.linspace(0, len(x) - 1, k).astype(int)]].astype(np.float64)
    for _ in range(rounds):
        own = distances(x, c).argmin(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)


class MultiIndex:
    """Centroids of both halves, how many vectors each cell has, and the block of each cell."""

    def __init__(self, first: np.ndarray, second: np.ndarray, half: int, longest: float) -> None:
        self.first, self.second, self.half, self.longest = first, second, half, longest
        self.counts = np.zeros(len(first) * len(second), dtype=np.int64)

    def halves(self, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        x = x.astype(np.float64)
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.longest - (x * x).sum(axis=1)))
        return x[:, : self.half], np.column_stack([x[:, self.half :], rest])

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x, False)
        return distances(a, self.first).argmin(axis=1) * len(self.second) + distances(b, self.second).argmin(axis=1)

    def set_counts(self, counts: dict[int, int]) -> None:
        """Cells in order fill blocks of about BLOCK; a larger cell is spread over several."""
        for cell, n in counts.items():
            self.counts[cell] = n
        total = int(self.counts.sum())
        size = total / max(1, -(-total // BLOCK))
        before = np.cumsum(self.counts) - self.counts
        self.block = ((before + 0.5) // size).astype(np.int64) if total else before
        last = np.maximum(self.block, ((before + np.maximum(self.counts, 1) - 0.5) // size).astype(np.int64)) if total else before
        self.blocks = last - self.block + 1

    def visited(self, near: np.ndarray, far: np.ndarray, enough: int) -> list[int]:
        """Cells in order of summed distance until they hold ``enough`` vectors."""
        i_order, j_order = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
        a, b = near[i_order].tolist(), far[j_order].tolist()
        out, have, heap, width = [], 0, [(a[0] + b[0], 0, 0)], len(b)
        pushed = {(0, 0)}
        while heap and have < enough:
            _, i, j = heapq.heappop(heap)
            cell = int(i_order[i]) * width + int(j_order[j])
            if self.counts[cell]:
                out.append(cell)
                have += int(self.counts[cell])
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(a) and y < width and (x, y) not in pushed:
                    pushed.add((x, y))
                    heapq.heappush(heap, (a[x] + b[y], x, y))
        return out


def fit(vectors: DataFrame, count: int, centroids: int = CENTROIDS, sample: int = SAMPLE) -> MultiIndex:
    rows = sampled(vectors, sample, count).select("embedding").collect()
    if not rows:
        rows = vectors.select("embedding").limit(1).collect()
    longest = vectors.select(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).first()[0]
    x = np.array([r.embedding for r in rows], dtype=np.float64)
    made = MultiIndex(np.zeros((1, 1)), np.zeros((1, 1)), x.shape[1] // 2, longest * (1 + 1e-12))
    a, b = made.halves(x, False)
    return MultiIndex(kmeans(a, centroids), kmeans(b, centroids), made.half, made.longest)


def search(vectors: DataFrame, queries: DataFrame, *, k: int = 20, visit: float = VISIT, centroids: int = CENTROIDS, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, itself left out."""
    vectors, queries = usable(vectors, zero=False), asked(usable(queries, zero=False))
    parts = by_dimension(vectors, queries, lambda x, q: _search(x, q, k, visit, centroids, sample))
    return reduce(DataFrame.unionByName, parts) if parts else vectors.sparkSession.createDataFrame([], RESULT)


def _search(vectors: DataFrame, queries: DataFrame, k: int, visit: float, centroids: int, sample: int) -> DataFrame:
    schema = "query_id bigint, vec_id bigint, score double"
    stored = "<f4" if "float" in vectors.schema["embedding"].dataType.simpleString() else "<f8"
    count = vectors.count()
    n_queries = queries.count()
    if not count or not n_queries:
        return best(vectors.sparkSession.createDataFrame([], schema), k)
    index = fit(vectors, count, centroids, sample)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _dense(batch.column(1))
            packed = pa.array([r.tobytes() for r in x.astype(stored)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(index.cells(x), pa.int64()), packed], names=["vec_id", "cell", "vector"])

    entries = in_batches(vectors, placed, "vec_id bigint, cell bigint, vector binary")
    index.set_counts({r.cell: r["count"] for r in entries.groupBy("cell").count().collect()})
    enough = max(k + 1, int(np.ceil(visit * count)))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _dense(batch.column(1))
            a, b = index.halves(q, True)
            near, far = distances(a, index.first), distances(b, index.second)
            out: list[tuple] = []
            for i, query_id in enumerate(batch.column(0).to_pylist()):
                by_block: dict[int, list[int]] = {}
                for cell in index.visited(near[i], far[i], enough):
                    for block in range(index.block[cell], index.block[cell] + index.blocks[cell]):
                        by_block.setdefault(block, []).append(cell)
                vector = q[i].astype(stored).tobytes()
                out += [(query_id, block, vector, np.array(cells, dtype="<i8").tobytes()) for block, cells in by_block.items()]
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            for first in range(0, len(out), 4096):
                columns = zip(*out[first : first + 4096], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "block", "vector", "cells"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column(1).to_numpy()
            salt = (batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            block = index.block[cell] + (salt % index.blocks[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=["vec_id", "cell", "vector", "block"])

    def rerank(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["cell", "vec_id"])
        ids, cells = x.vec_id.to_numpy(), x.cell.to_numpy()
        have, first = np.unique(cells, return_index=True)
        stop = np.append(first[1:], len(cells))
        data = matrix(x.vector, stored).astype(np.float64)
        out = []
        for own, vector, packed in zip(q.query_id, q.vector, q.cells, strict=True):
            at = np.searchsorted(have, wanted := np.frombuffer(packed, dtype="<i8"))
            at = np.sort(at[(at < len(have)) & (have[np.minimum(at, len(have) - 1)] == wanted)])
            if not len(at):
                continue
            rows = np.concatenate([np.arange(first[i], stop[i]) for i in at])
            one = np.frombuffer(vector, dtype=stored).astype(np.float64)
            near = rows[top(data[rows] @ one, ids[rows], own, k, 1e-9 * (1 + np.abs(one).sum()))]
            exact = (data[near] * one).sum(axis=1)
            keep = np.lexsort((ids[near], -exact))[:k]
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[near][keep], "score": exact[keep]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    rows = in_batches(entries, dealt, "vec_id bigint, cell bigint, vector binary, block bigint")
    routes = in_batches(queries, routed, "query_id bigint, block bigint, vector binary, cells binary")
    return best(meet(rows, routes, n_queries, schema, rerank), k)


def op4_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return search(embeddings, embeddings.where(divisible("vec_id", 20)), k=20)
