"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into buckets. A query's score bound for a bucket is its length times
the bucket's greatest length; with the k-th best score known so far, theta, that gives a cosine
threshold local to the bucket. Over 1, the whole bucket is skipped. Otherwise a low threshold
prunes by length (vectors too short to reach theta), and a high one by coordinates: for the
query's largest coordinates, a vector with that cosine must lie within an interval. The products of
what is left are verified as integers. No bound drops a vector that could enter the result.

Theta starts as the k-th best score among a bounded sample of vectors (``SAMPLE``), which any
result must reach, and rises inside a bucket.

Components are floor(1024 * x) for x in double precision; lengths and products are exact in double
precision while the sums stay under 2**53, and beyond that are taken in 64-bit integers.

Defined cases: null vectors and vectors with null or non-finite components take no part; zero vectors
do; vectors of another dimension than a query's are no candidates of it; of repeated query ids the
least vector is the query; ties go to the smaller vec_id; repeated rows with one
vec_id are candidates once each, except for a query of that id; buckets with many equal lengths
are split by a salt; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.tables import in_batches, table
from llm.vectors import BLOCK, asked, best, by_dimension, divisible, matrix, meet, sampled, top, usable

SCALE = 1024
SAMPLE = 2048
RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"
COORDINATES = 4
#: From this local cosine on, intervals of coordinates prune more than lengths do.
STEEP = 0.8


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector binary of doubles that hold integers, norm)."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    rows = vectors.select("vec_id", whole.alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 1)
            norm = np.sqrt((x * x).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(norm)], names=["vec_id", "vector", "norm"]
            )

    return in_batches(rows, packed, "vec_id bigint, vector binary, norm double")


def products(data: np.ndarray, one: np.ndarray) -> np.ndarray:
    if np.abs(data).max(initial=0) * np.abs(one).max(initial=0) * len(one) < 2**53:
        return (data @ one).astype(np.int64)
    return data.astype(np.int64) @ one.astype(np.int64)


def candidates(data: np.ndarray, norms: np.ndarray, one: np.ndarray, theta: float) -> np.ndarray:
    """Rows that may reach theta, by length or coordinate bounds with slack for rounding; lengths fall."""
    length = float(np.sqrt(one @ one))
    if theta <= 0 or length == 0:
        return np.arange(len(data))
    long = int(np.searchsorted(-norms, -(theta / length) * (1 - 1e-9), side="right"))
    local = theta / (length * norms[0]) * (1 - 1e-9) if norms[0] else 2.0
    rows = np.arange(long)
    if local < STEEP or not long:
        return rows
    unit = one / length
    for f in np.argsort(-np.abs(unit))[:COORDINATES]:
        local_f = min(1.0, local)
        wide = np.sqrt(max(0.0, (1 - local_f**2) * (1 - unit[f] ** 2))) + 1e-9
        own = data[rows, f] / np.maximum(norms[rows], 1e-300)
        # the cosine of a vector is at least theta over its own length, so at least the local one
        low = unit[f] * local_f - wide if unit[f] > 0 else -1.0
        high = unit[f] * local_f + wide if unit[f] < 0 else 1.0
        rows = rows[(own >= low) & (own <= high)]
    return rows


def search(vectors: DataFrame, queries: DataFrame, *, k: int = 10, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score long): the k highest inner products of each query, itself left out."""
    vectors, queries = usable(vectors, zero=True), asked(usable(queries, zero=True))
    parts = by_dimension(vectors, queries, lambda x, q: _search(integers(x), integers(q), k, sample))
    return reduce(DataFrame.unionByName, parts) if parts else vectors.sparkSession.createDataFrame([], RESULT)


def _search(vectors: DataFrame, queries: DataFrame, k: int, sample: int) -> DataFrame:
    schema = "query_id bigint, vec_id bigint, score bigint"
    count, n_queries = vectors.count(), queries.count()
    if not count or not n_queries:
        return best(vectors.sparkSession.createDataFrame([], schema), k)
    n_buckets = -(-count // BLOCK)
    cuts = sorted(set(vectors.approxQuantile("norm", [i / n_buckets for i in range(1, n_buckets)], 0.001))) if n_buckets > 1 else []
    bucket = sum((F.when(F.col("norm") >= c, 1).otherwise(0) for c in cuts), F.lit(0)) if len(cuts) < 200 else F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("norm")))
    rows = vectors.withColumn("bucket", bucket)
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.max("norm").alias("longest")).orderBy("bucket").collect()
    first, blocks = 0, []  # (bucket, first block, blocks, greatest length)
    for r in sizes:
        own = -(-r.n // BLOCK)
        blocks.append((r.bucket, first, own, r.longest))
        first += own
    start = F.create_map(*[F.lit(x) for b in blocks for x in (b[0], b[1])])[F.col("bucket")]
    spread = F.create_map(*[F.lit(x) for b in blocks for x in (b[0], b[2])])[F.col("bucket")]
    rows = rows.withColumn("block", (start + F.pmod(F.xxhash64("vec_id", F.lit(8)), spread)).cast("bigint"))
    seen = sampled(vectors, sample, count).collect()
    seen_ids = np.array([r.vec_id for r in seen], dtype=np.int64)
    seen_data = np.array([np.frombuffer(r.vector) for r in seen])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for query_id, vector, norm in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                theta = None
                if len(seen_ids):
                    scores = np.sort(products(seen_data, np.frombuffer(vector))[seen_ids != query_id])
                    theta = float(scores[-k]) if len(scores) >= k else None
                for _, begin, n, longest in blocks:
                    if theta is None or norm * longest * (1 + 1e-9) >= theta:
                        out += [(query_id, begin + i, vector, theta) for i in range(n)]
            for at in range(0, len(out), 2048):
                columns = zip(*out[at : at + 2048], strict=True)
                types = [pa.int64(), pa.int64(), pa.binary(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "block", "vector", "theta"])

    def verify(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["norm", "vec_id"], ascending=[False, True])
        ids, norms, data = x.vec_id.to_numpy(), x.norm.to_numpy(), matrix(x.vector, "<f8")
        out = []
        for own, vector, theta in zip(q.query_id, q.vector, q.theta, strict=True):
            one = np.frombuffer(vector)
            rows = candidates(data, norms, one, theta if theta == theta and theta is not None else 0.0)
            scores = products(data[rows], one)
            near = top(scores, ids[rows], own, k)
            keep = near[np.lexsort((ids[rows][near], -scores[near]))][:k]
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[rows][keep], "score": scores[keep]}))
        return pd.concat(out)

    routes = in_batches(queries, routed, "query_id bigint, block bigint, vector binary, theta double")
    return best(meet(rows.select("vec_id", "norm", "vector", "block"), routes, n_queries, schema, verify), k)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return search(embeddings, embeddings.where(divisible("vec_id", 100)), k=10)


#: DuckDB: every query against every row.
ORACLE_SQL = """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM ints q, ints c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""
