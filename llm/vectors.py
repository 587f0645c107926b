"""What the two vector searches share: usable vectors, dealing blocks, and keeping the best k.

Rows are dealt in blocks of about ``BLOCK`` vectors, and queries in blocks of ``QUERIES``; a pair
of blocks meets in one task, which multiplies matrices and returns at most k rows per query. No
row per pair of vectors is made, and no vector is collected but a bounded sample.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import give_back

BLOCK = 8192
QUERIES = 4096


def usable(vectors: DataFrame, *, zero: bool) -> DataFrame:
    """(vec_id, embedding) without null vectors, ids, null or non-finite components; zero vectors stay only if ``zero``."""
    rows = vectors.select(F.col("vec_id").cast("bigint"), "embedding").where("vec_id is not null and embedding is not null and size(embedding) > 0")
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(good, F.lit(False)))
    if not zero:
        rows = rows.where(F.exists("embedding", lambda x: x != 0))
    return rows


def asked(queries: DataFrame) -> DataFrame:
    """Each query id once: of rows that repeat an id, the least vector is the query."""
    return queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def by_dimension(vectors: DataFrame, queries: DataFrame, work: Callable[[DataFrame, DataFrame], DataFrame]) -> list[DataFrame]:
    """``work`` for the vectors and queries of each dimension that queries have: others have no product."""
    sizes = sorted(r.d for r in queries.select(F.size("embedding").alias("d")).distinct().collect())
    return [work(vectors.where(F.size("embedding") == d), queries.where(F.size("embedding") == d)) for d in sizes]


def sampled(rows: DataFrame, limit: int, count: int) -> DataFrame:
    """About ``limit`` of the rows, by a hash of the id."""
    return rows.where(F.pmod(F.xxhash64("vec_id", F.lit(4)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, limit / max(1, count))))


def matrix(column: pd.Series, dtype: str) -> np.ndarray:
    data = np.frombuffer(b"".join(column), dtype=dtype)
    return data.reshape(len(column), -1)


def meet(rows: DataFrame, queries: DataFrame, n_queries: int, schema: str, work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """``work(rows, queries)`` for every block of rows and block of queries; both have ``block``, queries ``query_id``."""
    parts = max(1, -(-n_queries // QUERIES))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    queries = queries.withColumn("part", F.pmod(F.hash("query_id"), F.lit(parts)))
    both = rows.groupBy("block", "part").cogroup(queries.groupBy("block", "part"))
    empty = pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})

    def task(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        try:
            return work(x, q) if len(x) and len(q) else empty
        finally:
            give_back()

    return both.applyInPandas(task, schema)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k highest scores of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top(scores: np.ndarray, ids: np.ndarray, own: int, k: int, slack: float = 0.0) -> np.ndarray:
    """Positions of the k best scores but the query's own, with all that tie with or lie within ``slack`` of the last."""
    keep = np.flatnonzero(ids != own)
    if len(keep) <= k:
        return keep
    s = scores[keep]
    edge = np.partition(s, len(s) - k)[len(s) - k]
    return keep[s >= edge - slack]


def divisible(column: str, by: int) -> Column:
    return F.pmod(F.col(column), F.lit(by)) == 0
