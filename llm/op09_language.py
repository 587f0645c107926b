"""Language identification by the nearest of several TF-IDF centroids per language.

A text's vector has a dimension for each hash of three consecutive bytes (A-Z lower-cased, ASCII
other than letters as a space, a space before and after the text), with log(1 + count) times the
inverse document frequency, at length one. Each language has ``CENTROIDS`` centroids, found by
spherical k-means, and the nearest centroid by cosine names the language; a text whose best cosine
is under ``reject`` is ``und``.

The model (frequencies and centroids) is fitted on a sample of the labelled rows: ``per_language``
bounds the expected number for each language, taken by a hash of the id. Prediction covers every
whole text, without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; ties go to the
language first in order; without labelled rows all is ``und``; null languages are not learned;
other columns are kept unless named lang_pred or score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.hashing import slices
from llm.tables import held_out, in_batches, in_groups, others, table

DIMENSIONS = 1 << 12
CENTROIDS = 3
PER_LANGUAGE = 800
ROWS = 128

FOLD = np.arange(256, dtype=np.uint32)
FOLD[:128] = 0x20
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def counts_of(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, last row + 1, counts by row and dimension) of slices of the texts."""
    padded = pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), " ", "")
    for first, last, data, offsets in slices(padded, rows=ROWS):
        x = FOLD[data]
        code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(33 - DIMENSIONS.bit_length())
        index = code.astype(np.int64) + np.repeat(np.arange(last - first) * DIMENSIONS, np.diff(offsets))[: len(code)]
        across = np.concatenate([offsets[1:-1] - 1, offsets[1:-1] - 2])
        keep = np.ones(len(index), dtype=bool)
        keep[across] = False
        yield first, last, np.bincount(index[keep], minlength=(last - first) * DIMENSIONS).reshape(-1, DIMENSIONS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def cluster(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids of length one by spherical k-means from far-apart starting points."""
    centroids = [x.mean(axis=0)]
    near = x @ centroids[0]
    for _ in range(min(k, len(x)) - 1):
        centroids.append(x[int(np.argmin(near))])
        near = np.maximum(near, x @ centroids[-1])
    c = np.array(centroids)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.array([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c.astype(np.float32)


class Model:
    """Inverse document frequencies, and the centroids with the language of each."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, languages: list[str]) -> None:
        self.idf, self.centroids, self.languages = idf, centroids, languages


def fit(documents: DataFrame, *, lang: str = "lang", text: str = "text", per_language: int = PER_LANGUAGE, k: int = CENTROIDS) -> Model:
    rows = documents.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    sizes = {r[0]: r[1] for r in documents.where(F.col(lang).isNotNull()).groupBy(lang).count().collect()}
    if not sizes:
        return Model(np.zeros(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), [])
    order = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30))
    limit = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, int((1 << 30) * min(1.0, per_language / n)))])
    rows = rows.where(order < limit[F.col(lang)]).select(F.col(lang).alias("lang"), "doc_id", F.col(text).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, counts in counts_of(batch.column(2)):
                part = batch.slice(first, last - first)
                found = [np.flatnonzero(row) for row in counts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.list_(pa.int64())), pa.array([r[i] for r, i in zip(counts, found, strict=True)], pa.list_(pa.int64()))],
                    names=["lang", "doc_id", "dimensions", "counts"],
                )

    sample = in_batches(rows, counted, "lang string, doc_id bigint, dimensions array<bigint>, counts array<bigint>").persist()
    n = sample.count()
    idf = np.full(DIMENSIONS, np.log(1 + n) + 1, dtype=np.float32)
    for r in sample.select(F.explode("dimensions").alias("d")).groupBy("d").count().collect():
        idf[r.d] = np.log((1 + n) / (1 + r["count"])) + 1

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        dense = np.zeros((len(group), DIMENSIONS), dtype=np.float32)
        for i, (d, c) in enumerate(zip(group.dimensions, group["counts"], strict=True)):
            dense[i, d] = c
        return pd.DataFrame({"lang": group.lang.iloc[0], "centroid": [c.tobytes() for c in cluster(vectors(dense, idf), k)]})

    found = in_groups(sample.groupBy("lang"), centroids, "lang string, centroid binary").collect()
    sample.unpersist()
    found.sort(key=lambda r: (r.lang, bytes(r.centroid)))
    return Model(idf, np.array([np.frombuffer(r.centroid, np.float32) for r in found]).reshape(-1, DIMENSIONS), [r.lang for r in found])


def identify(documents: DataFrame, model: Model, *, text: str = "text", reject: float = 0.0) -> DataFrame:
    """``documents`` with lang_pred and score (the best cosine)."""
    kept = others(documents, ["lang_pred", "score"])
    schema = T.StructType([*[documents.schema[c] for c in kept], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], dtype=object)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            best, value = np.full(batch.num_rows, len(names) - 1), np.zeros(batch.num_rows)
            if model.languages:
                for first, last, counts in counts_of(texts):
                    near = vectors(counts, model.idf) @ model.centroids.T
                    best[first:last], value[first:last] = near.argmax(axis=1), near.max(axis=1)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            best[~letters | (value < reject)] = len(names) - 1
            value = np.where(letters, np.clip(value, 0, 1), 0.0)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names[best], pa.string()), pa.array(value)], names=[*kept, "lang_pred", "score"])

    return in_batches(documents, run, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit(documents.where(~held_out("doc_id", 4, 2)))
    found = identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
