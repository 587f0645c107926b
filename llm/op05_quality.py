"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

A document's features are its words and pairs of neighbouring words (runs of characters other
than \\x20 and \\x09-\\x0D), hashed to ``BUCKETS``; a feature's value is its count over the root of
the number of features, so that long and short documents weigh alike. A score is the logistic
function of one sparse dot product.

Labels are uneven, and a plain fit calls rare bad documents good; a row of a class with the share s of the rows counts
(1 / 2s) ** ``LEVEL`` times. At 1 the classes weigh alike, and some good documents are lost.

The model is fitted on a sample of the labelled rows: ``sample`` bounds its expected size
(``SAMPLE_DOCUMENTS`` by default; rows are taken by a hash of the id), and one task reads it as a
stream. Scoring covers every whole text, without a shuffle.

Defined cases: a null or empty text has no features and scores the intercept alone; without
labelled rows every score is 0.5; a document labelled more than once counts with its smallest
label; null labels are ignored; other columns are kept unless named score or predicted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.hashing import mix, slices, word_hashes
from llm.tables import held_out, in_batches, others, table

BUCKETS = 1 << 18
SAMPLE_DOCUMENTS = 12_000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.3, 1.0, 0.2, 1.0
LEVEL = 0.7
PAIR = np.uint64(0x9E3779B97F4A7C15)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each occurrence, offsets by row)."""
    words, rows = word_hashes(data, offsets)
    n = len(words)
    out = np.empty(2 * n, dtype=np.int64)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    out[0::2] = (words >> shift).astype(np.int64)
    pairs = words.copy()
    pairs[:-1] = mix(words[:-1] * PAIR + words[1:])
    keep = np.ones(2 * n, dtype=bool)
    last = rows[1:][rows[1:] > rows[:-1]] - 1
    out[1::2] = (pairs >> shift).astype(np.int64)
    keep[2 * last + 1] = False
    counts = np.maximum(2 * np.diff(rows) - 1, 0)
    return out[keep], np.concatenate([[0], np.cumsum(counts)])


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    w[np.abs(z) <= L1] = 0
    return w


def fit_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the weights, the intercept last; batches hold text and label."""
    rows = []
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        for first, last, data, offsets in slices(batch.column(0)):
            found, at = features(data, offsets)
            for i in range(last - first):
                own, counts = np.unique(found[at[i] : at[i + 1]], return_counts=True)
                x = (counts / np.sqrt(max(1, at[i + 1] - at[i]))).astype(np.float32)
                rows.append((own.astype(np.int32), x, float(labels[first + i])))
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    bias, bias_n = 0.0, 0.0
    ones = sum(y for _, _, y in rows)
    level = [(len(rows) / (2 * c)) ** LEVEL if c else 1.0 for c in (len(rows) - ones, ones)]
    for _ in range(EPOCHS):
        for own, x, y in rows:
            zi, ni = z[own], n[own]
            w = weights_of(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(w @ x + bias, -30, 30)))
            slope = (p - y) * level[int(y)]
            g = slope * x
            z[own] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[own] = ni + g * g
            bias_n += slope**2
            bias -= ALPHA * slope / (BETA + np.sqrt(bias_n))
    w = np.append(weights_of(z, n), bias).astype("<f4")
    yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], names=["weights"])


def fit(documents: DataFrame, labels: DataFrame, *, label: str = "quality", sample: int = SAMPLE_DOCUMENTS) -> np.ndarray:
    """Weights of the buckets and the intercept, from about ``sample`` labelled documents at most."""
    labels = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).cast("double").alias("label"))
    order = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    n = labels.count()
    if not n:
        return np.zeros(BUCKETS + 1, dtype=np.float32)
    taken = labels.where(order < int((1 << 30) * min(1.0, sample / n)))
    rows = documents.select("doc_id", "text").join(F.broadcast(taken), "doc_id")  # about ``sample`` pairs of numbers
    rows = rows.select("text", "label", order.alias("at"), "doc_id").repartition(1).sortWithinPartitions("at", "doc_id")
    found = in_batches(rows.select("text", "label"), fit_stream, "weights binary").collect()
    return np.frombuffer(found[0].weights, dtype="<f4") if found else np.zeros(BUCKETS + 1, dtype=np.float32)


def score(documents: DataFrame, weights: np.ndarray, *, text: str = "text") -> DataFrame:
    """``documents`` with score (the probability of label 1) and predicted."""
    kept = others(documents, ["score", "predicted"])
    schema = T.StructType([*[documents.schema[c] for c in kept], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    packed = np.asarray(weights, dtype="<f4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(packed, dtype="<f4")
        for batch in batches:
            out = np.empty(batch.num_rows)
            for first, last, data, offsets in slices(batch.column(batch.schema.get_field_index(text))):
                found, at = features(data, offsets)
                sums = np.concatenate([[0.0], np.cumsum(w[found], dtype=np.float64)])
                total = (sums[at[1:]] - sums[at[:-1]]) / np.sqrt(np.maximum(1, np.diff(at)))
                out[first:last] = 1 / (1 + np.exp(-np.clip(total + w[-1], -30, 30)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out), pa.array((out >= 0.5).astype(np.int32))], names=[*kept, "score", "predicted"])

    return in_batches(documents, run, schema)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    scored = score(documents, fit(documents, labels))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")
