"""Connected components of an edge table, by label propagation with pointer jumping.

Edges are first cut to forests: chunks of them, dealt evenly, each give one edge from every node to
the least node of its group within the chunk. That takes dense groups to about a star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import in_batches, written


CHUNK = 100_000


def settled(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (each node's least known companion) after the links (a, b): the least node that each node reaches."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def forest(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) that connect the same nodes, as many as a chunk has nodes at most; edges are read twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if b.num_rows]
        if not parts:
            return
        nodes, ends = np.unique(np.concatenate(parts), return_inverse=True)
        a, b = ends.reshape(-1, 2).T
        label = settled(np.arange(len(nodes)), a, b)  # nodes are numbered in their order, so the least label is the least node
        at = np.flatnonzero(label != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(nodes[label[at]])], names=["a", "b"])

    n = edges.count()
    return in_batches(edges.select("a", "b").repartition(max(1, -(-n // chunk))), run, "a bigint, b bigint")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): the least node that each node of ``edges`` (a, b) reaches.

    Each round gives a node the least label among its neighbours and then the label of its label;
    a round's table is written, so a lost executor costs one round at most. Stars, which is what
    the callers make, take two or three rounds; any graph takes about the logarithm of its width.
    """
    edges = forest(written(edges.select("a", "b"), f"{name}-all"))
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, f"{name}-edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label"))
    labels = written(labels, f"{name}-labels")
    while True:
        near = both.join(labels, both.a == labels.node).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        step = step.join(jump, step.label == jump["at"]).select("node", "old", F.least("label", "further").alias("label"))
        step = written(step, f"{name}-labels")
        if step.where("old <> label").isEmpty():
            return step.select("node", "label")
        labels = step.select("node", "label")
