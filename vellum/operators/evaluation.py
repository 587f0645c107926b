"""Comparing results: label F1, keyed differences, greedy box matching, confidences and timings."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.operators.grouped import in_groups

#: Pairs of boxes of a page that are compared at once.
PAIRS = 1_000_000


def label_f1(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, f1): agreement of the label multisets; two empty ones agree."""
    a = expected.groupBy(*keys, "label").agg(F.count("*").alias("x"))
    b = actual.groupBy(*keys, "label").agg(F.count("*").alias("y"))
    both = a.join(b, [*keys, "label"], "full_outer").fillna(0, ["x", "y"])
    hit = F.sum(F.least("x", "y"))
    return both.groupBy(*keys).agg(F.round(2 * hit / (F.sum("x") + F.sum("y")), 6).alias("f1"))


def keyed_diff(expected: DataFrame, actual: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, status): missing, new, changed or same."""
    a = expected.select(*keys, F.struct(*values).alias("x"))
    b = actual.select(*keys, F.struct(*values).alias("y"))
    status = F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "new").when(F.col("x").eqNullSafe(F.col("y")), "same").otherwise("changed")
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status"))


def greedy_iou(expected: DataFrame, actual: DataFrame, least: float = 0.1) -> DataFrame:
    """(page_id, mean_iou): each actual box in order takes the best expected one left, if over ``least``."""
    box = ["l", "t", "r", "b"]
    both = expected.select("page_id", F.lit(0).alias("side"), "cluster_id", *box).unionByName(actual.select("page_id", F.lit(1).alias("side"), "cluster_id", *box))

    def score(have: np.ndarray, boxes: np.ndarray) -> float:
        if not len(boxes):
            return 1.0
        total, free = 0.0, np.ones(len(have), dtype=bool)
        block = max(1, PAIRS // max(1, len(have)))
        for start in range(0, len(boxes) if len(have) else 0, block):
            x, y = boxes[start : start + block, None], have[None]
            w, h = np.minimum(x[..., 2], y[..., 2]) - np.maximum(x[..., 0], y[..., 0]), np.minimum(x[..., 3], y[..., 3]) - np.maximum(x[..., 1], y[..., 1])
            i = np.where((w > 0) & (h > 0), w * h, 0.0)
            union = (x[..., 2] - x[..., 0]) * (x[..., 3] - x[..., 1]) + (y[..., 2] - y[..., 0]) * (y[..., 3] - y[..., 1]) - i
            for row in np.divide(i, union, out=np.zeros_like(i), where=union != 0):
                k = int(np.where(free, row, -1.0).argmax())
                if free[k] and row[k] > least:
                    total += float(row[k])
                    free[k] = False
        return total / len(boxes)

    def pages(frame: pd.DataFrame, edges: list[int]) -> pd.DataFrame:
        boxes, second = frame[box].to_numpy(dtype=float), np.concatenate([[0], np.cumsum(frame.side.to_numpy())])
        at = frame.page_id.to_numpy()
        found = []
        for a, b in pairwise(edges):
            cut = b - int(second[b] - second[a])
            found.append((at[a], score(boxes[a:cut], boxes[cut:b])))
        return pd.DataFrame(found, columns=["page_id", "mean_iou"])

    return in_groups(both, ["page_id"], ["side", "cluster_id"], pages, "page_id bigint, mean_iou double")


def grade(score: Column) -> Column:
    return F.when(score < 0.5, "poor").when(score < 0.8, "fair").when(score < 0.9, "good").when(score >= 0.9, "excellent").otherwise("unspecified")


def best_of_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, seconds): the fastest of repeated runs."""
    return runs.groupBy(*keys).agg(F.min("seconds").alias("seconds"))


def edge_colour(pixels: DataFrame, width: int, height: int) -> DataFrame:
    """(image, colour): the commonest colour of the outer rows and columns, whose corners count twice; the least in a tie."""
    side, level = F.col("x").isin(0, width - 1), F.col("y").isin(0, height - 1)
    counts = pixels.where(side | level).groupBy("image", "colour").agg(F.sum(F.when(side & level, 2).otherwise(1)).alias("n"))
    return counts.groupBy("image").agg(F.max(F.struct("n", (-F.col("colour")).alias("c"))).alias("best")).select("image", (-F.col("best.c")).alias("colour"))
