"""Boxes of table cells pushed apart where they overlap."""

from __future__ import annotations

from itertools import pairwise
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.operators.grouped import in_groups

CORNERS = ["x1", "y1", "x2", "y2"]
SCHEMA = "table_id bigint, cell_id bigint, x1 double, y1 double, x2 double, y2 double"
#: Fixed value: by how much the box before is drawn in further than half of the overlap.
FURTHER = 2
#: Tables of up to so many cells are looked at as a whole first: where nothing overlaps, nothing moves.
FEW = 200


def _meeting(boxes: np.ndarray) -> np.ndarray:
    """Which boxes (x1, y1, x2, y2) overlap which later ones."""
    low, high = boxes[:, :2], boxes[:, 2:]
    return np.triu(((low[:, None] < high[None]) & (high[:, None] > low[None])).all(axis=2), 1)


def parted(boxes: np.ndarray) -> np.ndarray:
    """Boxes (x1, y1, x2, y2) in order; each pair is parted along the shorter side of its overlap, as the pairs before have left it.

    Half of the overlap goes off the end of the one that begins first and off the start of the other; a box that is turned over
    by that is turned back. Of each box's pairs only those that overlap when their turn comes are looked at, one after the other.
    """
    out = np.array(boxes, dtype=float).reshape(-1, 4)
    if len(out) <= FEW and not _meeting(out).any():
        return out
    for i in range(len(out)):
        j = i
        while True:
            rest = out[j + 1 :]
            a = out[i]
            meet = (a[0] < rest[:, 2]) & (a[2] > rest[:, 0]) & (a[3] > rest[:, 1]) & (a[1] < rest[:, 3])
            found = np.flatnonzero(meet)[:1]
            if not len(found):
                break
            j += 1 + int(found[0])
            b = out[j]
            sides = np.minimum(a[2:], b[2:]) - np.maximum(a[:2], b[:2])
            if sides.min() <= 0:  # boxes without a width or height
                continue
            axis = 0 if sides[0] < sides[1] else 1
            low, high = (a, b) if a[axis] < b[axis] else (b, a)
            low[axis + 2] -= ceil(sides[axis] / 2) + FURTHER
            high[axis] += floor(sides[axis] / 2)
            for box in (a, b):
                box[:2], box[2:] = np.minimum(box[:2], box[2:]), np.maximum(box[:2], box[2:])
    return out


def without_overlaps(cells: DataFrame) -> DataFrame:
    """``SCHEMA`` rows: the cells' boxes, pair by pair in the order of cell_id, without what overlaps."""

    def tables(frame: pd.DataFrame, edges: list[int]) -> pd.DataFrame:
        boxes = frame[CORNERS].to_numpy(dtype=float)
        for a, b in pairwise(edges):
            boxes[a:b] = parted(boxes[a:b])
        return pd.DataFrame({"table_id": frame.table_id, "cell_id": frame.cell_id, **dict(zip(CORNERS, boxes.T, strict=True))})

    return in_groups(cells.select("table_id", "cell_id", *[F.col(c).cast("double").alias(c) for c in CORNERS]), ["table_id"], ["cell_id"], tables, SCHEMA)
