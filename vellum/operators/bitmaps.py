"""Which parts of a page have to be read from pictures: bitmap coverage and boxes.

Rectangles are (page_id, l, t, r, b) in points from the top left. A page is a raster of a point each; what is
drawn is dilated, so that rectangles near each other are one region.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.operators.grouped import each_group

#: Points that a rectangle grows by before and after, and the coverage from which a whole page is read.
BEFORE, AFTER, WHOLE = 10, 9, 0.75
REGIONS = "page_id bigint, region bigint, l bigint, t bigint, r bigint, b bigint, pixels bigint"


def covered(boxes: np.ndarray, width: int, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mask, column edges, row edges) of boxes (l, t, r, b), both ends included, grown and cut at the page.

    The raster is that of the page, with lines and columns between which nothing begins or ends taken together.
    """
    l, t, r, b = boxes.T  # noqa: E741
    seen = (l <= r) & (t <= b) & (r >= 0) & (b >= 0) & (l < width) & (t < height)
    l, t = np.maximum(np.maximum(l[seen], 0) - BEFORE, 0), np.maximum(np.maximum(t[seen], 0) - BEFORE, 0)  # noqa: E741
    r, b = np.minimum(np.minimum(r[seen], width - 1) + AFTER, width - 1) + 1, np.minimum(np.minimum(b[seen], height - 1) + AFTER, height - 1) + 1
    across, down = np.unique(np.concatenate([l, r])), np.unique(np.concatenate([t, b]))
    edges = np.zeros((len(down), len(across)), dtype=np.int32)
    l, r, t, b = (np.searchsorted(e, v) for e, v in ((across, l), (across, r), (down, t), (down, b)))  # noqa: E741
    for rows, columns, n in ((t, l, 1), (t, r, -1), (b, l, -1), (b, r, 1)):
        np.add.at(edges, (rows, columns), n)
    return edges.cumsum(axis=0).cumsum(axis=1)[:-1, :-1] > 0, across, down


def regions(mask: np.ndarray, across: np.ndarray, down: np.ndarray) -> list[tuple]:
    """(region, l, t, r, b, pixels) of the connected parts of a raster, in the order of their first pixels.

    Runs of cells in a row are linked with those that they touch in the row above; labels spread over the links until they settle.
    """
    height, width = mask.shape
    padded = np.zeros((height, width + 2), dtype=np.int8)
    padded[:, 1:-1] = mask
    step = np.diff(padded, axis=1)
    row, start = np.nonzero(step == 1)
    stop = np.nonzero(step == -1)[1]
    if not len(row):
        return []
    size = width + 1
    begin = np.searchsorted(row * size + stop, (row - 1) * size + start, side="right")
    end = np.searchsorted(row * size + start, (row - 1) * size + stop, side="left")
    count = np.maximum(end - begin, 0)
    below = np.repeat(np.arange(len(row)), count)
    above = np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    label = np.arange(len(row))
    while True:
        low = np.minimum(label[below], label[above])
        new = label.copy()
        for at in (below, above, label[below], label[above]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    left, right, top, bottom = across[start], across[stop] - 1, down[row], down[row + 1] - 1
    pixels = (right - left + 1) * (bottom - top + 1)
    names, own = np.unique(label, return_inverse=True)
    out = [np.arange(len(names))]
    for values, pick in ((left, np.minimum), (top, np.minimum), (right, np.maximum), (bottom, np.maximum), (pixels, np.add)):
        found = np.full(len(names), {np.minimum: 1 << 60, np.maximum: -1, np.add: 0}[pick])
        pick.at(found, own, values)
        out.append(found)
    return list(zip(*(c.tolist() for c in out), strict=True))


def bitmap_regions(rectangles: DataFrame, pages: DataFrame) -> DataFrame:
    """``REGIONS`` rows of each page (page_id, width, height) with a rectangle on it."""
    rows = rectangles.join(pages.select("page_id", "width", "height"), "page_id").select("page_id", "width", "height", *[F.col(c).cast("double").alias(c) for c in "ltrb"])

    def page(part: pd.DataFrame) -> list[tuple]:
        width, height = (round(float(part[c].iloc[0])) for c in ("width", "height"))
        boxes = np.rint(part[list("ltrb")].to_numpy()).astype(np.int64)
        return regions(*covered(boxes, width, height))

    return each_group(rows, ["page_id"], list("ltrb"), page, REGIONS)


def ocr_boxes(rectangles: DataFrame, pages: DataFrame, *, threshold: float = 0.05, full_page: bool = False) -> DataFrame:
    """(page_id, coverage, whole, l, t, r, b): what has to be read from the picture of each page (page_id, width, height).

    The whole page if more than ``WHOLE`` of it, or the threshold if that is more, is covered, or if ``full_page`` asks for it; the regions
    if more than the threshold is; else nothing.
    """
    found = bitmap_regions(rectangles, pages)
    area = F.col("width") * F.col("height")
    parts = found.groupBy("page_id").agg(F.sum("pixels").alias("pixels"), F.sort_array(F.collect_list(F.struct("region", *[F.col(c).cast("double").alias(c) for c in "ltrb"]))).alias("parts"))
    shares = pages.join(parts, "page_id", "left").withColumn("coverage", F.coalesce(F.col("pixels") / area, F.lit(0.0)))
    whole = (F.col("coverage") > max(WHOLE, threshold)) | F.lit(full_page)
    page = F.array(F.struct(F.lit(0).cast("bigint").alias("region"), *[v.cast("double").alias(c) for c, v in (("l", F.lit(0)), ("t", F.lit(0)), ("r", F.col("width")), ("b", F.col("height")))]))
    boxes = F.when(whole, page).when(F.col("coverage") > threshold, F.col("parts"))
    return shares.select("page_id", "coverage", whole.alias("whole"), F.explode(boxes).alias("box")).select("page_id", "coverage", "whole", *[f"box.{c}" for c in "ltrb"])
