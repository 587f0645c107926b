"""Text cells of a page: doubles, lines, and the text inside a box. Cells have (page_id, cell_ix, l, t, r, b, text)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.geometry import hull
from vellum.operators.grouped import in_tables

CORNERS = ["l", "t", "r", "b"]


def without_doubles(cells: DataFrame, eps: float = 0.1) -> DataFrame:
    """Cells of which no earlier one has the same text with all corners within ``eps``.

    Cells are dealt by page once. Within a batch of whole pages those of one text are looked up in a grid of size 2 eps and its
    neighbours, so no page is compared as a whole.
    """
    size = 2 * eps

    def pages(table: pa.Table, edges: np.ndarray) -> pa.Table:
        rows = pd.DataFrame({c: table.column(c).to_pandas() for c in ("text", "cell_ix", *CORNERS)})
        rows["page"] = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        known = rows.notna().all(axis=1) & table.column("page_id").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        rows = rows[known]
        rows = rows[rows.duplicated(["page", "text"], keep=False)]
        rows["text"] = pd.factorize(rows["text"])[0]
        rows = rows.assign(bx=np.floor(rows["l"] / size), by=np.floor(rows["t"] / size), at=rows.index)
        keep = np.ones(len(table), dtype=bool)
        for dx in (-1, 0, 1) if len(rows) else ():
            for dy in (-1, 0, 1):
                near = rows.assign(bx=rows["bx"] + dx, by=rows["by"] + dy)
                pairs = rows.merge(near, on=["page", "text", "bx", "by"], suffixes=("", "_e"))
                same = pairs["cell_ix_e"] < pairs["cell_ix"]
                for c in CORNERS:
                    same &= (pairs[c] - pairs[f"{c}_e"]).abs() < eps
                keep[pairs.loc[same, "at"].to_numpy()] = False
        return table.filter(pa.array(keep))

    return in_tables(cells, "page_id", [], pages, cells.schema)


def lines(cells: DataFrame, band: float = 4.0, gap: float = 40.0) -> DataFrame:
    """(page_id, line_ix, l, t, r, b, text): cells whose tops follow within ``band`` are a row; a row is cut where a gap exceeds ``gap``."""
    down = Window.partitionBy("page_id").orderBy("t", "l", "cell_ix")
    turn = F.when(F.col("t") - F.lag("t").over(down) > band, 1).otherwise(0)
    rows = cells.withColumn("turn", turn).withColumn("row", F.sum("turn").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    along = Window.partitionBy("page_id", "row").orderBy("l", "cell_ix")
    cut = F.when(F.col("l") - F.max("r").over(along.rowsBetween(Window.unboundedPreceding, -1)) > gap, 1).otherwise(0)
    parts = rows.withColumn("cut", cut).withColumn("part", F.sum("cut").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l", "cell_ix", "text"))), lambda c: c.text), " ")
    out = parts.groupBy("page_id", "row", "part").agg(*hull(), text.alias("text"))
    number = F.row_number().over(Window.partitionBy("page_id").orderBy("row", "part")) - 1
    return out.select("page_id", number.cast("bigint").alias("line_ix"), "l", "t", "r", "b", "text")


def text_in_boxes(cells: DataFrame, boxes: DataFrame, eps: float = 1.0) -> DataFrame:
    """(page_id, box_id, text): cells that lie wholly in the box, in their order; no space where one touches the one before."""
    right = boxes.select("page_id", "box_id", *[F.col(c).alias(f"x_{c}") for c in CORNERS])
    inside = cells.join(right, "page_id").where("l >= x_l and r <= x_r and t >= x_t and b <= x_b")
    w = Window.partitionBy("page_id", "box_id").orderBy("cell_ix")
    touches = (F.abs(F.col("l") - F.lag("r").over(w)) < eps) & (F.abs(F.col("b") - F.lag("b").over(w)) < eps)
    part = F.when(F.lag("cell_ix").over(w).isNull() | touches, F.col("text")).otherwise(F.concat(F.lit(" "), "text"))
    parts = inside.select("page_id", "box_id", "cell_ix", part.alias("part"))
    return parts.groupBy("page_id", "box_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cell_ix", "part"))), lambda c: c.part), "").alias("text"))


def crop_windows(boxes: DataFrame, width: float, height: float, target: float = 1024.0) -> DataFrame:
    """Whole-number crops inside the page, without empty ones, and their size when the page is ``target`` high."""
    scale = target / height
    x1, y1 = F.greatest(F.lit(0), F.bround("l", 0).cast("int")), F.greatest(F.lit(0), F.bround("t", 0).cast("int"))
    x2, y2 = F.least(F.lit(int(width)), F.bround("r", 0).cast("int")), F.least(F.lit(int(height)), F.bround("b", 0).cast("int"))
    size = lambda a, b: F.greatest(F.lit(1), F.bround((F.col(b) - F.col(a)) * scale, 0).cast("int"))
    out = boxes.select("page_id", "box_id", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), size("l", "r").alias("w"), size("t", "b").alias("h"))
    return out.where("x2 > x1 and y2 > y1")
