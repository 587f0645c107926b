"""Layout clean-up: filters, cell assignment, overlap groups and their best member, boxes and orders.

Tables: clusters (page_id, cluster_id, label, confidence, l, t, r, b) and cells (page_id, cell_ix,
l, t, r, b, text). Joins are equi-joins on the page with the box test as a residue; pages with very
many boxes use ``assign_cells(bins=...)``, which adds grid cells to the join key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.geometry import Box, hull

#: The least confidence of each label.
CONFIDENCE = {
    "caption": 0.5, "footnote": 0.5, "formula": 0.5, "list_item": 0.5, "page_footer": 0.5, "page_header": 0.5, "picture": 0.5, "section_header": 0.45,
    "table": 0.5, "text": 0.5, "title": 0.45, "code": 0.45, "checkbox_selected": 0.45, "checkbox_unselected": 0.45, "form": 0.45,
    "key_value_region": 0.45, "document_index": 0.45,
}
WRAPPERS = ["form", "key_value_region", "table", "document_index"]
SPECIAL = [*WRAPPERS, "picture"]
#: How far areas and confidences may differ when the best of a group is picked.
PREFER = {"regular": (1.3, 0.05), "picture": (2.0, 0.3), "wrapper": (2.0, 0.2)}
ASSIGN_OVER, CONTAINED, OVERLAP, FULL_PAGE = 0.2, 0.8, 0.8, 0.9


def by_label(values: dict[str, float], label: str = "label") -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col(label)]


def confident(clusters: DataFrame) -> DataFrame:
    """Clusters at or over their label's threshold; titles become section headers."""
    kept = clusters.where(F.col("confidence") >= by_label(CONFIDENCE))
    return kept.withColumn("label", F.when(F.col("label") == "title", "section_header").otherwise(F.col("label")))


def without_full_page_pictures(clusters: DataFrame, pages: DataFrame, most: float = FULL_PAGE) -> DataFrame:
    joined = clusters.join(pages.select("page_id", "width", "height"), "page_id")
    return joined.where((F.col("label") != "picture") | (Box.of().area / (F.col("width") * F.col("height")) <= most)).select(*clusters.columns)


def valid_cells(cells: DataFrame) -> DataFrame:
    return cells.where((F.trim("text") != "") & (Box.of().area > 0))


def _prefixed(df: DataFrame, prefix: str, keep: str = "page_id") -> DataFrame:
    return df.select(*[F.col(c) if c == keep else F.col(c).alias(prefix + c) for c in df.columns])


def binned(df: DataFrame, size: float) -> DataFrame:
    """A row for each grid cell that a box touches (bx, by)."""
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))
    return df.withColumn("bx", span("l", "r")).withColumn("by", span("t", "b"))


def assign_cells(cells: DataFrame, clusters: DataFrame, *, bins: float | None = None, least: float = ASSIGN_OVER) -> DataFrame:
    """(page_id, cell_ix, cluster_id, ratio): each valid cell's cluster by the share of the cell it covers;
    ties go to the smaller cluster_id."""
    left = valid_cells(cells).select("page_id", "cell_ix", "l", "t", "r", "b")
    right, keys = clusters.select("page_id", "cluster_id", "l", "t", "r", "b"), ["page_id"]
    if bins:
        left, right, keys = binned(left, bins), binned(right, bins), ["page_id", "bx", "by"]
    right = right.select(*keys, "cluster_id", *[F.col(c).alias(f"c_{c}") for c in "ltrb"])
    cell, cluster = Box.of(), Box.of("c_")
    pairs = left.join(right, keys).where(cell.overlaps(cluster)).withColumn("ratio", cell.intersection(cluster) / cell.area).where(F.col("ratio") > least)
    best = pairs.groupBy("page_id", "cell_ix").agg(F.max(F.struct("ratio", (-F.col("cluster_id")).alias("k"))).alias("best"))
    return best.select("page_id", "cell_ix", (-F.col("best.k")).alias("cluster_id"), F.col("best.ratio").alias("ratio"))


def orphans(cells: DataFrame, clusters: DataFrame, assigned: DataFrame) -> DataFrame:
    """Text clusters made of cells that none covers, numbered after the page's last cluster."""
    lost = valid_cells(cells).join(assigned.select("page_id", "cell_ix"), ["page_id", "cell_ix"], "left_anti")
    last = clusters.groupBy("page_id").agg(F.max("cluster_id").alias("last"))
    number = F.row_number().over(Window.partitionBy("page_id").orderBy("cell_ix"))
    return lost.join(last, "page_id", "left").select("page_id", (F.coalesce("last", F.lit(-1)) + number).cast("bigint").alias("cluster_id"), "cell_ix", F.lit("text").alias("label"), "l", "t", "r", "b")


def empty(clusters: DataFrame, assigned: DataFrame) -> DataFrame:
    """Clusters without a cell, formulas aside."""
    return clusters.where("label <> 'formula'").join(assigned.select("page_id", "cluster_id").distinct(), ["page_id", "cluster_id"], "left_anti")


def children_of_special(clusters: DataFrame, least: float = CONTAINED) -> DataFrame:
    """(page_id, special_id, child_id): regular clusters that lie in a special one."""
    child = clusters.where(~F.col("label").isin(SPECIAL)).select("page_id", F.col("cluster_id").alias("child_id"), "l", "t", "r", "b")
    special = clusters.where(F.col("label").isin(SPECIAL)).select("page_id", F.col("cluster_id").alias("special_id"), *[F.col(c).alias(f"s_{c}") for c in "ltrb"])
    return child.join(special, "page_id").where(Box.of().over_self(Box.of("s_")) > least).select("page_id", "special_id", "child_id")


def overlap_edges(clusters: DataFrame, least: float = OVERLAP) -> DataFrame:
    """(page_id, a, b) with a < b: clusters that agree by union or by either one's area."""
    a = clusters.select("page_id", F.col("cluster_id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in "ltrb"])
    b = clusters.select("page_id", F.col("cluster_id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in "ltrb"])
    x, y = Box.of("a_"), Box.of("b_")
    inter = x.intersection(y)
    hit = (inter / x.area >= least) | (inter / y.area >= least) | (inter / (x.area + y.area - inter) >= least)
    return a.join(b, "page_id").where((F.col("a") < F.col("b")) & x.overlaps(y) & hit).select("page_id", "a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(page_id, node, component): the smallest cluster that each one reaches.

    Pages are dealt to tasks by one shuffle; a batch of whole pages is settled at once, all its labels taking
    the least of their neighbours' and then that of their label, until nothing changes.
    """
    rows = edges.select("page_id", F.col("a").cast("bigint"), F.col("b").cast("bigint")).repartition("page_id").sortWithinPartitions("page_id")

    def settle(page: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        ends = np.stack([np.concatenate([page, page]), np.concatenate([a, b])], axis=1)
        nodes, at = np.unique(ends, axis=0, return_inverse=True)
        x, y = at.reshape(2, -1)
        label = np.arange(len(nodes))
        while True:
            low, new = np.minimum(label[x], label[y]), label.copy()
            for place in (x, y, label[x], label[y]):
                np.minimum.at(new, place, low)
            new = new[new]
            if (new == label).all():
                return pd.DataFrame({"page_id": nodes[:, 0], "node": nodes[:, 1], "component": nodes[label, 1]})
            label = new

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = np.empty((0, 3), dtype=np.int64)
        for batch in batches:
            have = np.concatenate([rest, batch.to_numpy(dtype=np.int64)])
            whole = have[:, 0] != have[-1, 0]
            rest = have[~whole]
            if whole.any():
                yield settle(*have[whole].T)
        if len(rest):
            yield settle(*rest.T)

    return rows.mapInPandas(run, "page_id bigint, node bigint, component bigint")


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint if there is a folder for that, else kept in memory and on disk."""
    if df.sparkSession.conf.get("spark.checkpoint.dir", None):
        return df.checkpoint()
    return df.persist()


def best_of_groups(clusters: DataFrame, groups: DataFrame, kind: str = "regular") -> DataFrame:
    """(page_id, component, cluster_id): the member of each group that the preference rules leave.

    A member stands if no other is to be preferred: list items stand against texts of like area, code
    against what it contains, and otherwise a member falls to one that is more confident unless it
    is much larger. Of those that stand, in the order of cluster_id, a larger one replaces the best
    so far unless it is much less confident; if none stands, the first member is taken.
    """
    area, conf = PREFER[kind]
    own = groups.withColumnRenamed("node", "cluster_id").join(clusters, ["page_id", "cluster_id"]).select(
        "page_id", "component", "cluster_id", "label", "confidence", "l", "t", "r", "b", Box.of().area.alias("area")
    )
    other = own.select("page_id", "component", *[F.col(c).alias(f"o_{c}") for c in ("cluster_id", "label", "confidence", "l", "t", "r", "b", "area")])
    pairs = own.join(other, ["page_id", "component"]).where("cluster_id <> o_cluster_id")
    ratio = F.col("area") / F.col("o_area")
    wins = ((F.col("label") == "list_item") & (F.col("o_label") == "text") & (F.abs(1 - ratio) < 0.2)) | ((F.col("label") == "code") & (Box.of("o_").over_self(Box.of()) > CONTAINED))
    falls = ~wins & (ratio <= area) & (F.col("o_confidence") - F.col("confidence") > conf)
    fallen = pairs.where(falls).select("page_id", "component", "cluster_id").distinct().withColumn("fallen", F.lit(True))
    member = F.struct("cluster_id", "area", "confidence", F.col("fallen").isNull().alias("stands"))
    grouped = own.join(fallen, ["page_id", "component", "cluster_id"], "left").groupBy("page_id", "component").agg(F.array_sort(F.collect_list(member)).alias("members"))
    none = F.struct(F.lit(None).cast("bigint").alias("cluster_id"), F.lit(0.0).alias("area"), F.lit(0.0).alias("confidence"))
    pick = lambda m: F.struct(m.cluster_id.alias("cluster_id"), m.area.alias("area"), m.confidence.alias("confidence"))
    fold = F.aggregate(F.filter("members", lambda m: m.stands), none, lambda acc, m: F.when(acc.cluster_id.isNull() | ((m.area > acc.area) & (acc.confidence - m.confidence <= conf)), pick(m)).otherwise(acc))
    return grouped.select("page_id", "component", F.coalesce(fold.cluster_id, F.get("members", 0).cluster_id).alias("cluster_id"))


def shrunk(clusters: DataFrame, cells: DataFrame, assigned: DataFrame) -> DataFrame:
    """Boxes drawn around each cluster's cells; a table also keeps its old box; without cells nothing changes."""
    around = assigned.select("page_id", "cell_ix", "cluster_id").join(cells.select("page_id", "cell_ix", "l", "t", "r", "b"), ["page_id", "cell_ix"])
    around = around.groupBy("page_id", "cluster_id").agg(*hull(), F.min("cell_ix").alias("first_cell"))
    around = around.select("page_id", "cluster_id", "first_cell", *[F.col(c).alias(f"n_{c}") for c in "ltrb"])
    table = F.col("label") == "table"
    new = [F.coalesce(F.when(table, f(F.col(c), F.col(f"n_{c}"))).otherwise(F.col(f"n_{c}")), F.col(c)).alias(c) for c, f in zip("ltrb", (F.least, F.least, F.greatest, F.greatest), strict=True)]
    return clusters.join(around, ["page_id", "cluster_id"], "left").select("page_id", "cluster_id", "label", "confidence", *new, "first_cell")


def ordered(clusters: DataFrame) -> DataFrame:
    """Ranks within the page in the three sort orders: by first cell, from the top, from the left."""
    w = Window.partitionBy("page_id")
    first = F.coalesce("first_cell", F.lit(2**31 - 1))
    rank = lambda *by: F.row_number().over(w.orderBy(*by, "cluster_id"))
    return clusters.select("page_id", "cluster_id", rank(first, "t", "l").alias("by_id"), rank("t", "l", "b", "r").alias("by_tblr"), rank("l", "r", "t", "b").alias("by_lrtb"))


def cells_in_boxes(cells: DataFrame, boxes: DataFrame, least: float = CONTAINED) -> DataFrame:
    """(page_id, box_id, cell_ix): cells of which more than ``least`` lies in the box."""
    right = boxes.select("page_id", "box_id", *[F.col(c).alias(f"x_{c}") for c in "ltrb"])
    return cells.join(right, "page_id").where(Box.of().over_self(Box.of("x_")) > least).select("page_id", "box_id", "cell_ix")


def with_fallback(found: DataFrame, fallback: DataFrame) -> DataFrame:
    """``found``, and for boxes without a row there the rows of ``fallback``."""
    rest = fallback.join(found.select("page_id", "box_id").distinct(), ["page_id", "box_id"], "left_anti")
    return found.unionByName(rest)


def add_untouched(first: DataFrame, second: DataFrame) -> DataFrame:
    """``first`` and the cells of ``second`` that touch none of them, indexed anew from 0."""
    other = first.select("page_id", *[F.col(c).alias(f"o_{c}") for c in "ltrb"])
    a, b = Box.of(), Box.of("o_")
    new = second.join(other, (second.page_id == other.page_id) & a.overlaps(b), "left_anti")
    both = first.withColumn("from_ocr", F.lit(False)).unionByName(new.withColumn("from_ocr", F.lit(True)))
    index = F.row_number().over(Window.partitionBy("page_id").orderBy("from_ocr", "cell_ix")) - 1
    return both.withColumn("new_ix", index.cast("bigint"))


def predicted(clusters: DataFrame, pages: DataFrame, least: float = 0.3, without: tuple[str, ...] = ()) -> DataFrame:
    """Predictions of enough confidence and no excluded label, with boxes cut at the page."""
    kept = clusters.where((F.col("confidence") >= least) & ~F.col("label").isin(*without)).join(pages.select("page_id", "width", "height"), "page_id")
    return kept.withColumns(dict(zip("ltrb", _sides(Box.of().within(F.col("width"), F.col("height"))), strict=True))).select(*clusters.columns)


def _sides(box: Box) -> tuple[Column, Column, Column, Column]:
    return box.l, box.t, box.r, box.b


def without_contained(clusters: DataFrame) -> DataFrame:
    """Clusters but the regular ones that lie in a special one."""
    inside = children_of_special(clusters).select("page_id", F.col("child_id").alias("cluster_id")).distinct()
    return clusters.join(inside, ["page_id", "cluster_id"], "left_anti")


def around_children(clusters: DataFrame) -> DataFrame:
    """Forms and key-value regions get the box around the clusters that lie in them."""
    child = clusters.select("page_id", F.col("cluster_id").alias("child_id"), *"ltrb")
    hulls = children_of_special(clusters).join(child, ["page_id", "child_id"]).groupBy("page_id", F.col("special_id").alias("cluster_id")).agg(*hull())
    hulls = hulls.select("page_id", "cluster_id", *[F.col(c).alias(f"n_{c}") for c in "ltrb"])
    region = F.col("label").isin("form", "key_value_region")
    return clusters.join(hulls, ["page_id", "cluster_id"], "left").select(*[F.when(region, F.coalesce(f"n_{c}", c)).otherwise(F.col(c)).alias(c) if c in "ltrb" else c for c in clusters.columns])


def without_doubled_wrappers(clusters: DataFrame, least: float = 0.9, margin: float = 0.1) -> DataFrame:
    """Clusters but forms, key-value regions and indexes that a table nearly covers, unless they are surer by ``margin``."""
    table = clusters.where("label = 'table'").select("page_id", F.col("confidence").alias("sure"), *[F.col(c).alias(f"x_{c}") for c in "ltrb"])
    wrapper = clusters.where(F.col("label").isin("form", "key_value_region", "document_index"))
    gone = wrapper.join(table, "page_id").where((Box.of().over_self(Box.of("x_")) > least) & (F.col("confidence") - F.col("sure") < margin))
    return clusters.join(gone.select("page_id", "cluster_id").distinct(), ["page_id", "cluster_id"], "left_anti")


def refined(clusters: DataFrame, cells: DataFrame, assigned: DataFrame, rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """(clusters, assigned cells) after boxes are drawn around their cells and overlapping clusters become their
    group's best member, which takes their cells, until no clusters overlap or for ``rounds`` rounds."""
    for _ in range(rounds):
        clusters = settled(shrunk(clusters, cells, assigned).drop("first_cell"))
        groups = components(overlap_edges(clusters))
        best = best_of_groups(clusters, groups).withColumnRenamed("cluster_id", "best")
        moves = settled(groups.join(best, ["page_id", "component"]).where("node <> best").select("page_id", F.col("node").alias("cluster_id"), "best"))
        if moves.isEmpty():
            break
        clusters = clusters.join(moves, ["page_id", "cluster_id"], "left_anti")
        assigned = settled(assigned.join(moves, ["page_id", "cluster_id"], "left").select("page_id", "cell_ix", F.coalesce("best", "cluster_id").alias("cluster_id")))
    return clusters, assigned


def _settled_apart(clusters: DataFrame, labels: list[str], kind: str) -> tuple[DataFrame, DataFrame]:
    """(groups' other members and their best one, as (page_id, cluster_id, best)), of clusters of some labels that overlap; and the clusters that stay."""
    own = clusters.where(F.col("label").isin(labels))
    groups = components(overlap_edges(own))
    best = best_of_groups(own, groups, kind).withColumnRenamed("cluster_id", "best")
    moves = settled(groups.join(best, ["page_id", "component"]).where("node <> best").select("page_id", F.col("node").alias("cluster_id"), "best"))
    return moves, own.join(moves, ["page_id", "cluster_id"], "left_anti")


def postprocessed(clusters: DataFrame, cells: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clusters, children (page_id, special_id, child_id), cells (page_id, cluster_id, cell_ix)) of predicted clusters.

    Regular clusters of enough confidence get cells; empty ones go, cells that none covers become texts, and what overlaps is refined. Special
    ones then take the regular ones that lie in them as children, with their cells; forms and key-value regions get the box around them.
    Pictures and wrappers that overlap are settled apart, each among its kind, the best one taking the others' cells. Regular clusters
    in a special one that stays are its children alone.
    """
    sure = confident(clusters)
    is_special = F.col("label").isin(SPECIAL)
    regular = sure.where(~is_special)
    assigned = assign_cells(cells, regular).select("page_id", "cell_ix", "cluster_id")
    regular = regular.join(empty(regular, assigned).select("page_id", "cluster_id"), ["page_id", "cluster_id"], "left_anti")
    lost = settled(orphans(cells, clusters, assigned))
    names = ["page_id", "cluster_id", "label", "confidence", *"ltrb"]
    regular = regular.select(*names).unionByName(lost.withColumn("confidence", F.lit(1.0)).select(*names))
    assigned = assigned.unionByName(lost.select("page_id", "cell_ix", "cluster_id"))
    regular, assigned = refined(regular, cells, assigned)
    regular, assigned = settled(regular), settled(assigned)
    special = without_full_page_pictures(without_doubled_wrappers(sure.where(is_special).select(*names).unionByName(regular)).where(is_special), pages)
    children = settled(children_of_special(special.unionByName(regular)))
    special = settled(around_children(special.unionByName(regular)).where(is_special))
    parts = [_settled_apart(special, labels, kind) for labels, kind in ((["picture"], "picture"), (WRAPPERS, "wrapper"))]
    moves = parts[0][0].unionByName(parts[1][0])
    stay = settled(parts[0][1].unionByName(parts[1][1]))
    held = children.join(assigned.withColumnRenamed("cluster_id", "child_id"), ["page_id", "child_id"]).select("page_id", F.col("special_id").alias("cluster_id"), "cell_ix")
    held = held.join(moves, ["page_id", "cluster_id"], "left").select("page_id", F.coalesce("best", "cluster_id").alias("cluster_id"), "cell_ix").distinct()
    children = children.join(stay.select("page_id", F.col("cluster_id").alias("special_id")), ["page_id", "special_id"], "left_semi")
    inside = children.select("page_id", F.col("child_id").alias("cluster_id")).distinct()
    out = stay.select(*names).unionByName(regular.join(inside, ["page_id", "cluster_id"], "left_anti").select(*names))
    return out, children, assigned.select("page_id", "cluster_id", "cell_ix").unionByName(held)


def first_cells(cells: DataFrame, more: DataFrame) -> DataFrame:
    """Both sets of cells, one for each index: that of ``cells`` goes before one of ``more``."""
    both = cells.withColumn("turn", F.lit(0)).unionByName(more.withColumn("turn", F.lit(1)))
    first = Window.partitionBy("page_id", "cell_ix").orderBy("turn", "l", "t", "r", "b")
    return both.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n", "turn")


def with_predictions(clusters: DataFrame, predictions: DataFrame) -> DataFrame:
    """(page_id, cluster_id, n_rows, n_cols, otsl) of table clusters; one without a prediction is an empty table."""
    tables = clusters.where(F.col("label").isin("table", "document_index")).select("page_id", "cluster_id")
    found = tables.join(predictions, ["page_id", "cluster_id"], "left")
    return found.select("page_id", "cluster_id", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_cols", F.lit(0)).alias("n_cols"), F.coalesce("otsl", F.lit("")).alias("otsl"))


def candidate_counts(cells: DataFrame, clusters: DataFrame) -> DataFrame:
    """(page_id, p50, p95, most): how many clusters touch a cell, by picks from the sorted counts."""
    box = clusters.select("page_id", *[F.col(c).alias(f"x_{c}") for c in "ltrb"])
    valid = valid_cells(cells)
    touching = valid.join(box, "page_id").where(Box.of().overlaps(Box.of("x_"))).groupBy("page_id", "cell_ix").agg(F.count("*").alias("n"))
    all_ = valid.select("page_id", "cell_ix").join(touching, ["page_id", "cell_ix"], "left").select("page_id", F.coalesce("n", F.lit(0)).alias("n"))
    counts = all_.groupBy("page_id").agg(F.array_sort(F.collect_list("n")).alias("c"))
    pick = lambda share: F.get("c", F.floor(F.size("c") * share).cast("int"))
    return counts.select("page_id", pick(0.5).alias("p50"), pick(0.95).alias("p95"), F.array_max("c").alias("most"))
