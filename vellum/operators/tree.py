"""Document trees: building them from elements in reading order, adding and moving nodes, and ranges.

Nodes are rows (doc_id, node_id, parent_id, child_ix, label, layer, level, page_no, text); a root has no
parent, and siblings are in the order of child_ix and node_id. Edits are joins and windows by document and
parent; only the walk holds a document as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.documents import CONTAINER_LABELS, HEADER_LABELS, TABLE_LABELS, list_groups
from vellum.operators.grouped import in_tables
from vellum.operators.layout import settled

LISTS = ["list", "ordered_list"]
HEADINGS = ["title", "section_header"]


def build(items: DataFrame, captions: DataFrame, footnotes: DataFrame, merges: DataFrame) -> DataFrame:
    """(doc_id, ref, parent_ref, child_ix, label, layer, page_no, text, spans) from elements in reading order.

    items (doc_id, page_no, cluster_id, label, pos, text); captions and footnotes link an element (target) to
    a text (caption, footnote) of its page, merges a text (first) to the one that goes on (second). Linked texts
    leave the flow: captions and footnotes become children of their element, merged texts are joined, with
    the stretch of each part in ``spans``. List items that no other text parts share a list. Pages count from 1.
    What is linked to an element that is linked itself stays in the flow, so that no text is lost.
    """
    keys = ["doc_id", "page_no", "cluster_id"]
    items = settled(items)  # read by all that follows
    one = lambda df, target, own: df.select("doc_id", "page_no", F.col(target).alias("to"), F.col(own).alias("cluster_id"))
    merged = merges.select("doc_id", F.col("page_no").alias("to_page"), F.col("first").alias("to"), F.coalesce("next_page", "page_no").alias("page_no"), F.col("second").alias("cluster_id"))
    notes = one(captions, "target", "caption").withColumn("turn", F.lit(1)).unionByName(one(footnotes, "target", "footnote").withColumn("turn", F.lit(2)))
    away = notes.select(*keys).unionByName(merged.select(*keys)).distinct()
    away = away.select("doc_id", F.col("page_no").alias("to_page"), F.col("cluster_id").alias("to"))
    merged = settled(merged.join(away, ["doc_id", "to_page", "to"], "left_anti"))
    notes = notes.join(away.withColumnRenamed("to_page", "page_no"), ["doc_id", "page_no", "to"], "left_anti")
    linked = notes.select(*keys).unionByName(merged.select(*keys)).distinct()
    flow = items.join(linked, keys, "left_anti")
    order = Window.partitionBy("doc_id").orderBy("page_no", "pos", "cluster_id")
    flow = flow.withColumn("at", F.row_number().over(order))
    # texts that go on are joined to the first one
    parts = merged.join(items.select(*keys, "pos", F.col("text").alias("more")), keys).groupBy("doc_id", F.col("to_page").alias("page_no"), F.col("to").alias("cluster_id"))
    parts = parts.agg(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "pos", "more"))), lambda p: p.more).alias("more"))
    flow = flow.join(parts, keys, "left")
    pieces = F.concat(F.array("text"), F.coalesce("more", F.array().cast("array<string>")))
    start = lambda i: F.aggregate(F.slice(pieces, 1, i), F.lit(0), lambda n, t: n + F.length(t) + 1)
    spans = F.transform(pieces, lambda t, i: F.struct(start(i).alias("start"), (start(i) + F.length(t)).alias("stop")))
    flow = flow.withColumn("spans", spans).withColumn("text", F.array_join(pieces, " "))
    lists = list_groups(flow.where(~F.col("label").isin(CONTAINER_LABELS)).select("doc_id", "page_no", "cluster_id", "label", F.col("at").alias("pos")), more=["page_no"])
    flow = flow.join(lists, keys, "left")
    columns = ["doc_id", "at", "turn", "k", "group", "of", "label", "layer", "page_no", "text", "spans"]
    none = F.lit(None).cast("bigint")
    layer = F.when(F.col("label").isin(HEADER_LABELS), "furniture").otherwise("body")
    own = flow.select("doc_id", "at", F.lit(0).alias("turn"), F.lit(0).cast("bigint").alias("k"), F.col("list_id").alias("group"), none.alias("of"), "label", layer.alias("layer"), "page_no", "text", "spans")
    groups = flow.where("list_id is not null").groupBy("doc_id", "list_id").agg(F.min("at").alias("at"), F.min_by("page_no", "at").alias("page_no"))
    groups = groups.select("doc_id", "at", F.lit(-1).alias("turn"), F.lit(0).cast("bigint").alias("k"), F.col("list_id").alias("group"), none.alias("of"), F.lit("list").alias("label"), F.lit("body").alias("layer"), "page_no", F.lit("").alias("text"), F.array().cast(own.schema["spans"].dataType).alias("spans"))
    targets = flow.select("doc_id", "page_no", F.col("cluster_id").alias("to"), "at")
    below = notes.join(items.select(*keys, "label", "pos", "text"), keys).join(targets, ["doc_id", "page_no", "to"])
    stretch = F.array(F.struct(F.lit(0).alias("start"), F.length("text").alias("stop")))
    below = below.select("doc_id", "at", "turn", F.col("pos").cast("bigint").alias("k"), none.alias("group"), F.col("at").cast("bigint").alias("of"), "label", F.lit("body").alias("layer"), "page_no", "text", stretch.alias("spans"))
    nodes = own.select(*columns).unionByName(groups.select(*columns)).unionByName(below.select(*columns))
    kind = F.when(F.col("label").isin("list", *CONTAINER_LABELS), "groups").when(F.col("label").isin(TABLE_LABELS), "tables").when(F.col("label") == "picture", "pictures").otherwise("texts")
    number = F.row_number().over(Window.partitionBy("doc_id", kind).orderBy("at", "turn", "k")) - 1
    nodes = settled(nodes.withColumn("ref", F.concat(F.lit("#/"), kind, F.lit("/"), number.cast("string"))))
    heads = nodes.where("turn = -1").select("doc_id", "group", F.col("ref").alias("list_ref"))
    hosts = nodes.where("turn = 0").select("doc_id", F.col("at").cast("bigint").alias("of"), F.col("ref").alias("host_ref"))
    nodes = nodes.join(heads, ["doc_id", "group"], "left").join(hosts, ["doc_id", "of"], "left")
    parent = F.coalesce("host_ref", F.when(F.col("turn") == 0, F.col("list_ref")), F.lit("#/body"))
    nodes = nodes.withColumn("parent_ref", parent)
    place = F.row_number().over(Window.partitionBy("doc_id", "parent_ref").orderBy("at", "turn", "k")) - 1
    return nodes.select("doc_id", "ref", "parent_ref", place.cast("bigint").alias("child_ix"), "label", "layer", (F.col("page_no") + 1).alias("page_no"), "text", "spans")


def _instances(table: pa.Table, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(row, parent, pos, levels) of the nodes that the roots reach, a level at a time: their rows, the instance of their parent (-1 for roots), their
    place in pre-order within their document, and each level's paths as instances. A document is the rows from an edge to the next."""
    n = len(table)
    doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    number = lambda name: table.column(name).combine_chunks() if n else pa.array([], pa.int64())
    plain = lambda name, lost: pc.fill_null(number(name).cast(pa.int64()), lost).to_numpy(zero_copy_only=False)
    known = lambda name: number(name).is_valid().to_numpy(zero_copy_only=False)
    least = np.iinfo(np.int64).min
    node, ix, parent = plain("node_id", least), plain("child_ix", least), plain("parent_id", least)
    is_node, is_child = known("node_id"), known("parent_id")
    is_doc = known("doc_id")
    # ids of (document, node) pairs, the same for a node and for what names it as its parent
    keys = np.stack([np.concatenate([doc, doc]), np.concatenate([node, parent])])
    order = np.lexsort((keys[1], keys[0]))
    fresh = np.append(True, (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)) if n else np.zeros(0, dtype=bool)
    key = np.empty(2 * n, dtype=np.int64)
    key[order] = np.cumsum(fresh) - 1
    own, above = key[:n], key[n:]
    # children of a key in the order of child_ix and node_id; an unknown document or parent has none
    children = np.flatnonzero(is_child & is_doc)
    children = children[np.lexsort((node[children], ix[children], above[children]))]
    first = np.searchsorted(above[children], np.arange(int(fresh.sum()) + 1))
    roots = np.flatnonzero(~is_child)
    row = roots[np.lexsort((node[roots], ix[roots], doc[roots]))]
    rows, parents, levels, starts = [], [], [], []
    up, path, start = np.full(len(row), -1, dtype=np.int64), np.empty((len(row), 0), dtype=np.int64), 0
    while len(row):
        at = np.arange(start, start + len(row))
        path = np.concatenate([path, at[:, None]], axis=1)
        rows.append(row), parents.append(up), levels.append(path), starts.append(start)
        start += len(row)
        begin, many = first[own[row]], np.where(is_node[row], first[own[row] + 1] - first[own[row]], 0)
        back = np.repeat(np.arange(len(row)), many)
        place = np.arange(len(back)) - np.repeat(np.cumsum(many) - many, many)
        row, up, path = children[begin[back] + place], at[back], path[back]
    if not rows:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, []
    row, up = np.concatenate(rows), np.concatenate(parents)
    size = np.ones(len(row), dtype=np.int64)
    for at in starts[:0:-1]:  # from the last level up
        stop = at + len(levels[starts.index(at)])
        np.add.at(size, up[at:stop], size[at:stop])
    pos = np.empty(len(row), dtype=np.int64)
    for path in levels:
        at = path[:, -1]
        before = np.cumsum(size[at]) - size[at]
        of = up[at] if path.shape[1] > 1 else doc[row[at]]
        turn = np.append(True, of[1:] != of[:-1])
        before -= np.maximum.accumulate(np.where(turn, before, 0))
        pos[at] = before if path.shape[1] == 1 else pos[up[at]] + 1 + before
    return row, up, pos, levels


def walked(nodes: DataFrame) -> DataFrame:
    """``nodes`` with depth, pos (in pre-order), path (child_ix and node_id from the root), lists (the lists above), above (the parent's label) and
    item_ix (the number of a list item among those of its parent).

    Nodes are dealt by document once; a task walks the trees of a batch of whole documents together, a level at a time. What no root reaches is left out.
    """
    more = [c for c in nodes.columns if c not in ("doc_id", "parent_id")]
    given = nodes.select("doc_id", "parent_id", *more)
    kinds = {f.name: f.dataType for f in given.schema.fields}
    step = T.StructType([T.StructField("child_ix", kinds["child_ix"]), T.StructField("node_id", kinds["node_id"])])
    added = {"depth": T.LongType(), "pos": T.LongType(), "path": T.ArrayType(step), "lists": T.ArrayType(kinds["node_id"]), "above": T.StringType(), "item_ix": T.LongType()}
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in given.schema.fields], *[T.StructField(name, kind) for name, kind in added.items()]])

    def walk(table: pa.Table, edges: np.ndarray) -> pa.Table:
        row, up, pos, levels = _instances(table, edges)
        doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[row]
        order = np.lexsort((pos, doc))
        depth = np.concatenate([np.full(len(p), p.shape[1] - 1, dtype=np.int64) for p in levels] or [np.zeros(0, dtype=np.int64)])
        place = np.empty(len(row), dtype=np.int64)
        place[order] = np.arange(len(row))
        offsets = np.concatenate([[0], np.cumsum(depth[order] + 1)])
        flat = np.empty(int(offsets[-1]), dtype=np.int64)  # the paths, one after the other
        for path in levels:
            flat[offsets[place[path[:, -1]]][:, None] + np.arange(path.shape[1])] = path
        label = table.column("label").combine_chunks() if len(table) else pa.array([], pa.string())
        is_list = pc.is_in(label, pa.array(LISTS, label.type)).to_numpy(zero_copy_only=False)
        held = is_list[row[flat]]
        held[offsets[1:] - 1] = False  # not the node itself
        ends = np.concatenate([[0], np.cumsum(held)])[offsets]
        of = lambda name, at: table.column(name).combine_chunks().take(pa.array(row[at])) if len(table) else pa.array([], table.schema.field(name).type)
        out = {name: of(name, order) for name in table.schema.names}
        out |= {"depth": pa.array(depth[order]), "pos": pa.array(pos[order])}
        steps = pa.StructArray.from_arrays([of("child_ix", flat), of("node_id", flat)], ["child_ix", "node_id"])
        out["path"] = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), steps)
        out["lists"] = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), of("node_id", flat[held]))
        host = up[order]
        out["above"] = label.take(pa.array(np.where(host < 0, 0, row[host]), mask=host < 0)) if len(table) else label
        item = pc.fill_null(pc.equal(label, "list_item"), False).to_numpy(zero_copy_only=False)[row[order]]
        # siblings are numbered in order: by their parent's instance, or by their document
        by = np.lexsort((np.arange(len(order)), np.where(host < 0, -1 - doc[order], host)))
        group, counted = np.where(host < 0, -1 - doc[order], host)[by], np.cumsum(item[by])
        turn = np.append(True, group[1:] != group[:-1])[: len(by)]
        counted = counted - np.maximum.accumulate(np.where(turn, counted - item[by], 0))
        number = np.empty(len(order), dtype=np.int64)
        number[by] = counted
        out["item_ix"] = pa.array(number, mask=~item)
        return pa.table(out)

    return in_tables(given, "doc_id", [], walk, schema)


def unreached(nodes: DataFrame, walk: DataFrame) -> DataFrame:
    """(doc_id, node_id, reason): nodes that the walk does not reach, since their parent is missing (``orphan``), or hang below such a node or in a cycle (``cut off``)."""
    lost = nodes.join(walk.select("doc_id", "node_id"), ["doc_id", "node_id"], "left_anti")
    known = nodes.select("doc_id", F.col("node_id").alias("parent_id"), F.lit(True).alias("known"))
    reason = F.when(F.col("known"), "cut off").otherwise("orphan")
    return lost.join(known, ["doc_id", "parent_id"], "left").select("doc_id", "node_id", reason.alias("reason"))


def selected(walk: DataFrame, *, layers: list[str] | None = None, labels: list[str] | None = None, pages: list[int] | None = None, start: int = 0, stop: int | None = None) -> DataFrame:
    """Walked nodes of some layers, labels and pages, of those from ``start`` up to ``stop`` in order."""
    keep = F.col("pos") >= start
    keep = keep if stop is None else keep & (F.col("pos") < stop)
    for column, values in (("layer", layers), ("label", labels), ("page_no", pages)):
        keep = keep if values is None else keep & F.col(column).isin(values)
    return walk.where(keep)


def _ranked(nodes: DataFrame, *order: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("doc_id", "parent_id").orderBy(*order)) - 1
    return nodes.withColumn("child_ix", place.cast("bigint"))


def _numbered(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` rows, in the order of ``at``, with ids after the last one of their document."""
    last = nodes.groupBy("doc_id").agg(F.max("node_id").alias("last"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("at"))
    return new.join(last, "doc_id", "left").withColumn("node_id", (F.coalesce("last", F.lit(-1)) + number).cast("bigint")).drop("last")


def appended(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes and new ones (doc_id, at, parent_id and the other columns), each the last child of its parent."""
    both = nodes.withColumn("turn", F.lit(0)).unionByName(_numbered(nodes, new).withColumn("child_ix", F.col("at")).drop("at").withColumn("turn", F.lit(1)))
    return _ranked(both, "turn", "child_ix", "node_id").select(*nodes.columns)


def inserted(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes and new ones (doc_id, at, sibling_id, before and the other columns), each right before or after its sibling."""
    place = nodes.select("doc_id", F.col("node_id").alias("sibling_id"), "parent_id", F.col("child_ix").alias("near"))
    made = _numbered(nodes, new.join(place, ["doc_id", "sibling_id"]))
    made = made.withColumn("turn", F.when(F.col("before"), -1).otherwise(1)).withColumn("child_ix", F.col("near"))
    both = nodes.withColumn("turn", F.lit(0)).unionByName(made.select(*nodes.columns, "turn"))
    return _ranked(both, "child_ix", "turn", "node_id").select(*nodes.columns)


def with_lists(nodes: DataFrame, walk: DataFrame) -> DataFrame:
    """``nodes`` with list items that no list holds put into new lists, each right before its first item; what hangs on an item stays with it.

    Items that follow each other in the walk share a list if the one before hangs on no node. Children are numbered anew.
    """
    order = Window.partitionBy("doc_id").orderBy("pos")
    item = F.col("label") == "list_item"
    goes_on = F.coalesce(F.lag(item & F.col("parent_id").isNull()).over(order), F.lit(False))
    rows = walk.withColumn("goes_on", goes_on).where(item).where(~F.coalesce(F.col("above").isin(LISTS), F.lit(False)))
    rows = rows.withColumn("list", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(order))
    first = F.first(F.struct("node_id", "parent_id", "child_ix", "pos")).over(Window.partitionBy("doc_id", "list").orderBy("pos"))
    rows = rows.select("doc_id", "node_id", "list", "pos", first.alias("first"))
    last = nodes.groupBy("doc_id").agg(F.max("node_id").alias("last"))
    rows = rows.join(last, "doc_id").withColumn("list_id", F.col("last") + F.col("list"))
    moved = rows.select("doc_id", "node_id", "list_id", F.col("pos").alias("at"))
    kept = nodes.join(moved, ["doc_id", "node_id"], "left").withColumns({"parent_id": F.coalesce("list_id", "parent_id"), "child_ix": F.coalesce("at", "child_ix"), "turn": F.lit(0)})
    lists = rows.where(F.col("node_id") == F.col("first.node_id")).join(nodes.drop("parent_id", "child_ix", "label"), ["doc_id", "node_id"])
    own = {"node_id": F.col("list_id"), "parent_id": F.col("first.parent_id"), "child_ix": F.col("first.child_ix"), "label": F.lit("list"), "turn": F.lit(-1)}
    own |= {"text": F.lit("")} if "text" in nodes.columns else {}
    both = kept.select(*nodes.columns, "turn").unionByName(lists.withColumns(own).select(*nodes.columns, "turn"))
    return _ranked(both, "child_ix", "turn", "node_id").select(*nodes.columns)


def joined(first: DataFrame, second: DataFrame) -> DataFrame:
    """The nodes of two documents of one doc_id as one, the second after the first."""
    shift = first.groupBy("doc_id").agg((F.max("node_id") + 1).alias("shift"))
    moved = second.join(shift, "doc_id", "left").withColumn("shift", F.coalesce("shift", F.lit(0)))
    moved = moved.withColumns({"node_id": F.col("node_id") + F.col("shift"), "parent_id": F.col("parent_id") + F.col("shift")}).drop("shift")
    both = first.withColumn("turn", F.lit(0)).unionByName(moved.withColumn("turn", F.lit(1)))
    return _ranked(both, "turn", "child_ix", "node_id").select(*first.columns)


def extracted(walk: DataFrame, first: int, last: int) -> DataFrame:
    """(doc_id, node_id, new_id, new_parent): the nodes from ``first`` to ``last`` in order as a document; those whose parent is outside are roots."""
    kept = walk.where(F.col("pos").between(first, last)).select("doc_id", "node_id", "parent_id", (F.col("pos") - first).alias("new_id"))
    parents = kept.select("doc_id", F.col("node_id").alias("parent_id"), F.col("new_id").alias("new_parent"))
    return kept.join(parents, ["doc_id", "parent_id"], "left").select("doc_id", "node_id", "new_id", "new_parent")


def without_range(walk: DataFrame, first: int, last: int) -> DataFrame:
    """(doc_id, node_id, new_id, new_parent): what is left without the nodes from ``first`` to ``last`` in order and all below them."""
    gone = walk.where(F.col("pos").between(first, last)).select("doc_id", F.col("node_id").alias("above"))
    below = walk.select("doc_id", "node_id", F.explode(F.transform("path", lambda p: p.node_id)).alias("above")).join(gone, ["doc_id", "above"]).select("doc_id", "node_id").distinct()
    left = walk.join(below, ["doc_id", "node_id"], "left_anti")
    left = left.withColumn("new_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")) - 1).cast("bigint"))
    parents = left.select("doc_id", F.col("node_id").alias("parent_id"), F.col("new_id").alias("new_parent"))
    return left.select("doc_id", "node_id", "parent_id", "new_id").join(parents, ["doc_id", "parent_id"], "left").select("doc_id", "node_id", "new_id", "new_parent")
