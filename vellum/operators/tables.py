"""Table structure: OTSL tokens, matching tokens to cells, column statistics, grids and exports.

Cells (table_id, cell_id, row_id, column_id, cell_class, x1, y1, x2, y2) and tokens (table_id, token_id,
x1, y1, x2, y2, text) are in one coordinate system. Every step is a join or an aggregation by table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Which structure tokens make a cell.
CELL_TOKENS = ["fcel", "ecel", "xcel", "ched", "rhed", "srow"]
SHARED = 0.6
#: A token that reads as a value.
VALUE = r"^(?:[$€£¥]|[-–—]?\(?\d[\d,]*(?:\.\d+)?\)?%?)$"


def structure_tokens(tables: DataFrame) -> DataFrame:
    """(table_id, pos, token, row_id, col_id) of every structure token but the row ends."""
    tokens = tables.select("table_id", F.posexplode(F.split("otsl", " ")).alias("pos", "token"))
    w = Window.partitionBy("table_id").orderBy("pos")
    row = F.sum(F.when(F.col("token") == "nl", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    tokens = tokens.withColumn("row_id", F.coalesce(row, F.lit(0)).cast("bigint")).where("token <> 'nl'")
    column = F.row_number().over(Window.partitionBy("table_id", "row_id").orderBy("pos")) - 1
    return tokens.select("table_id", F.col("pos").cast("bigint").alias("pos"), "token", "row_id", column.cast("bigint").alias("col_id"))


def structure_cells(tables: DataFrame) -> DataFrame:
    return structure_tokens(tables).where(F.col("token").isin(CELL_TOKENS))


def square(tables: DataFrame) -> DataFrame:
    """(table_id, n_rows, is_square): whether all rows have one length."""
    sizes = structure_tokens(tables).groupBy("table_id", "row_id").agg(F.count("*").alias("n"))
    return sizes.groupBy("table_id").agg(F.count("*").alias("n_rows"), (F.min("n") == F.max("n")).alias("is_square"))


def translated(cells: DataFrame, x: float, y: float, width: float, height: float) -> DataFrame:
    """Boxes given as shares of a table at (x, y) in page coordinates."""
    out = {"x1": x + F.col("x1") * width, "y1": y + F.col("y1") * height, "x2": x + F.col("x2") * width, "y2": y + F.col("y2") * height}
    return cells.withColumns(out)


def matched(cells: DataFrame, tokens: DataFrame) -> DataFrame:
    """(table_id, cell_id, token_id, iou, iopdf): all pairs with a common area; iopdf is the share of the token."""
    t = tokens.select("table_id", "token_id", *[F.col(c).alias(f"t_{c}") for c in ("x1", "y1", "x2", "y2")])
    w = F.least("x2", "t_x2") - F.greatest("x1", "t_x1")
    h = F.least("y2", "t_y2") - F.greatest("y1", "t_y1")
    area, own = (F.col("t_x2") - F.col("t_x1")) * (F.col("t_y2") - F.col("t_y1")), (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    pairs = cells.select("table_id", "cell_id", "x1", "y1", "x2", "y2").join(t, "table_id").where((w > 0) & (h > 0))
    return pairs.select("table_id", "cell_id", "token_id", (w * h / (area + own - w * h)).alias("iou"), (w * h / area).alias("iopdf"))


def alignments(cells: DataFrame, matches: DataFrame) -> DataFrame:
    """Per column of cells that matched a token: its steadiest edge (left, then middle, then right) and medians."""
    good = cells.where("cell_class > 1").join(matches.select("table_id", "cell_id").distinct(), ["table_id", "cell_id"], "left_semi")
    spread = lambda e: F.max(e) - F.min(e)
    middle = (F.col("x1") + F.col("x2")) / 2
    stats = good.groupBy("table_id", "column_id").agg(
        spread(F.col("x1")).alias("dl"), spread(middle).alias("dm"), spread(F.col("x2")).alias("dr"),
        F.percentile("x1", 0.5).alias("left"), F.percentile(middle, 0.5).alias("middle"), F.percentile("x2", 0.5).alias("right"),
        F.percentile(F.col("x2") - F.col("x1"), 0.5).alias("width"), F.percentile(F.col("y2") - F.col("y1"), 0.5).alias("height"),
    )
    edge = F.when((F.col("dl") <= F.col("dm")) & (F.col("dl") <= F.col("dr")), "left").when(F.col("dm") <= F.col("dr"), "middle").otherwise("right")
    at = F.when(edge == "left", F.col("left")).when(edge == "middle", F.col("middle")).otherwise(F.col("right"))
    return stats.select("table_id", "column_id", edge.alias("alignment"), at.alias("median_x"), "width", "height")


def moved(cells: DataFrame, matches: DataFrame) -> DataFrame:
    """Cells that matched nothing, or are empty by class, put at their column's median edge; the others as they are."""
    good = matches.select("table_id", "cell_id").distinct().withColumn("hit", F.lit(True))
    out = cells.join(good, ["table_id", "cell_id"], "left").join(alignments(cells, matches), ["table_id", "column_id"], "left")
    bad = (F.col("hit").isNull() | (F.col("cell_class") <= 1)) & F.col("alignment").isNotNull()
    width = F.col("x2") - F.col("x1")
    left = F.when(F.col("alignment") == "left", F.col("median_x")).when(F.col("alignment") == "middle", F.col("median_x") - width / 2).otherwise(F.col("median_x") - width)
    return out.select("table_id", "cell_id", F.when(bad, left).otherwise(F.col("x1")).alias("x1"), F.when(bad, left + width).otherwise(F.col("x2")).alias("x2"), "y1", "y2", bad.alias("moved"))


def doubled_columns(cells: DataFrame, matches: DataFrame, most: float = SHARED) -> DataFrame:
    """(table_id, column_id): of two neighbouring columns that share over ``most`` of the first one's tokens,
    that of the lower score, the sum of its matches' iou and iopdf."""
    own = matches.join(cells.select("table_id", "cell_id", "column_id"), ["table_id", "cell_id"])
    by = own.groupBy("table_id", "column_id").agg(F.round(F.sum(F.col("iou") + F.col("iopdf")), 6).alias("score"), F.collect_set("token_id").alias("tokens"))
    w = Window.partitionBy("table_id").orderBy("column_id")
    pair = by.select("table_id", "column_id", "score", "tokens", F.lead("column_id").over(w).alias("next"), F.lead("score").over(w).alias("next_score"), F.lead("tokens").over(w).alias("next_tokens"))
    share = F.size(F.array_intersect("tokens", "next_tokens")) / F.size("tokens")
    return pair.where(F.col("next").isNotNull() & (share > most)).select("table_id", F.when(F.col("score") >= F.col("next_score"), F.col("next")).otherwise(F.col("column_id")).alias("column_id")).distinct()


def final_assignment(matches: DataFrame) -> DataFrame:
    """One cell for each token: that of the largest iopdf, the smaller cell_id in a tie."""
    order = Window.partitionBy("table_id", "token_id").orderBy(F.desc(F.round("iopdf", 9)), "cell_id")
    return matches.withColumn("n", F.row_number().over(order)).where("n = 1").select("table_id", "token_id", "cell_id")


def aligned_to_tokens(final: DataFrame, tokens: DataFrame) -> DataFrame:
    """Cells' boxes drawn around their tokens, in tables of every size; cells without one are gone."""
    joined = final.join(tokens, ["table_id", "token_id"])
    return joined.groupBy("table_id", "cell_id").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))


def bands(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row bands, column bands): the hulls of each table's rows and columns."""
    rows = cells.groupBy("table_id", "row_id").agg(F.min("y1").alias("low"), F.max("y2").alias("high"))
    columns = cells.groupBy("table_id", "column_id").agg(F.min("x1").alias("low"), F.max("x2").alias("high"))
    return rows, columns


def orphan_places(cells: DataFrame, tokens: DataFrame, matches: DataFrame) -> DataFrame:
    """(table_id, token_id, row_id, column_id): the bands that hold an unmatched token's centre, the nearest by centre."""
    lost = tokens.join(matches.select("table_id", "token_id").distinct(), ["table_id", "token_id"], "left_anti")
    lost = lost.select("table_id", "token_id", ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    rows, columns = bands(cells)

    def nearest(band: DataFrame, at: str, name: str) -> DataFrame:
        inside = lost.join(band, "table_id").where((F.col(at) >= F.col("low")) & (F.col(at) <= F.col("high")))
        away = F.bround(F.abs(F.col(at) - (F.col("low") + F.col("high")) / 2), 3)
        return inside.groupBy("table_id", "token_id").agg(F.min(F.struct(away, F.col(name))).getField(name).alias(name))

    return lost.select("table_id", "token_id").join(nearest(rows, "y", "row_id"), ["table_id", "token_id"], "left").join(nearest(columns, "x", "column_id"), ["table_id", "token_id"], "left")


def token_rows(cells: DataFrame, tokens: DataFrame, matches: DataFrame, pitch: float = 0.6, least: float = 15.0) -> DataFrame:
    """Unmatched tokens in groups of neighbouring heights: (table_id, token_id, group_id, is_value)."""
    lost = tokens.join(matches.select("table_id", "token_id").distinct(), ["table_id", "token_id"], "left_anti")
    centres = cells.groupBy("table_id", "row_id").agg(F.avg((F.col("y1") + F.col("y2")) / 2).alias("y"))
    steps = centres.withColumn("step", F.col("y") - F.lag("y").over(Window.partitionBy("table_id").orderBy("row_id")))
    limit = steps.groupBy("table_id").agg(F.coalesce(F.round(F.avg("step") * pitch, 6), F.lit(least)).alias("limit"))
    w = Window.partitionBy("table_id").orderBy("y", "token_id")
    lost = lost.withColumn("y", (F.col("y1") + F.col("y2")) / 2).join(limit, "table_id")
    turn = F.when(F.col("y") - F.lag("y").over(w) >= F.col("limit"), 1).otherwise(0)
    group = F.sum("turn").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return lost.withColumn("turn", turn).select("table_id", "token_id", group.cast("bigint").alias("group_id"), F.col("text").rlike(VALUE).alias("is_value"))


def merged_text(final: DataFrame, tokens: DataFrame) -> DataFrame:
    """(table_id, cell_id, text): the texts of a cell's tokens in the order of their ids."""
    both = final.join(tokens.select("table_id", "token_id", "text"), ["table_id", "token_id"])
    parts = F.array_sort(F.collect_list(F.struct("token_id", "text")))
    return both.groupBy("table_id", "cell_id").agg(F.array_join(F.transform(parts, lambda p: p.text), " ").alias("text"))


def compacted(cells: DataFrame) -> DataFrame:
    """Rows and columns numbered without gaps, and the table's dimensions: the greatest ends (``row_span`` and ``col_span``, 1 if absent)."""
    rank = lambda c: (F.dense_rank().over(Window.partitionBy("table_id").orderBy(c)) - 1).cast("bigint")
    span = lambda c: F.col(c) if c in cells.columns else F.lit(1)
    out = cells.select("*", rank("row_id").alias("row"), rank("column_id").alias("col")).select("table_id", "cell_id", "row", "col", *[c for c in ("row_span", "col_span") if c in cells.columns])
    w = Window.partitionBy("table_id")
    return out.withColumn("num_rows", F.max(F.col("row") + span("row_span")).over(w)).withColumn("num_cols", F.max(F.col("col") + span("col_span")).over(w)).drop("row_span", "col_span")


def grid(cells: DataFrame) -> DataFrame:
    """(table_id, row, col, cell_id, start_row, start_col) of spanned cells (start_row, row_span, start_col, col_span);
    a later cell overwrites an earlier one, slots without a cell have none."""
    area = cells.select(
        "table_id", "cell_id", "start_row", "start_col",
        F.explode(F.expr("sequence(start_row, start_row + row_span - 1)")).alias("row"), "col_span",
    ).select("table_id", "cell_id", "start_row", "start_col", "row", F.explode(F.expr("sequence(start_col, start_col + col_span - 1)")).alias("col"))
    size = cells.groupBy("table_id").agg(F.max(F.expr("start_row + row_span - 1")).alias("h"), F.max(F.expr("start_col + col_span - 1")).alias("w"))
    top = area.groupBy("table_id", "row", "col").agg(F.max(F.struct("cell_id", "start_row", "start_col")).alias("top"))
    slots = size.select("table_id", F.explode(F.expr("sequence(0L, h)")).alias("row"), "w").select("table_id", "row", F.explode(F.expr("sequence(0L, w)")).alias("col"))
    return slots.join(top, ["table_id", "row", "col"], "left").select("table_id", "row", "col", "top.cell_id", "top.start_row", "top.start_col")


def hulls(cells: DataFrame) -> DataFrame:
    """Boxes of rows (axis 0) and columns (axis 1)."""
    box = [F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")]
    rows = cells.groupBy("table_id", F.col("row_id").alias("ix")).agg(*box).withColumn("axis", F.lit(0))
    return rows.unionByName(cells.groupBy("table_id", F.col("column_id").alias("ix")).agg(*box).withColumn("axis", F.lit(1)))


def to_otsl(slots: DataFrame, texts: DataFrame) -> DataFrame:
    """(table_id, otsl) of a grid: a slot that continues a cell to the left is lcel, above ucel, both xcel."""
    filled = slots.join(texts, ["table_id", "cell_id"], "left")
    right, below = F.col("col") > F.col("start_col"), F.col("row") > F.col("start_row")
    token = F.when(F.col("cell_id").isNull(), "ecel").when(right & below, "xcel").when(right, "lcel").when(below, "ucel").when(F.coalesce("text", F.lit("")) == "", "ecel").otherwise("fcel")
    last = F.col("col") == F.max("col").over(Window.partitionBy("table_id"))
    filled = filled.select("table_id", "row", "col", F.when(last, F.concat(token, F.lit(" nl"))).otherwise(token).alias("token"))
    parts = F.array_sort(F.collect_list(F.struct("row", "col", "token")))
    return filled.groupBy("table_id").agg(F.array_join(F.transform(parts, lambda p: p.token), " ").alias("otsl"))


def triplets(slots: DataFrame, texts: DataFrame) -> DataFrame:
    """(table_id, text): 'row, column = value' of all slots but the first row and column."""
    filled = slots.join(texts, ["table_id", "cell_id"], "left").select("table_id", "row", "col", F.coalesce("text", F.lit("")).alias("text"))
    heads = filled.where("row = 0").select("table_id", "col", F.col("text").alias("head"))
    labels = filled.where("col = 0").select("table_id", "row", F.col("text").alias("label"))
    inner = filled.where("row > 0 and col > 0").join(heads, ["table_id", "col"]).join(labels, ["table_id", "row"])
    line = F.concat("label", F.lit(", "), "head", F.lit(" = "), "text")
    return inner.groupBy("table_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "col", line.alias("line")))), lambda p: p.line), ". ").alias("text"))


def to_markdown(slots: DataFrame, texts: DataFrame) -> DataFrame:
    """(table_id, markdown): a github table; columns are as wide as their longest value, numeric ones to the right."""
    filled = slots.join(texts, ["table_id", "cell_id"], "left").select("table_id", "row", "col", F.coalesce("text", F.lit("")).alias("text"))
    number = F.col("text").rlike(r"^-?\d+(\.\d+)?$") | (F.col("text") == "")
    some = F.max(F.when((F.col("row") > 0) & (F.col("text") != ""), 1).otherwise(0))
    shape = filled.groupBy("table_id", "col").agg(
        F.greatest(F.max(F.length("text")), F.lit(3)).alias("width"), ((F.min(F.when(F.col("row") > 0, number)) == F.lit(True)) & (some == 1)).alias("right")
    )
    cell = F.when(F.col("right"), F.lpad("text", F.col("width"), F.lit(" "))).otherwise(F.rpad("text", F.col("width"), F.lit(" ")))
    rule = F.when(F.col("right"), F.concat(F.repeat(F.lit("-"), F.col("width") + 1), F.lit(":"))).otherwise(F.repeat(F.lit("-"), F.col("width") + 2))
    padded = filled.join(shape, ["table_id", "col"]).select("table_id", "row", "col", F.concat(F.lit(" "), cell, F.lit(" ")).alias("cell"), rule.alias("rule"))
    line = lambda c: F.concat(F.lit("|"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", c))), lambda p: p[c]), "|"), F.lit("|"))
    lines = padded.groupBy("table_id", "row").agg(line("cell").alias("line"), line("rule").alias("rule"))
    both = F.when(F.col("row") == 0, F.concat_ws("\n", "line", "rule")).otherwise(F.col("line"))
    return lines.groupBy("table_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", both.alias("line")))), lambda p: p.line), "\n").alias("markdown"))


#: Structure tokens that give a box, and those after which the next one gives none.
BOXED, BEFORE_SKIP = ["fcel", "ecel", "ched", "rhed", "srow", "nl", "ucel"], ["nl", "ucel", "xcel"]


def decoded(tables: DataFrame) -> DataFrame:
    """(table_id, pos, token, box, span_start): structure tokens after the decoder's rules.

    xcel is read as lcel, and lcel right after ucel as fcel. A token gives a box (numbered from 0) if it is of
    the right kind and the one before does not forbid it, or if it is the first of a run of lcel, which opens a
    span; the next box of another kind closes the span: there ``span_start`` is the box that opened it.
    """
    w = Window.partitionBy("table_id").orderBy("pos")
    tokens = tables.select("table_id", F.posexplode(F.split("otsl", " ")).alias("pos", "token"))
    tokens = tokens.withColumn("token", F.when(F.col("token") == "xcel", "lcel").otherwise(F.col("token")))
    tokens = tokens.withColumn("token", F.when((F.col("token") == "lcel") & (F.lag("token").over(w) == "ucel"), "fcel").otherwise(F.col("token")))
    before = F.lag("token").over(w)
    skip = before.isNull() | before.isin(BEFORE_SKIP)
    opens = (F.col("token") == "lcel") & F.coalesce(before != "lcel", F.lit(True))
    tokens = tokens.withColumn("opens", opens).withColumn("gives", opens | (~skip & F.col("token").isin(BOXED)))
    tokens = tokens.withColumn("box", F.when(F.col("gives"), F.sum(F.col("gives").cast("int")).over(w) - 1))
    last = F.last(F.when(F.col("gives"), F.struct("opens", "box")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    closes = F.when(F.col("gives") & ~F.col("opens") & last.opens, last.box)
    return tokens.select("table_id", F.col("pos").cast("bigint").alias("pos"), "token", "box", closes.alias("span_start"))


def synced_boxes(tags: DataFrame, boxes: DataFrame) -> DataFrame:
    """Boxes (table_id, ix) of tables; where their number is not that of cell tags, the box after each span tag goes.

    tags (table_id, pos, tag): ``<td>`` and ``>`` (the end of a tag with spans) stand for cells.
    """
    w = Window.partitionBy("table_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    cells = tags.where(F.col("tag").isin("<td>", ">")).withColumn("ix", F.count("*").over(w))
    wanted = cells.groupBy("table_id").agg(F.count("*").alias("wanted"))
    odd = boxes.groupBy("table_id").agg(F.count("*").alias("have")).join(wanted, "table_id", "left").where("have <> coalesce(wanted, 0)")
    gone = cells.where("tag = '>'").join(odd, "table_id", "left_semi").select("table_id", "ix").distinct()
    return boxes.join(gone, ["table_id", "ix"], "left_anti")


def with_text(tokens: DataFrame) -> DataFrame:
    return tokens.where(F.trim("text") != "")


def without_columns(cells: DataFrame, matches: DataFrame, columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells and matches without those of some columns (table_id, column_id)."""
    kept = cells.join(columns, ["table_id", "column_id"], "left_anti")
    return kept, matches.join(kept.select("table_id", "cell_id"), ["table_id", "cell_id"], "left_semi")


def matched_kinds(cells: DataFrame, matches: DataFrame) -> DataFrame:
    """(table_id, column_id, good, bad): cells that matched and are of a class over 1, one for each match, and the others."""
    hits = matches.groupBy("table_id", "cell_id").agg(F.count("*").alias("hits"))
    joined = cells.join(hits, ["table_id", "cell_id"], "left")
    good = (F.col("cell_class") > 1) & F.col("hits").isNotNull()
    return joined.groupBy("table_id", "column_id").agg(F.coalesce(F.sum(F.when(good, F.col("hits"))), F.lit(0)).alias("good"), F.count(F.when(~good, 1)).alias("bad"))


def token_columns(cells: DataFrame, tokens: DataFrame) -> DataFrame:
    """(table_id, token_id, column_id, overlap): the column that shares most of a token's width; none if no column does."""
    columns = bands(cells)[1]
    over = F.least("x2", "high") - F.greatest("x1", "low")
    pairs = tokens.join(columns, "table_id").withColumn("overlap", over).where("overlap > 0")
    best = pairs.groupBy("table_id", "token_id").agg(F.max(F.struct("overlap", (-F.col("column_id")).alias("k"))).alias("best"))
    return best.select("table_id", "token_id", (-F.col("best.k")).alias("column_id"), F.col("best.overlap").alias("overlap"))


def missing_rows(cells: DataFrame, tokens: DataFrame, matches: DataFrame, *, ratio: float = 0.35, groups: int = 3, least: int = 2) -> DataFrame:
    """New cells (table_id, cell_id, row_id, column_id, x1, y1, x2, y2) for unmatched tokens that look like a lost row.

    Only tables with at most ``ratio`` of their tokens unmatched, in at most ``groups`` groups by height, are
    mended. A group is a row if ``least`` of its tokens lie in as many columns, one the leftmost, another with a
    value, and no row stands at its height.
    """
    key = Window.partitionBy("table_id")
    lost = with_text(tokens).join(matches.select("table_id", "token_id").distinct(), ["table_id", "token_id"], "left_anti")
    share = tokens.groupBy("table_id").agg(F.count("*").alias("all")).join(lost.groupBy("table_id").agg(F.count("*").alias("lost")), "table_id")
    lost = lost.join(share.where(F.col("lost") / F.col("all") <= ratio).select("table_id"), "table_id", "left_semi")
    centres = cells.groupBy("table_id", "row_id").agg(F.avg((F.col("y1") + F.col("y2")) / 2).alias("y"))
    pitch = centres.groupBy("table_id").agg(F.when(F.count("*") > 1, F.round((F.max("y") - F.min("y")) / (F.count("*") - 1) * 0.6, 9)).otherwise(F.lit(15.0)).alias("pitch"))
    down = key.orderBy("y", "token_id")
    lost = lost.withColumn("y", (F.col("y1") + F.col("y2")) / 2).join(pitch, "table_id")
    lost = lost.withColumn("turn", F.when(F.col("y") - F.lag("y").over(down) >= F.col("pitch"), 1).otherwise(0)).withColumn("group", F.sum("turn").over(down)).withColumn("at", F.row_number().over(down))
    lost = lost.withColumn("last", F.max("group").over(key)).where(F.col("last") < groups)
    placed = lost.join(token_columns(cells, tokens), ["table_id", "token_id"]).join(cells.groupBy("table_id").agg(F.min("column_id").alias("label"), F.max("row_id").alias("last_row"), F.max("cell_id").alias("last_cell")), "table_id")
    value = (F.col("column_id") != F.col("label")) & F.col("text").rlike(VALUE)
    found = placed.groupBy("table_id", "group", "last_row", "last_cell", "pitch").agg(
        F.count("*").alias("n"), F.countDistinct("column_id").alias("columns"), F.max(F.col("column_id") == F.col("label")).alias("labelled"), F.max(value).alias("valued")
    )
    extent = lost.groupBy("table_id", "group").agg(F.min("y1").alias("top"), F.max("y2").alias("bottom"))
    found = found.where(F.col("labelled") & F.col("valued") & (F.col("n") >= least) & (F.col("columns") >= least)).join(extent, ["table_id", "group"])
    margin = F.least(F.lit(4.0), F.col("pitch") * 0.25)
    taken = found.join(bands(cells)[0].select("table_id", "low", "high"), "table_id").where((F.col("bottom") >= F.col("low") - margin) & (F.col("top") <= F.col("high") + margin))
    found = found.join(taken.select("table_id", "group").distinct(), ["table_id", "group"], "left_anti")
    found = found.withColumn("row_id", F.col("last_row") + F.row_number().over(key.orderBy("group")))
    made = placed.join(found.select("table_id", "group", "row_id"), ["table_id", "group"]).groupBy("table_id", "row_id", "column_id", "last_cell").agg(
        F.min("at").alias("at"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")
    )
    return made.select("table_id", (F.col("last_cell") + F.row_number().over(key.orderBy("at"))).cast("bigint").alias("cell_id"), F.col("row_id").cast("bigint").alias("row_id"), "column_id", "x1", "y1", "x2", "y2")


def responses(cells: DataFrame, matches: DataFrame) -> DataFrame:
    """One row for each token: the place, spans and header flags of the cells that it matches; of several cells the last
    gives the place. cells have ``label`` (the structure token), row_span and col_span."""
    flag = lambda label: F.max(F.col("label") == label)
    last = F.max(F.struct("cell_id", "row_id", "column_id", "row_span", "col_span")).alias("last")
    found = matches.select("table_id", "token_id", "cell_id").join(cells, ["table_id", "cell_id"]).groupBy("table_id", "token_id").agg(
        last, flag("ched").alias("column_header"), flag("rhed").alias("row_header"), flag("srow").alias("row_section")
    )
    return found.select(
        "table_id", "token_id", F.col("last.row_id").alias("start_row"), (F.col("last.row_id") + F.col("last.row_span")).alias("end_row"),
        F.col("last.column_id").alias("start_col"), (F.col("last.column_id") + F.col("last.col_span")).alias("end_col"), "column_header", "row_header", "row_section",
    )


def without_row(cells: DataFrame, row: int) -> DataFrame:
    """Cells without a row, the later ones moved up."""
    return cells.where(F.col("row_id") != row).withColumn("row_id", F.col("row_id") - F.when(F.col("row_id") > row, 1).otherwise(0))


def with_space(cells: DataFrame, row: int, n: int = 1) -> DataFrame:
    """Cells from a row on moved down by ``n`` rows."""
    return cells.withColumn("row_id", F.col("row_id") + F.when(F.col("row_id") >= row, n).otherwise(0))
