"""Line-oriented formats: classifiers for AsciiDoc and Markdown lines, and delimited files as cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEPARATORS = [",", ";", "\t", "|", ":"]


def asciidoc(line: Column) -> Column:
    return (
        F.when(line.rlike(r"^= "), "title")
        .when(line.rlike(r"^==+\s+"), "header")
        .when(line.rlike(r"^\s*(\*|-|\d+\.|\w+\.) "), "list_item")
        .when(line.rlike(r"^\|==="), "table_edge")
        .when(line.rlike(r"^\|"), "table_row")
        .when(line.rlike(r"^image::"), "picture")
        .when(line.rlike(r"^\.[^ .]"), "caption")
        .when(F.trim(line) == "", "blank")
        .otherwise("text")
    )


def markdown(line: Column) -> Column:
    return (
        F.when(line.rlike(r"^#{1,6} "), "heading")
        .when(line.rlike(r"^(```|~~~)"), "fence")
        .when(line.rlike(r"^\s*([-*+]|\d+[.)]) "), "list_item")
        .when(line.rlike(r"^\s*>"), "quote")
        .when(line.rlike(r"^\s*\|?[\s:|-]*-{3,}[\s:|-]*$") & line.contains("|"), "table_rule")
        .when(line.contains("|"), "table_row")
        .when(F.trim(line) == "", "blank")
        .otherwise("text")
    )


def separator(first: Column) -> Column:
    """The separator that a file's first line has most often, the earlier one of SEPARATORS in a tie."""
    counts = [F.struct((F.length(first) - F.length(F.replace(first, F.lit(s), F.lit("")))).alias("n"), F.lit(-i).alias("i"), F.lit(s).alias("s")) for i, s in enumerate(SEPARATORS)]
    best = F.greatest(*counts)
    return F.when(best.n > 0, best.s).otherwise(F.lit(","))


def records(lines: DataFrame) -> DataFrame:
    """(file_id, row, text) of lines (file_id, line_id, line): a line within open quotes goes on with the one before."""
    w = Window.partitionBy("file_id").orderBy("line_id")
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    before = F.coalesce(F.sum("quotes").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = lines.withColumn("quotes", quotes).withColumn("fresh", F.when(before % 2 == 0, 1).otherwise(0))
    numbered = numbered.withColumn("row", (F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("bigint"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_id", "line"))), lambda x: x.line)
    return numbered.groupBy("file_id", "row").agg(F.array_join(parts, "\n").alias("text"))


def fields(text: Column, sep: Column) -> Column:
    """The fields of a record; a field in double quotes may hold separators, line ends and doubled quotes."""
    pattern = F.concat(F.lit("(?s)["), sep, F.lit(']("(?:[^"]|"")*+"|[^'), sep, F.lit("]*)"))
    found = F.regexp_extract_all(F.concat(sep, text), pattern, F.lit(1))
    quoted = lambda f: f.startswith('"') & f.endswith('"') & (F.length(f) > 1)
    return F.transform(found, lambda f: F.when(quoted(f), F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))


def cells(lines: DataFrame) -> DataFrame:
    """(file_id, row, col, text, header, ragged) of files given as lines (file_id, line_id, line); a row is
    ragged if its length is not that of the first."""
    first = lines.groupBy("file_id").agg(separator(F.min_by("line", "line_id")).alias("sep"))
    rows = records(lines).join(first, "file_id").select("file_id", "row", fields(F.col("text"), F.col("sep")).alias("fields"))
    width = rows.where("row = 0").select("file_id", F.size("fields").alias("width"))
    out = rows.join(width, "file_id").select("file_id", "row", F.posexplode("fields").alias("col", "text"), (F.size("fields") != F.col("width")).alias("ragged"))
    return out.select("file_id", "row", F.col("col").cast("bigint").alias("col"), "text", (F.col("row") == 0).alias("header"), "ragged")
