"""Small cases for what SQL does not cover."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.functions import text
from vellum.functions.geometry import Box
from vellum.operators import chunking, documents, evaluation, layout, tables
from vellum.sources import html, lines


def test_overlap_vectors(spark):
    rows = [(1, 0, 0, 100, 100, 0, 0, 100, 100, True), (2, 0, 0, 10, 10, 90, 90, 100, 100, False), (3, 0, 0, 100, 100, 80, 80, 120, 120, False), (4, 0, 0, 100, 100, 30, 30, 40, 40, True)]
    df = spark.createDataFrame([(a, *map(float, b), c) for a, *b, c in rows], "page_id long, l1 double, t1 double, r1 double, b1 double, l2 double, t2 double, r2 double, b2 double, hit boolean")
    clusters = df.selectExpr("page_id", "stack(2, 1L, l1, t1, r1, b1, 2L, l2, t2, r2, b2) AS (cluster_id, l, t, r, b)")
    assert {r.page_id for r in layout.overlap_edges(clusters).collect()} == {r[0] for r in rows if r[-1]}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(1, i, i + 1) for i in range(100)] + [(2, 5, 6), (2, 8, 9)], "page_id long, a long, b long")
    found = layout.components(edges)
    assert {(r.page_id, r.component): r.n for r in found.groupBy("page_id", "component").agg(F.count("*").alias("n")).collect()} == {(1, 0): 101, (2, 5): 2, (2, 8): 2}


@pytest.mark.parametrize("labels,confidence,areas,best", [
    (["text", "text"], [0.9, 0.6], [100, 100], 0), (["list_item", "text"], [0.5, 0.9], [110, 100], 0), (["text", "text"], [0.6, 0.9], [200, 100], 0), (["text", "code"], [0.52, 0.5], [50, 100], 1),
])
def test_best_of_group(spark, labels, confidence, areas, best):
    rows = [(1, i, labels[i], confidence[i], 0.0, 0.0, float(areas[i]), 1.0) for i in range(2)]
    clusters = spark.createDataFrame(rows, "page_id long, cluster_id long, label string, confidence double, l double, t double, r double, b double")
    groups = spark.createDataFrame([(1, 0, 0), (1, 1, 0)], "page_id long, node long, component long")
    assert layout.best_of_groups(clusters, groups).first().cluster_id == best


def test_boxes_flip_and_measure(spark):
    row = spark.createDataFrame([(10.0, 20.0, 30.0, 50.0)], "l double, t double, r double, b double")
    box = Box.of()
    got = row.select(box.area.alias("a"), box.flipped(100.0).t.alias("t"), box.flipped(100.0).flipped(100.0).b.alias("b"), box.flipped(100.0).y_overlap(box.flipped(100.0)).alias("y")).first()
    assert tuple(got) == (600.0, 80.0, 50.0, 30.0)


@pytest.mark.parametrize("parts,joined", [([], ""), (["a"], "a"), (["exam-", "ple here"], "example here"), (["a -", "- b"], "a - b"), (["one", "two"], "one two"), (["snake_-", "case"], "snake_-case"), (["“q”", "•"], '"q" ·')])
def test_joined_lines(spark, parts, joined):
    df = spark.createDataFrame([(parts,)], "lines array<string>")
    assert df.select(text.joined_lines(F.col("lines"))).first()[0] == joined


def test_two_columns_are_read_one_after_the_other():
    left = [(0, 100 - 20 * i, 40, 90 - 20 * i) for i in range(3)]
    right = [(60, 100 - 20 * i, 100, 90 - 20 * i) for i in range(3)]
    assert documents.page_order(np.array([*right, *left], dtype=float)) == [3, 4, 5, 0, 1, 2]
    # under a common heading both first boxes widen to it, so the second row waits for both
    headed = documents.page_order(np.array([(0, 130, 100, 120), *right, *left], dtype=float))
    assert headed[:3] == [0, 4, 1] and sorted(headed) == list(range(7))
    assert documents.page_order(np.zeros((0, 4))) == []


def test_captions_go_to_their_floats(spark):
    labels = ["caption", "table", "text", "picture", "caption", "text", "table", "caption", "picture", "caption"]
    items = spark.createDataFrame([(1, 0, i, label, i) for i, label in enumerate(labels)], "doc_id long, page_no long, cluster_id long, label string, pos long")
    assert {(r.target, r.caption) for r in documents.caption_links(items).collect()} == {(1, 0), (3, 4), (6, 7), (8, 9)}


def test_html_tree_and_markdown(spark):
    page = "<title>T</title><nav><ul><li>menu</li></ul></nav><h1>Head</h1><p>one<br>two</p><h3>Sub</h3><ul><li>a</li><li>b</li></ul><pre>x = 1</pre><img alt='pic'><script>no()</script><p>end &amp; out"
    rows = html.tree(spark.createDataFrame([(1, page), (2, None)], "page_id long, html string"))
    assert [r.text for r in rows.where("layer = 'furniture' and text <> ''").orderBy("ord").collect()] == ["T", "menu"]
    assert html.to_markdown(rows).first().markdown == "# Head\n\none two\n\n### Sub\n\n- a\n\n- b\n\n```\nx = 1\n```\n\n<!-- image -->\n\nend & out"


def test_delimited_files_and_ragged_rows(spark):
    rows = [(1, i, x) for i, x in enumerate(["a;b;c", "1;2", "3;4;5"])] + [(2, 0, "x|y"), (3, 0, "alone")]
    found = lines.cells(spark.createDataFrame(rows, "file_id long, line_id long, line string")).orderBy("file_id", "row", "col").collect()
    assert [(r.file_id, r.row, r.col, r.text, r.header, r.ragged) for r in found][3:5] == [(1, 1, 0, "1", False, True), (1, 1, 1, "2", False, True)]
    assert len(found) == 11


def test_quoted_fields_hold_separators_and_line_ends(spark):
    rows = [(1, i, x) for i, x in enumerate(['a,b,c', ',"x, ""y""",', '1,"two', 'lines, ""2""",3', '"",4,'])]
    found = lines.cells(spark.createDataFrame(rows, "file_id long, line_id long, line string")).orderBy("row", "col").collect()
    assert [r.text for r in found] == ["a", "b", "c", "", 'x, "y"', "", "1", 'two\nlines, "2"', "3", "", "4", ""] and not any(r.ragged for r in found)


def test_headings_of_every_level(spark):
    rows = [(1, 0, "section_header", 9, "nine"), (1, 1, "text", 0, "a"), (1, 2, "section_header", 40, "forty"), (1, 3, "text", 0, "b"), (1, 4, "section_header", 3, "three"), (1, 5, "text", 0, "c")]
    found = chunking.heading_context(spark.createDataFrame(rows, "doc_id long, node_id long, label string, level long, text string"))
    assert {r.node_id: r.headings for r in found.collect() if r.node_id % 2} == {1: ["nine"], 3: ["nine", "forty"], 5: ["three"]}


def test_overlapping_clusters_become_one(spark):
    clusters = spark.createDataFrame([(1, 0, "text", 0.9, 0.0, 0.0, 100.0, 50.0), (1, 1, "text", 0.6, 2.0, 1.0, 99.0, 49.0), (1, 2, "text", 0.9, 0.0, 90.0, 50.0, 99.0)], "page_id long, cluster_id long, label string, confidence double, l double, t double, r double, b double")
    cells = spark.createDataFrame([(1, 0, 1.0, 1.0, 60.0, 40.0, "a"), (1, 1, 3.0, 2.0, 62.0, 41.0, "b"), (1, 2, 5.0, 92.0, 9.0, 95.0, "c")], "page_id long, cell_ix long, l double, t double, r double, b double, text string")
    found, assigned = layout.refined(clusters, cells, spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 2, 2)], "page_id long, cell_ix long, cluster_id long"))
    assert {r.cluster_id: (r.l, r.b) for r in found.collect()} == {0: (1.0, 41.0), 2: (5.0, 95.0)}
    assert {(r.cell_ix, r.cluster_id) for r in assigned.collect()} == {(0, 0), (1, 0), (2, 2)}


def test_similarity_is_the_share_of_matching_blocks(spark):
    from difflib import SequenceMatcher

    pairs = [("abcd", "bcde"), ("", ""), (None, "x"), ("same", "same"), ("private Thread", "private volatile Thread")]
    found = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(text.similarity("a", "b")).collect()]
    assert found == [SequenceMatcher(None, a or "", b or "").ratio() for a, b in pairs]


def test_late_rows_of_a_stream_are_dropped(spark, tmp_path):
    from vellum.streaming import windows

    rows = [("2024-01-01 10:05:00", 1.0), ("2024-01-01 14:00:00", 2.0), ("2024-01-01 10:06:00", 4.0), ("2024-01-01 18:00:00", 8.0)]
    schema = "ts timestamp, event_type string, user_id long, value double"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for i, (ts, value) in enumerate(rows):
        part = spark.createDataFrame([("view", 1, value)], "event_type string, user_id long, value double").selectExpr(f"timestamp'{ts}' as ts", "event_type", "user_id", "value")
        part.coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        file = next((tmp_path / f"part{i}").glob("*.parquet"))
        file.rename(tmp_path / "in" / f"{i}.parquet")
        query = windows.counted(stream, "1 hour", late="30 minutes").writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).format("parquet").option("path", str(tmp_path / "out")).start()
        query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(str(r.opens)[11:13], r.n, r.total) for r in found} >= {("10", 1, 1.0), ("14", 1, 2.0)} and not any(r.total == 4.0 or r.n == 2 for r in found)


def test_chunks_keep_order_and_limit(spark):
    items = [(1, i, "h" if i < 3 else "g", " ".join(f"w{i}_{j}" for j in range(n))) for i, n in enumerate([3, 4, 5, 2, 25])]
    found = chunking.greedy_chunks(spark.createDataFrame(items, "doc_id long, pos long, heading string, text string"), 8).orderBy("chunk_id").collect()
    assert [r.n_tokens for r in found] == [7, 5, 2, 8, 8, 8, 1]
    assert " ".join(" ".join(r.text.split()) for r in found) == " ".join(i[3] for i in items)


def test_greedy_matching_uses_each_box_once(spark):
    schema = "page_id long, cluster_id long, l double, t double, r double, b double"
    one = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0)], schema)
    two = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0), (1, 1, 0.0, 0.0, 10.0, 10.0), (2, 0, 0.0, 0.0, 1.0, 1.0)], schema)
    assert {r.page_id: r.mean_iou for r in evaluation.greedy_iou(one, two).collect()} == {1: 0.5, 2: 0.0}


def test_greedy_matching_is_the_plain_loop_and_takes_boxes_without_area(spark):
    rng = random.Random(11)
    rows = [(side, page, i, *(v := [float(rng.randrange(6)) for _ in range(2)]), v[0] + rng.randrange(4), v[1] + rng.randrange(4)) for page in range(60) for side in (0, 1) for i in range(rng.randrange(9))]

    def score(have, boxes):
        total, have = 0.0, list(have)
        for x in boxes:
            best, at = 0.0, None
            for k, y in enumerate(have):
                w, h = min(x[2], y[2]) - max(x[0], y[0]), min(x[3], y[3]) - max(x[1], y[1])
                i = w * h if w > 0 and h > 0 else 0.0
                union = (x[2] - x[0]) * (x[3] - x[1]) + (y[2] - y[0]) * (y[3] - y[1]) - i
                if i and i / union > best:
                    best, at = i / union, k
            if best > 0.1:
                total += best
                have.pop(at)
        return total / len(boxes) if boxes else 1.0

    of = lambda page, side: [r[3:] for r in rows if r[:2] == (side, page)]
    expected = {page: score(of(page, 0), of(page, 1)) for page in {r[1] for r in rows}}
    sides = [spark.createDataFrame([r[1:] for r in rows if r[0] == side], "page_id long, cluster_id long, l double, t double, r double, b double") for side in (0, 1)]
    assert {r.page_id: r.mean_iou for r in evaluation.greedy_iou(*sides).collect()} == pytest.approx(expected)


def test_markdown_table_aligns_numbers(spark):
    cells = [(1, i, i // 2, 1, i % 2, 1) for i in range(4)]
    slots = tables.grid(spark.createDataFrame(cells, "table_id long, cell_id long, start_row long, row_span long, start_col long, col_span long"))
    texts = spark.createDataFrame([(1, 0, "name"), (1, 1, "n"), (1, 2, "a"), (1, 3, "12")], "table_id long, cell_id long, text string")
    assert tables.to_markdown(slots, texts).first().markdown == "| name |   n |\n|------|----:|\n| a    |  12 |"


@pytest.mark.parametrize("query", ["text_quality_score", "page_parse_score_p10", "confidence_report", "text_unicode_clean", "text_ligatures", "text_md_escape"])
def test_texts_are_read_to_their_ends(spark, tmp_path, query):
    from vellum.plans import catalogue

    def found(name, end):
        row = [(11, "plain words " * 50 + end + " more" * 5, "en", "web")]
        spark.createDataFrame(row, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(11, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        return catalogue.queries()[query](spark, f"{tmp_path}/{name}").collect()

    assert found("plain", "end") != found("broken", "GLYPH<0A> “q” ﬁn a_b")


def test_large_tables_are_aligned_to_tokens(spark):
    tokens = [(t, i, 10.0 * i, 1.0, 10.0 * i + 8, 9.0) for t, n in ((1, 300), (2, 301), (3, 2000)) for i in range(n)]
    final = spark.createDataFrame([(t, i, i // 2) for t, i, *_ in tokens], "table_id long, token_id long, cell_id long")
    cells = tables.aligned_to_tokens(final, spark.createDataFrame(tokens, "table_id long, token_id long, x1 double, y1 double, x2 double, y2 double")).collect()
    assert {t: sum(c.table_id == t for c in cells) for t in (1, 2, 3)} == {1: 150, 2: 151, 3: 1000}
    assert next(tuple(c) for c in cells if c.table_id == 2 and c.cell_id == 3) == (2, 3, 60.0, 1.0, 78.0, 9.0)


def test_entry_works_without_the_optional_part(tmp_path):
    import shutil
    import subprocess
    import sys

    for name in ("vellum", "__spark_entry__.py"):
        source = f"{documents.__file__.rsplit('/vellum/', 1)[0]}/{name}"
        shutil.copytree(source, tmp_path / name) if name == "vellum" else shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'assign_cells' in q and not any(k.startswith('op1') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
