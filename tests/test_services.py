"""Articles in XML, SQL table functions, parted boxes, and the store of finished jobs."""

import base64
import hashlib
import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.operators import overlaps, tree
from vellum.plans import document_queries, service_queries, table_queries
from vellum.sources import jats, markup
from vellum.sources.shared import listed
from vellum.streaming import sinks

SMALL = "/root/testdata/sf0.001"

ARTICLE = """<?xml version="1.0"?><!DOCTYPE article PUBLIC "-//NLM//DTD JATS//EN" "JATS-archivearticle1.dtd">
<article><front><article-meta><title-group><article-title>A title</article-title><subtitle>sub</subtitle></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Doe</surname><given-names>Jo</given-names></name><xref ref-type="aff" rid="a"/><xref ref-type="aff" rid="b"/></contrib>
<contrib contrib-type="author"><name><surname>Roe</surname><given-names>Al</given-names></name><xref ref-type="aff" rid="a"/></contrib><contrib contrib-type="editor"><name><surname>No</surname></name></contrib></contrib-group>
<aff id="a"><label>1</label>Place</aff><aff id="b">Other</aff><abstract><p>First.</p><p>Second <b>bold</b> one.</p></abstract></article-meta></front>
<body><p>Opening.</p><sec><title>One</title><p>Text with <italic>style</italic> and <inline-formula>x</inline-formula> more
lines.<list><list-item><p>item a</p></list-item><list-item><label>2</label><p>item b</p></list-item></list>after the list</p>
<sec><title>Inner</title><fig><label>Fig 1</label><caption><p>What it shows.</p></caption></fig><disp-formula><tex-math>$$a+b$$</tex-math></disp-formula>
<table-wrap><label>T</label><caption><p>Sizes</p></caption><table><tr><th>h</th><th>i</th></tr><tr><td rowspan="2">1</td><td>2</td></tr><tr><td>3</td></tr></table></table-wrap></sec></sec>
<sec><p>No heading.</p></sec></body>
<back><ack><p>Thanks.</p></ack><ref-list><ref><label>1</label><element-citation><name><surname>A</surname><given-names>B.</given-names></name><etal/><article-title>T</article-title><source>J</source><volume>3</volume><fpage>1</fpage><lpage>9</lpage><year>2001</year><pub-id pub-id-type="doi">10.1/x</pub-id></element-citation></ref>
<ref><mixed-citation>As <b>is</b>, 2002.</mixed-citation></ref><ref><element-citation>Book text<publisher-name>P</publisher-name><publisher-loc>L</publisher-loc><year>1999</year></element-citation></ref></ref-list><fn-group><fn>not shown</fn></fn-group></back></article>"""


def test_an_article(spark):
    files = spark.createDataFrame([(1, ARTICLE), (2, "<article>"), (3, None), (4, "<article/>")], "doc_id long, text string")
    nodes = jats.articles(files)
    walk = tree.walked(nodes).where("doc_id = 1").orderBy("pos").collect()
    assert [(r.depth, r.label, r.level, r.text) for r in walk] == [
        (0, "title", 0, "A title sub"), (1, "paragraph", 0, "Jo Doe, Al Roe"), (1, "paragraph", 0, "Place; Other"), (1, "section_header", 1, "Abstract"), (2, "text", 0, "First. Second bold one."),
        (1, "text", 0, "Opening."), (1, "section_header", 1, "One"), (2, "text", 0, "Text with style and  more lines."), (2, "list", 0, ""), (3, "list_item", 0, "item a"), (3, "list_item", 0, "2item b"), (2, "text", 0, "after the list"),
        (2, "section_header", 2, "Inner"), (3, "picture", 0, ""), (4, "caption", 0, "Fig 1 What it shows."), (3, "formula", 0, "a+b"), (3, "table", 0, "|h|i|\n|1|2|\n|1|3|"), (4, "caption", 0, "T Sizes"), (2, "text", 0, "No heading."),
        (1, "section_header", 1, "Acknowledgments"), (2, "text", 0, "Thanks."), (1, "section_header", 1, "References"), (2, "list", 0, ""),
        (3, "list_item", 0, "A B., et al. T. J 3:1–9 (2001). DOI: 10.1/x"), (3, "list_item", 0, "As is, 2002."), (3, "list_item", 0, "Book text. L: P (1999)."),
    ]
    others = {(r.doc_id, r.label) for r in nodes.where("doc_id > 1").collect()}
    assert others == {(2, "invalid"), (4, "title")}
    cells = markup.table_cells(nodes)
    assert {(r.row, r.col, r.text) for r in cells.collect()} == {(0, 0, "h"), (0, 1, "i"), (1, 0, "1"), (1, 1, "2"), (2, 0, "1"), (2, 1, "3")}


def test_articles_keep_the_words_of_their_documents(spark):
    nodes = service_queries.jats_nodes(spark, SMALL)
    assert nodes.where("label = 'invalid'").count() == 0
    body = {r.doc_id: r.text for r in nodes.where("label = 'text' and parent_id = 5").collect()}
    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    words = lambda t: re.findall(r"\w+", t)
    assert {i: words(body.get(i, "")) for i in given} == {i: words(t) for i, t in given.items()}


# -- SQL functions ---------------------------------------------------------------------------------


def rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_table_functions_give_what_the_operators_give(spark):
    assert rows(service_queries.otsl_slots_sql(spark, SMALL)) == rows(table_queries.otsl_explode(spark, SMALL))
    assert rows(service_queries.packed_lines_sql(spark, SMALL)) == rows(document_queries.chunk_hybrid(spark, SMALL))


def test_the_aggregate_skips_nulls(spark):
    service_queries.table_functions.register(spark)
    found = spark.sql("SELECT k, percentile_95(v) AS p FROM VALUES (1, 1), (1, 3), (1, NULL), (2, NULL) AS t(k, v) GROUP BY k")
    assert {r.k: r.p for r in found.collect()} == {1: pytest.approx(2.9), 2: None}


# -- boxes -------------------------------------------------------------------------------------------


def parted_by_loops(boxes):
    boxes = [list(b) for b in boxes]
    for i in range(len(boxes)):
        for j in range(i + 1, len(boxes)):
            a, b = boxes[i], boxes[j]
            ox, oy = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
            if ox <= 0 or oy <= 0:
                continue
            k, o = (0, ox) if ox < oy else (1, oy)
            first, second = (a, b) if a[k] < b[k] else (b, a)
            first[k + 2] -= math.ceil(o / 2) + 2
            second[k] += math.floor(o / 2)
            boxes[i] = [min(a[0], a[2]), min(a[1], a[3]), max(a[0], a[2]), max(a[1], a[3])]
            boxes[j] = [min(b[0], b[2]), min(b[1], b[3]), max(b[0], b[2]), max(b[1], b[3])]
    return boxes


def test_boxes_are_parted_pair_by_pair(spark):
    rng = random.Random(8)
    tables, expected = [], set()
    for table in range(200):
        boxes = []
        for _ in range(rng.randrange(12)):
            x, y = rng.randrange(60), rng.randrange(60)
            boxes.append((x, y, x + rng.choice([0, 1, 3, 20, 40]), y + rng.choice([0.5, 2, 15, 30])))
        tables += [(table, i, *map(float, b)) for i, b in enumerate(boxes)]
        expected |= {(table, i, *b) for i, b in enumerate(parted_by_loops(boxes))}
    found = overlaps.without_overlaps(spark.createDataFrame(tables, "table_id long, cell_id long, x1 double, y1 double, x2 double, y2 double"))
    assert {tuple(r) for r in found.collect()} == expected
    assert overlaps.parted(np.empty((0, 4))).shape == (0, 4)


def test_parted_cells_of_all_tables(spark):
    found = service_queries.table_cells_parted(spark, SMALL).collect()
    assert len(found) == spark.read.parquet(f"{SMALL}/lineitem.parquet").count() and all(r.x1 <= r.x2 and r.y1 <= r.y2 for r in found)


# -- the store -----------------------------------------------------------------------------------------

PNG, JPG = base64.b64encode(b"one picture").decode(), base64.b64encode(b"one picture, longer").decode()
NAMES = [f"artifacts/image_{hashlib.sha256(d).hexdigest()}.{e}" for d, e in ((b"one picture", "png"), (b"one picture, longer", "jpeg"))]


@pytest.fixture
def jobs(spark):
    text = f"![a](data:image/png;base64,{PNG}) and ![b](data:image/jpeg;base64,{JPG}) again data:image/png;base64,{PNG} not data:text/plain;base64,AAAA"
    given = [("u", "1", text, json.dumps({"p": f"data:image/png;base64,{PNG}"}), 2, None), ("u", "2", "no picture", "{}", 1, None), ("v", "1", None, None, 3, "broken")]
    return spark.createDataFrame(given, "user_id string, job_id string, markdown string, elements string, pages long, error string")


def test_pictures_are_named_by_their_content(spark, jobs):
    found = {(r.user_id, r.job_id): r for r in sinks.externalised(jobs, "markdown", "elements").collect()}
    assert found["u", "1"].markdown == f"![a]({NAMES[0]}) and ![b]({NAMES[1]}) again {NAMES[0]} not data:text/plain;base64,AAAA"
    assert json.loads(found["u", "1"].elements) == {"p": NAMES[0]} and len(found["u", "1"].uris) == 2 and found["v", "1"].markdown is None
    pictures = spark.createDataFrame([(NAMES[0], bytearray(b"one picture")), (NAMES[1], bytearray(b"one picture, longer"))], "name string, data binary")
    again = sinks.embedded(sinks.externalised(jobs, "markdown").where("user_id = 'u'"), "markdown", pictures)
    assert {r.job_id: r.markdown for r in again.collect()} == {r.job_id: r.markdown for r in jobs.where("user_id = 'u'").collect()}


def everything(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file() and "completed" not in p.parts}


def test_a_batch_delivered_twice_leaves_one_copy(spark, jobs, tmp_path):
    store = sinks.stored(f"file://{tmp_path}")
    store(jobs, 7)
    once = everything(tmp_path)
    assert set(once) == {"processed/u/1/output.md", "processed/u/1/elements.json", "processed/u/2/output.md", "processed/u/2/elements.json", *NAMES}
    assert once[NAMES[0]] == b"one picture" and once["processed/u/2/output.md"] == b"no picture"
    store(jobs, 7)
    store(jobs.where("job_id = '1'"), 8)
    assert everything(tmp_path) == once
    record = {(r.batch, r.user_id, r.job_id): r for r in spark.read.parquet(f"{tmp_path}/completed").collect()}
    assert len(record) == 5 and record[7, "u", "1"].status == "completed" and record[7, "u", "1"].md_key == "processed/u/1/output.md" and list(record[7, "u", "1"].pictures) == sorted(NAMES)
    assert (record[7, "v", "1"].status, record[7, "v", "1"].message, record[7, "v", "1"].md_key) == ("failed", "broken", None)
    store(jobs.limit(0), 9)
    assert spark.read.parquet(f"{tmp_path}/completed/batch=9").count() == 0 and not listed(str(tmp_path / "processed/u/1"), ".part")


def test_a_job_whose_picture_is_not_stored_fails(spark, jobs, tmp_path):
    (tmp_path / "artifacts").write_text("a file where the folder should be")
    sinks.stored(f"file://{tmp_path}")(jobs, 1)
    record = {(r.user_id, r.job_id): r.status for r in spark.read.parquet(f"{tmp_path}/completed").collect()}
    assert record == {("u", "1"): "failed", ("u", "2"): "completed", ("v", "1"): "failed"}
    assert not spark.read.parquet(f"{tmp_path}/completed").where(F.col("status") == "failed").where("message is null").count()
