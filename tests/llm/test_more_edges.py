"""Clashing names, ties and empty tables of packing, the two vector searches and url filters."""

import math

from pyspark.sql import functions as F

from llm import op03_packing, op04_multi_index, op06_url_filters, op08_exact_top_k
from llm.tables import written

PIECES = [(1, 0, 0, 5), (2, 0, 0, 5), (2, 0, 0, 5), (None, 0, 0, 3), (3, 0, 0, 8), (3, 1, 8, 2), (4, 0, 0, 8)]


def test_packing_of_ties_and_clashing_names(spark):
    pieces = spark.createDataFrame(PIECES, "doc_id long, piece int, start long, length long").withColumn("ids_crc32", F.lit(0).cast("long"))
    found = op03_packing.pack(written(pieces, "pieces"), 8)
    rows = found.collect()
    assert found.columns[-2:] == ["sequence_id", "offset"] and sorted(map(str, ((r.doc_id, r.piece, r.start, r.length) for r in rows))) == sorted(map(str, PIECES))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 8
    assert len(sequences) == math.ceil(sum(p[3] for p in PIECES) / 8)
    assert op03_packing.pack(written(pieces.limit(0), "pieces"), 8).count() == 0


VECTORS = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [float("nan"), 1.0]), (6, [1.0, None]), (None, [1.0, 1.0]), (7, [0.0, 0.0]), (8, [1.0, 2.0, 3.0])]


def vectors_of(spark):
    return spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>").withColumns({"score": F.lit("mine"), "rank": F.lit(1), "BLOCK": F.lit(2), "norm": F.lit("x")})


def test_searches_of_ties_odd_vectors_and_clashing_names(spark):
    vectors = vectors_of(spark)
    near = op04_multi_index.search(vectors, vectors.where("vec_id in (1, 8)"), k=3, visit=1.0)
    assert [tuple(r) for r in near.orderBy("query_id", "rank").collect()] == [(1, 1, 2, 1.0), (1, 2, 2, 1.0), (1, 3, 3, 0.0)]
    best = op08_exact_top_k.search(vectors, vectors.where("vec_id in (1, 8)"), k=4)
    assert [tuple(r) for r in best.orderBy("query_id", "rank").collect()] == [(1, 1, 2, 1 << 20), (1, 2, 2, 1 << 20), (1, 3, 3, 0), (1, 4, 7, 0)]


def test_searches_of_nothing(spark):
    vectors = vectors_of(spark)
    for search in (op04_multi_index.search, op08_exact_top_k.search):
        assert search(vectors.limit(0), vectors).count() == 0 and search(vectors, vectors.limit(0)).count() == 0
        assert search(vectors.where("vec_id in (4, 5, 6)"), vectors.where("vec_id in (4, 5, 6)")).count() == 0


def test_urls_keep_other_columns(spark):
    long = "http://a.b/" + "x" * 200_000
    pages = spark.createDataFrame([(1, "HTTP://Www.B.com/en/x?y#z"), (1, "HTTP://Www.B.com/en/x?y#z"), (2, None), (3, "b.com/en/"), (4, "x://"), (5, long), (6, "x://bb.com/en/")], "page_id long, url string")
    pages = pages.withColumns({"HOST": F.lit("mine"), "Verdict": F.lit("mine"), "key": F.lit("k"), "salt": F.lit("s"), "stack": F.lit(3)})
    rules = spark.createDataFrame([("b.com", "/en", "block"), ("b.com", "/en", "allow"), ("com", None, "allow"), ("", "/", "block"), (None, "/", "block")], "host string, path string, verdict string")
    found = op06_url_filters.judge(pages, rules)
    assert {c.lower() for c in found.columns} == {"page_id", "url", "key", "salt", "stack", "host", "path", "rule", "verdict"} and len(found.columns) == 9
    rows = sorted((r.page_id, r.host, r.path[:6], r.rule, r.verdict) for r in found.select("page_id", "host", "path", F.coalesce("rule", F.lit("-")).alias("rule"), "verdict").collect())
    assert rows == [(1, "www.b.com", "/en/x", "b.com/en", "block")] * 2 + [(2, "", "", "-", "allow"), (3, "", "", "-", "allow"), (4, "", "", "-", "allow"), (5, "a.b", "/xxxxx", "-", "allow"), (6, "bb.com", "/en/", "com", "allow")]
    assert op06_url_filters.judge(pages, rules.limit(0)).where("verdict <> 'allow'").count() == 0 and op06_url_filters.judge(pages.limit(0), rules).count() == 0
