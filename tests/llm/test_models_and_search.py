"""Tokenizers, packing, classifiers, searches and url filters on small tables."""

import base64
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import op03_packing, op04_multi_index, op05_quality, op06_url_filters, op08_exact_top_k, op09_language, op10_byte_bpe, vocab
from llm.tables import held_out
from llm.vocab import public_path

ODD = ["a  b\n\n c  ", "x \n", "  lead", "it's 'S DON'T ıİΣς", "a\n \n b", "é́ ́x", "tab\t\tx  \r\n y", "<|endoftext|> x", "", " ", "\n", "a ", "日本 語　x", "ÀÉ ß ÿ", "a\u2003\n\nb"]
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoding_by_pieces_is_the_same_as_whole(name, spaced, monkeypatch):
    monkeypatch.setattr(vocab, "SLICE", 4000)
    monkeypatch.setattr(vocab, "MEMO", 50)
    draw = random.Random(3)
    alphabets = ["  \t\nabsStTrReEvVlLmMdD''''12,.\u00e9", " \x0b\x0caA\u0130\u0131\u00df\u03a3\u03c21,.'\u2019 \u200b\u0301\u00c9\u00b2\u00bd\u6f22<|>\x1c\x85_\ud7ff"]
    texts = ODD + ["".join(draw.choice(a) for _ in range(draw.randrange(30))) for a in alphabets for _ in range(3000)]
    texts += [f"a{chr(c)}{chr(c)} {chr(c)}1" for c in range(vocab.PLAIN + 200)] + ["word " * 3000]
    one = vocab.Encoder(public_path(name), spaced)
    found, whole = one.encode(pa.array([*texts, None])), vocab.packed(one.tokenizer, [*texts, ""])
    assert [t for t, x, y in zip(texts, found, whole, strict=False) if x != y] == []
    assert found[-1] == b""


def test_missing_words_are_encoded_in_lines(monkeypatch):
    words = [f"w{'abcdefghij'[i % 10]}{'xyz'[i % 3] * (i % 7)}q{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(2000)]
    one, plain, handed = vocab.Encoder(public_path("word_bpe_49k.json"), False), vocab.packed, []
    monkeypatch.setattr(vocab, "packed", lambda tokenizer, texts: handed.extend(texts) or plain(tokenizer, texts))
    found = one.encode(pa.array([" ".join(words), " ".join(words[::-1])]))
    assert found == plain(one.tokenizer, [" ".join(words), " ".join(words[::-1])])
    assert len(set(words)) > 500 and len(handed) <= len(set(words)) // vocab.LINE + 1
    # without tokens that end words, pieces are encoded one by one
    other = vocab.Encoder(public_path("word_bpe_49k.json"), False)
    other.ends[:] = False
    assert other.encode(pa.array([" ".join(words)])) == found[:1]


def test_byte_bpe_matches_the_ranks_and_decodes(spark):
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None])]
    path = public_path("byte_bpe_50k.json")
    found = op10_byte_bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, ids string"), path, decoded="decoded", offsets=True).collect()
    for r in found:
        ids = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        text = rows[r.doc_id][1] or ""
        assert ids == own.encode_ordinary(text) and bytes(r.decoded) == text.encode()
        assert all(0 <= a <= b <= len(text) for a, b in zip(r.starts, r.stops)) and (not ids or r.stops[-1] == len(text))


def test_packing_places_every_piece_once(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("word" for _ in range(rng.choice([0, 1, 5, 900, 2047, 2048, 5000])))) for i in range(60)] + [(60, None), (1, "repeated id")]
    pieces = op03_packing.pieces_of(spark.createDataFrame(rows, "doc_id long, text string"), public_path("word_bpe_49k.json"), with_ids=True).cache()
    packed = op03_packing.pack(pieces).toPandas()
    assert len(packed) == pieces.count() and packed.length.max() <= 2048
    assert all(zlib.crc32(bytes(i)) == c and len(i) == 4 * n for i, c, n in zip(packed.ids, packed.ids_crc32, packed.length))
    for _, own in packed.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= 2048
    assert packed.sequence_id.nunique() <= packed.length.sum() / 2048 * 11 / 9 + 1
    assert op03_packing.pack(pieces.limit(0)).count() == 0


def least_bins(sizes, capacity):
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= capacity:
                bins[j] += sizes[i]
                place(i + 1, bins)
                bins[j] -= sizes[i]
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_reduction_keeps_the_optimum():
    rng = random.Random(5)
    for _ in range(150):
        sizes = sorted((rng.randint(1, 20) for _ in range(8)), reverse=True)
        counts = {x: sizes.count(x) for x in sizes}
        fixed, left = op03_packing.reduce_histogram(counts, 20)
        used = sum(n for n, _ in fixed)
        rest = sorted((x for x, n in left.items() for _ in range(n)), reverse=True)
        assert sorted([x for n, s in fixed for x in s * n] + rest) == sorted(sizes)
        assert used + least_bins(rest, 20) == least_bins(sizes, 20)


def test_reduction_leaves_what_three_pieces_may_beat():
    counts = {50: 1, 40: 1, 20: 3, 16: 3}
    fixed, left = op03_packing.reduce_histogram(counts, 100)
    assert not [s for n, s in fixed if set(s) == {50, 40}]
    rest = [x for x, n in left.items() for _ in range(n)]
    assert sum(n for n, _ in fixed) + least_bins(sorted(rest, reverse=True), 100) == 2
    rng = random.Random(7)
    for _ in range(150):
        sizes = sorted((rng.choice([9, 10, 12, 13, 16, 20, 24, 30, 40, 50]) for _ in range(9)), reverse=True)
        fixed, left = op03_packing.reduce_histogram({x: sizes.count(x) for x in sizes}, 60)
        rest = sorted((x for x, n in left.items() for _ in range(n)), reverse=True)
        assert sum(n for n, _ in fixed) + least_bins(rest, 60) == least_bins(sizes, 60)


def test_quality_on_held_out_rows(spark):
    found = op05_quality.op5_quality_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    right = found.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.9
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, score string")
    assert [r.score for r in op05_quality.score(odd, np.zeros(op05_quality.BUCKETS + 1)).collect()] == [0.5, 0.5]
    assert op05_quality.fit(odd, labels.limit(0)).any() == np.False_


def test_language_on_held_out_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op09_language.fit(documents.where(~held_out("doc_id", 4, 2)))
    found = op09_language.identify(documents, model).where(held_out("doc_id", 4, 2))
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "é")], "doc_id long, text string")
    named = {r.doc_id: r.lang_pred for r in op09_language.identify(odd, model).collect()}
    assert [named[i] for i in (1, 2, 3)] == ["und"] * 3 and named[4] in model.languages
    assert {r.lang_pred for r in op09_language.identify(odd, model, reject=1.1).collect()} == {"und"}
    empty = op09_language.fit(documents.limit(0))
    assert {r.lang_pred for r in op09_language.identify(odd, empty).collect()} == {"und"}


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [1.0]), (7, rows[8][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_exact_search_against_brute_force(spark, vectors):
    data = [(r.vec_id, np.floor(1024 * np.array(r.embedding, dtype=np.float64)).astype(np.int64)) for r in vectors.collect() if r.vec_id != 2004 and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()]
    found = {}
    for r in op08_exact_top_k.search(vectors, vectors.where("vec_id % 20 = 0"), k=10).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for i, q in data:
        if i % 20 == 0:
            best = sorted((-(int(q @ x)), j) for j, x in data if j != i)[:10]
            assert sorted(found[i]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]


def test_multi_index_recall(spark, vectors):
    data = [(r.vec_id, np.array(r.embedding, dtype=np.float64)) for r in vectors.collect() if r.vec_id not in (2001, 2004) and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()]
    hits = total = 0
    rows = op04_multi_index.search(vectors, vectors.where("vec_id % 20 = 0"), k=10).toPandas()
    for i, q in data:
        if i % 20 == 0:
            best = {j for _, j in sorted((-(q @ x), j) for j, x in data if j != i)[:10]}
            own = rows[rows.query_id == i].sort_values("rank")
            assert own["rank"].tolist() == list(range(1, 11)) and (own.score.diff().dropna() <= 0).all()
            hits += len(best & set(own.vec_id))
            total += 10
    assert hits / total >= 0.9
    assert op04_multi_index.search(vectors.limit(0), vectors).count() == 0
    full = op04_multi_index.search(vectors, vectors.where("vec_id = 20"), k=10, visit=1.0).toPandas()
    query = dict(data)[20]
    assert full.sort_values("rank").vec_id.tolist() == [j for _, j in sorted((-(query * x).sum(), j) for j, x in data if j != 20)[:10]]


def test_url_filters(spark):
    urls = [None, "", "nohost", "http://a.EXAMPLE.com/en/7?x", "https://com/en/", "http://xcom/en/", "http://example.com:80/en/", "x://example.net/de/81#f", "http://net/de/", "http://b.org/es", "http://b.org/es/q", "http://a.com?/en/", "http://a-b.com/en/x"]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls * 2)], "page_id long, url string, rule string")
    rules = spark.createDataFrame([*op06_url_filters.RULES, (None, "/", "block"), ("", "", "block"), ("org", "/es/", "allow")], "host string, path string, verdict string")

    def expected(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), v, h + p) for h, p, v in op06_url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fits)[2], max(fits)[1]) if fits else (host, path, None, "allow")

    for r in op06_url_filters.judge(pages, rules).collect():
        assert (r.host, r.path, r.rule, r.verdict) == expected(urls[r.page_id % len(urls)])
    assert op06_url_filters.judge(pages, rules.limit(0)).where("verdict <> 'allow'").count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.count()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_searches_take_repeated_queries_doubles_and_every_dimension(spark, kind):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=4 if i % 3 else 6).astype("f4" if kind == "float" else "f8").tolist()) for i in range(90)]
    table = spark.createDataFrame(rows + rows[:30] + rows[:1], f"vec_id long, embedding array<{kind}>")
    queries = table.where("vec_id % 10 = 0")
    all_rows = rows + rows[:30] + rows[:1]
    near = op04_multi_index.search(table, queries, k=5, visit=1.0).toPandas()
    exact = op08_exact_top_k.search(table, queries, k=5).toPandas()
    for q in range(0, 90, 10):
        own = np.array(rows[q][1])
        plain = sorted((-float(own @ np.array(v)), i) for i, v in all_rows if i != q and len(v) == len(own))[:5]
        found = near[near.query_id == q].sort_values("rank")
        assert found.vec_id.tolist() == [i for _, i in plain] and np.abs(found.score - [-s for s, _ in plain]).max() < 1e-12
        whole = np.floor(1024 * own).astype(int)
        plain = sorted((-int(whole @ np.floor(1024 * np.array(v)).astype(int)), i) for i, v in all_rows if i != q and len(v) == len(own))[:5]
        found = exact[exact.query_id == q].sort_values("rank")
        assert list(zip(-found.score, found.vec_id, strict=True)) == plain
