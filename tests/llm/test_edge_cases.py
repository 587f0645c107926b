"""Nulls, empty and very long texts, repeated rows, clashing names and empty tables, for operators and stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import op01_suffix_array, op02_substring, op03_packing, op05_quality, op07_jaccard_join, op09_language, op10_byte_bpe
from llm.vocab import public_path

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i}" for i in range(60_000))
ROWS = [
    (1, None, None, "s", 0), (2, "", "en", None, 0), (3, " \n\t", "en", "s", 3), (4, "one", None, "s", 3), (5, LONG, "en", "s", len(LONG)), (6, LONG, "en", "s", len(LONG)),
    (7, "twice the same row", "en", "s", 18), (7, "twice the same row", "en", "s", 18), (None, "no id at all here", "en", "s", 17), (8, "123 456 !!", "en", "s", 10), (9, "\x00   é", "fr", "s", 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")


WORK = {
    "bytes": op01_suffix_array.dedup,
    "words": op02_substring.dedup,
    "pieces": lambda d: op03_packing.pieces_of(d, public_path("word_bpe_49k.json")),
    "quality": lambda d: op05_quality.score(d, [0.0] * (op05_quality.BUCKETS + 1)),
    "jaccard": op07_jaccard_join.join,
    "language": lambda d: op09_language.identify(d, op09_language.fit(d)),
    "tokens": lambda d: op10_byte_bpe.encode(d, public_path("byte_bpe_50k.json"), decoded="decoded"),
}
MADE = {"bytes": "kept", "words": "kept", "quality": "score", "jaccard": "component_id", "language": "lang_pred", "tokens": "ids"}


@pytest.mark.parametrize("name", WORK)
def test_odd_rows_and_clashing_names(odd, name):
    made = MADE.get(name)
    documents = odd.withColumn("row", F.lit("mine")).withColumn("spans", F.lit(1))
    if made:
        documents = documents.withColumn(made.upper(), F.lit("mine"))
    found = WORK[name](documents)
    if name == "pieces":
        assert found.select("doc_id").distinct().count() == 10 and found.agg(F.max("length")).first()[0] <= 2048
    else:
        assert found.count() == len(ROWS) and [c for c in found.columns if c.lower() == made] == [made]
        assert {r[0] for r in found.select("row").distinct().collect()} == {"mine"}


@pytest.mark.parametrize("name", WORK)
def test_no_rows(odd, name):
    assert WORK[name](odd.limit(0)).count() == 0


@pytest.mark.parametrize("at", range(5))
def test_stages_take_odd_and_no_rows(spark, odd, at):
    name, stage = corpus_pipeline.STAGES[at]
    found = stage(spark, odd, SMALL)
    ids = [r.doc_id for r in found.select("doc_id").collect()]
    if at < 4:
        assert found.columns == odd.columns
    if name == "language":
        assert not {1, 2, 3, 8} & set(ids)
    if name == "near_duplicates":
        assert sorted(map(str, ids)) == sorted(map(str, [1, 2, 3, 4, 5, 7, None, 8, 9]))
    if name == "substring":
        kept = {r.doc_id: r.text for r in found.collect()}
        assert kept[5] == LONG and kept[6] == "" and len(ids) == len(ROWS)
    if name == "packing":
        assert set(ids) == {r[0] for r in ROWS}
    assert stage(spark, odd.limit(0), SMALL).count() == 0


def test_near_duplicates_are_linked_from_four_fifths_of_five_word_shingles(spark):
    def edited(name, at):
        return " ".join(f"{name}x{i}" if i in at else f"{name}{i}" for i in range(190))

    def jaccard(a, b, k):
        a, b = ({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for w in (a.split(), b.split()))
        return len(a & b) / len(a | b)

    near, far = [edited("a", ()), edited("a", (30, 70, 110, 150))], [edited("b", ()), edited("b", (20, 50, 80, 110, 150))]
    assert jaccard(*near, 5) >= 0.8 and jaccard(*near, 4) < 0.85 and jaccard(*far, 5) < 0.8
    docs = spark.createDataFrame(list(enumerate(near + far)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 2, 3]


def test_unlearned_languages_go_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    clean = docs.where("text rlike '[a-z]'")
    german = docs.where("lang = 'de' and length(text) > 300").select((F.col("doc_id") + 10**6).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"))
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa."
    odd = german.unionByName(spark.createDataFrame([(10**7, polish, None)], "doc_id long, text string, lang string"))
    kept = corpus_pipeline.language(spark, clean.where("lang <> 'de'").unionByName(odd), SMALL)
    assert kept.where("doc_id >= 1000000").count() <= 0.02 * german.count() and kept.where("doc_id = 10000000").count() == 0
    assert corpus_pipeline.language(spark, clean, SMALL).count() >= 0.995 * clean.count()
