"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before kept, and returns a
DataFrame; all but the last return the columns of docs. Filters keep every document that they have
no reason to reject:

- quality: documents that the classifier scores under 0.5 go (op. 5, fitted on ``labels``);
- language: documents without a letter, or farther from every centroid than held-out documents of
  their length or more by ``SLACK``, go (op. 9);
- near_duplicates: documents are linked from a Jaccard index of 0.8 of their five-word shingles;
  one of each group of linked ones stays, that of the smallest doc_id; rows that repeat doc_id
  and text count as one; rows with a null doc_id stay (op. 7, whose query has 4 words and 0.85);
- substring: words under 50-word windows of smaller documents go; a document that loses none keeps
  its text as it is, one that loses all stays with an empty text (op. 2);
- packing: documents are tokenised and packed into sequences of 2048 (op. 3); it returns pieces with their place, and no other column.

Defined cases: a null or empty text is scored by the intercept of the quality model, goes at the language stage, and is an empty
document for the others; texts are read whole, however long; a null doc_id stays in all stages, and takes no part in links and windows; rows that
repeat are judged alike, and of equal rows of one doc_id one stays; two near texts under one doc_id both stay, as each is the
smallest of its group; columns named like what a stage makes keep their own values, since stages pass on the columns of docs;
ids have to be integers; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import op02_substring, op03_packing, op05_quality, op07_jaccard_join, op09_language
from llm.tables import held_out, table, written
from llm.vocab import public_path

#: Share of the LOW quantile of held-out cosines under which a document is taken for no known language, and that quantile.
SLACK = 0.75
LOW = 0.01
#: The least cosine where no held-out document is as long.
REJECT = 0.05
#: Near copies: words of a shingle, and the least Jaccard index of two linked documents in percent.
SHINGLE = 5
NEAR = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    scored = op05_quality.score(docs, op05_quality.fit(docs, labels))
    return scored.where("predicted = 1").select(*docs.columns)


def least_cosine(docs: DataFrame, model: op09_language.Model) -> Column:
    """The cosine that a document needs, by its length in powers of two; shorter texts never need more than longer ones."""
    size = F.floor(F.log2(F.length("text") + F.lit(1.0))).cast("int")
    held = op09_language.identify(docs.where("lang is not null").where(held_out("doc_id", 4, 2)), model).where("lang_pred = lang")
    low = dict(map(tuple, held.groupBy(size.alias("size")).agg(F.percentile_approx("score", LOW)).collect()))
    needed, least = [], None
    for n in range(31, -1, -1):
        if n in low:
            least = min(low[n], low[n] if least is None else least)
        needed.append(F.lit(REJECT if least is None else SLACK * least))
    return F.element_at(F.array(*reversed(needed)), size + 1)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op09_language.fit(docs.where(~held_out("doc_id", 4, 2)))
    found = op09_language.identify(docs, model)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= least_cosine(docs, model))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = op07_jaccard_join.join(docs, k=SHINGLE, percent=NEAR, distinct=True)
    return found.where("doc_id is null or doc_id = component_id").select(*docs.columns)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = op02_substring.dedup(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    found = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = written(op03_packing.pieces_of(docs, public_path("word_bpe_49k.json")), "pieces")
    return op03_packing.pack(pieces)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("substring", substring), ("packing", packing)]

#: SQL cannot express the fitted models, hashing and tokenizers of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
