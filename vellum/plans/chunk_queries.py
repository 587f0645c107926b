"""Queries over chunks whose limits a tokenizer counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators import token_chunks, tree
from vellum.plans.fixtures import base, view
from vellum.sources import markup

#: The most tokens of a chunk in the queries.
LIMIT = 24


def vocabulary_path() -> str:
    from public_tokenizers import path

    return path("word_bpe_49k.json")


def chunk_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of all trees."""
    return token_chunks.hybrid(tree.walked(view(spark, d, "d_tree")), LIMIT, vocabulary_path())


def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of whole texts of ``documents``, read as Markdown, by 256 tokens."""
    nodes = markup.markdown(base(spark, d, "documents").select("doc_id", "text"))
    found = token_chunks.hybrid(tree.walked(nodes), 256, vocabulary_path())
    return found.select("doc_id", "chunk_id", "n_tokens", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def document_tokens(spark: SparkSession, d: str) -> DataFrame:
    """How many tokens each whole text has."""
    return token_chunks.token_counts(base(spark, d, "documents").select("doc_id", "text"), vocabulary_path()).select("doc_id", "n_tokens")


SQL: dict[str, str] = {}

QUERIES = (chunk_tokens, chunk_documents, document_tokens)
