"""The queries of this subpackage, and their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from llm.op01_suffix_array import op1_suffix_array_dedup
from llm.op02_substring import op2_substring_dedup
from llm.op03_packing import op3_best_fit_packing
from llm.op04_multi_index import op4_inverted_multi_index
from llm.op05_quality import op5_quality_classifier
from llm.op06_url_filters import ORACLE_SQL as URL_FILTERS_SQL
from llm.op06_url_filters import op6_url_filters
from llm.op07_jaccard_join import op7_jaccard_join
from llm.op08_exact_top_k import ORACLE_SQL as EXACT_TOP_K_SQL
from llm.op08_exact_top_k import op8_exact_top_k
from llm.op09_language import op9_language_id
from llm.op10_byte_bpe import op10_byte_bpe
from llm.op11_lexical_search import ORACLE_SQL as LEXICAL_SEARCH_SQL
from llm.op11_lexical_search import op11_lexical_search
from llm.op12_simhash import op12_simhash_near_dedup
from llm.op13_conversation_repair import op13_conversation_repair


QUERIES = (
    op1_suffix_array_dedup,
    op2_substring_dedup,
    op3_best_fit_packing,
    op4_inverted_multi_index,
    op5_quality_classifier,
    op6_url_filters,
    op7_jaccard_join,
    op8_exact_top_k,
    op9_language_id,
    op10_byte_bpe,
    op11_lexical_search,
    op12_simhash_near_dedup,
    op13_conversation_repair,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filters": URL_FILTERS_SQL, "op8_exact_top_k": EXACT_TOP_K_SQL, "op11_lexical_search": LEXICAL_SEARCH_SQL}
