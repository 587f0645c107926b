"""Ids of every integer type, and words that a polynomial modulo 2**64 would take for one."""

import numpy as np
import pytest

from llm import op01_suffix_array, op02_substring, op07_jaccard_join
from llm.hashing import word_hashes

TWINS = tuple("".join("ab"[(i.bit_count() + turn) % 2] for i in range(1024)) for turn in (0, 1))
FILL = [f"w{i}" for i in range(60)]
TEXT = " ".join(FILL)


@pytest.mark.parametrize("kind", ["byte", "short", "int", "long"])
def test_ids_of_every_integer_type(spark, kind):
    docs = spark.createDataFrame([(1, TEXT), (2, "before " + TEXT), (3, "other")], f"doc_id {kind}, text string")
    assert sorted((r.doc_id, r.n_removed) for r in op01_suffix_array.dedup(docs).collect()) == [(1, len(TEXT)), (2, len(TEXT)), (3, 0)]
    assert sorted((r.doc_id, r.n_removed) for r in op02_substring.dedup(docs).collect()) == [(1, 0), (2, 60), (3, 0)]


def test_ids_of_other_types_are_refused(spark):
    docs = spark.createDataFrame([("a", TEXT)], "doc_id string, text string")
    for operator in (op01_suffix_array, op02_substring):
        with pytest.raises(TypeError, match="integer"):
            operator.dedup(docs)


def test_twin_words_differ(spark):
    data = np.frombuffer(" ".join(TWINS).encode(), dtype=np.uint8)
    hashes, rows = word_hashes(data, np.array([0, len(data)]))
    assert rows.tolist() == [0, 2] and hashes[0] != hashes[1]
    texts = [" ".join([*FILL[:25], word, *FILL[25:49]]) for word in TWINS]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    assert {r.n_removed for r in op02_substring.dedup(docs).collect()} == {0}
    pairs = spark.createDataFrame([(i, " ".join([f"only{i}x{w}"[:9] if w else word for w in range(4)])) for i, word in enumerate(TWINS, 1)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in op07_jaccard_join.join(pairs).collect()) == [(1, 1), (2, 2)]
    alone = spark.createDataFrame(list(enumerate(TWINS, 1)), "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in op07_jaccard_join.join(alone).collect()) == [(1, 1), (2, 2)]


def test_periodic_bytes_differ(spark):
    texts = ["".join(t)[:256] for t in TWINS]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    found = {r.doc_id: r.n_removed for r in op01_suffix_array.dedup(docs).collect()}
    starts = {t[i : i + 200] for t in texts[:1] for i in range(57)} & {texts[1][i : i + 200] for i in range(57)}
    assert found == {1: 0, 2: 0} and not starts
