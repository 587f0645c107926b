"""Chunks by tokenizer: limits, whole texts, and the windows of a plain loop."""

import random
import re

import pytest

from vellum.operators import token_chunks, tree
from vellum.plans import chunk_queries
from vellum.plans.fixtures import view

SMALL = "/root/testdata/sf0.001"


def windows_by_loops(groups, limit, count, split):
    """Windows with a start and an end over the items of each chunk, then pieces, then windows over all chunks."""
    size = lambda headings, text: count("\n".join([*headings, text]))
    chunks = []
    for headings, items in groups:
        start = end = 0
        while end < len(items):
            text = "\n".join(t for _, t in items[start : end + 1])
            if size(headings, text) <= limit:
                if end < len(items) - 1:
                    end += 1
                    continue
                chunks.append((headings, text))
                end = len(items)
            elif start == end:
                chunks.append((headings, text))
                end += 1
                start = end
            else:
                chunks.append((headings, "\n".join(t for _, t in items[start:end])))
                start = end
    pieces = [(h, p) for h, t in chunks for p in ([t] if size(h, t) <= limit else split(h, t))]
    out, at = [], 0
    while at < len(pieces):
        end = at + 1
        while end < len(pieces) and pieces[end][0] == pieces[at][0] and size(pieces[at][0], "\n".join(p for _, p in pieces[at : end + 1])) <= limit:
            end += 1
        out.append((pieces[at][0], "\n".join(p for _, p in pieces[at:end])))
        at = end
    return out


def words(text):
    return [m.span() for m in re.finditer(r"\S+", text)]


def split_by_words(limit):
    def split(headings, text):
        room = limit - sum(len(words(h)) for h in headings)
        found = words(text)
        return [text[found[i][0] : found[min(i + room, len(found)) - 1][1]] for i in range(0, len(found), room)]

    return split


def test_windows_are_those_of_a_plain_loop():
    rng = random.Random(6)
    for _ in range(400):
        limit = rng.randrange(4, 12)
        heads = [("h",), ("h", "two words"), ()]
        groups = [(rng.choice(heads), [(k, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 16)))) for k in range(rng.randrange(1, 5))]) for _ in range(rng.randrange(1, 6))]
        chunker = token_chunks.Chunker(limit, lambda t: len(words(t)), words, True)
        found = [(c.headings, c.text) for c in chunker.document(groups)]
        assert found == windows_by_loops(groups, limit, lambda t: len(words(t)), split_by_words(limit)), groups


@pytest.fixture(scope="module")
def path():
    return chunk_queries.vocabulary_path()


def test_no_chunk_is_over_the_limit_and_no_text_is_lost(spark, path):
    walk = tree.walked(view(spark, SMALL, "d_tree")).persist()
    items = token_chunks.items_of(walk).collect()
    squeezed = lambda t: re.sub(r"\s+", "", t)
    expected = {}
    for r in sorted(items, key=lambda r: (r.doc_id, r.pos)):
        expected[r.doc_id] = expected.get(r.doc_id, "") + squeezed(r.part)
    for limit in (6, 24, 1000):
        found = token_chunks.hybrid(walk, limit, path).collect()
        count = lambda t: len(token_chunks.tokenizer(path).encode(t, add_special_tokens=False).ids)
        texts = {}
        for r in sorted(found, key=lambda r: (r.doc_id, r.chunk_id)):
            texts[r.doc_id] = texts.get(r.doc_id, "") + squeezed(r.text)
            form = "\n".join([*(r.headings if r.with_headings else []), r.text])
            assert count(form) == r.n_tokens and (r.n_tokens <= limit or len(r.text) == 1)
        assert texts == expected
        if limit == 1000:
            assert all(r.with_headings for r in found)
        if limit == 6:
            assert not all(r.with_headings for r in found)


def test_long_and_odd_texts_are_cut(spark, path):
    rows = [(1, 0, None, 0, "text", "body", 0, 1, "many words here " * 300), (2, 0, None, 0, "text", "body", 0, 1, "x" * 5000), (3, 0, None, 0, "text", "body", 0, 1, "é漢字🙂" * 200), (4, 0, None, 0, "title", "body", 0, 1, "only a title")]
    nodes = spark.createDataFrame(rows, "doc_id long, node_id long, parent_id long, child_ix long, label string, layer string, level long, page_no long, text string")
    found = token_chunks.hybrid(tree.walked(nodes), 16, path).orderBy("doc_id", "chunk_id").collect()
    assert {r.doc_id for r in found} == {1, 2, 3} and max(r.n_tokens for r in found) <= 16
    for r in rows[:3]:
        assert re.sub(r"\s+", "", "".join(c.text for c in found if c.doc_id == r[0])) == re.sub(r"\s+", "", r[-1])
    assert all(re.fullmatch(r"(many|words|here)( (many|words|here))*", c.text) for c in found if c.doc_id == 1)
    assert token_chunks.hybrid(tree.walked(nodes.limit(0)), 16, path).count() == 0


def test_token_counts(spark, path):
    texts = spark.createDataFrame([(1, "two words"), (2, None), (3, "")], "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in token_chunks.token_counts(texts, path).collect()}
    assert found == {1: len(token_chunks.tokenizer(path).encode("two words").ids), 2: 0, 3: 0}
