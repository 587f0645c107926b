"""Walks of trees and headings in one pass, and token counts by lines and slices, against plain loops."""

import random

from vellum.operators import cells, token_chunks, tree
from vellum.plans import chunk_queries


def test_walks_are_one_pass_over_whole_documents(spark):
    rng = random.Random(7)
    rows = []
    for doc in range(40):
        for i in range(rng.choice([1, 4, 40])):
            parent = None if i == 0 or rng.random() < 0.1 else rng.choice([rng.randrange(i), rng.randrange(i), i + 3, 999])
            rows.append((doc, i, parent, rng.randrange(4), rng.choice(["list", "ordered_list", "list_item", "text"])))
    rng.shuffle(rows)
    expected = {}
    for doc in range(40):
        own = [r for r in rows if r[0] == doc]
        pos = 0

        def visit(parent, above, lists, path):
            nonlocal pos
            items = 0
            for _, node, _, ix, label in sorted((r for r in own if r[2] == parent), key=lambda r: (r[3], r[1])):  # noqa: B023
                items += label == "list_item"
                expected[doc, node] = (pos, len(path), above, items if label == "list_item" else None, lists, [*path, (ix, node)])  # noqa: B023
                pos += 1
                visit(node, label, [*lists, node] if label in tree.LISTS else lists, [*path, (ix, node)])

        visit(None, None, [], [])
    walk = tree.walked(spark.createDataFrame(rows, "doc_id long, node_id long, parent_id long, child_ix long, label string"))
    assert walk._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    found = {(r.doc_id, r.node_id): (r.pos, r.depth, r.above, r.item_ix, r.lists, [tuple(p) for p in r.path]) for r in walk.collect()}
    assert found == expected


def test_counts_of_lines_are_those_of_whole_texts():
    path = chunk_queries.vocabulary_path()
    assert token_chunks.lines_apart(path)
    count, rng = token_chunks.Counts(path), random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice([*"ab S'téΣ \t1.,<|", "\n", "<|endoftext|>", "漢", "\x85"]) for _ in range(rng.randrange(40)))
        assert count(text) == len(token_chunks.tokenizer(path).encode(text, add_special_tokens=False).ids)


def test_few_characters_are_encoded_at_a_time():
    sizes = [10, token_chunks.SLICE, token_chunks.SLICE + 5, *[1000] * 600, 0]
    parts = list(token_chunks.slices(sizes))
    assert [i for a, b in parts for i in range(a, b)] == list(range(len(sizes))) and list(token_chunks.slices([])) == []
    assert all(b - a == 1 or sum(sizes[a:b]) <= token_chunks.SLICE for a, b in parts)


def test_doubles_are_found_within_pages_without_joins(spark):
    rng = random.Random(9)
    rows = [(page, i, *(rng.choice([0.0, 0.05, 0.09, 0.1, 0.19, 0.21, 5.0, None]) for _ in range(4)), rng.choice(["a", "b", None])) for page in (1, 2, 3, None) for i in range(80)]
    frame = spark.createDataFrame(rows, "page_id long, cell_ix long, l double, t double, r double, b double, text string")
    near = lambda x, y: None not in (*x[2:], *y[2:], x[0]) and x[0] == y[0] and x[6] == y[6] and y[1] < x[1] and all(abs(p - q) < 0.1 for p, q in zip(x[2:6], y[2:6], strict=True))
    expected = {r[:2] for r in rows if not any(near(r, y) for y in rows)}
    found = cells.without_doubles(frame)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert {(r.page_id, r.cell_ix) for r in found.collect()} == expected and len(expected) < len(rows)
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_tables_without_overlaps_are_left_as_they_are(spark, monkeypatch):
    import numpy as np

    from vellum.operators import overlaps

    rng = random.Random(12)
    for _ in range(300):
        boxes = np.array([[x := rng.randrange(30), y := rng.randrange(30), x + rng.randrange(9), y + rng.randrange(9)] for _ in range(rng.randrange(1, 7))], dtype=float)
        monkeypatch.setattr(overlaps, "FEW", 200)
        quick = overlaps.parted(boxes)
        monkeypatch.setattr(overlaps, "FEW", 0)
        assert (quick == overlaps.parted(boxes)).all()
