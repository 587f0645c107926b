"""The dedup operators and the Jaccard join against brute force, with small limits to reach every path."""

import random
from collections import Counter

import numpy as np
import pytest

from llm import op01_suffix_array, op02_substring, op07_jaccard_join, recurrence
from llm import suffix_array as suffix_array_module
from llm.suffix_array import permuted_prefixes, suffix_array

SCHEMA = "doc_id long, text string, kept string, spans_ int"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    line, passage, base = words(rng, 12), words(rng, 70), words(rng, 200).split()
    out = []
    for i in range(60):
        text = f"{words(rng, 40)} {line} {words(rng, 50)}"
        if i % 3 == 0:
            text = f"{words(rng, 30)} {passage}\n\t{words(rng, 20)}"
        if i % 4 == 0:
            text = " ".join(base[:100] + [f"EDIT{i}"] + base[100:]) if i % 8 else " ".join(base[: 20 + i] + [f"E{i}"] + base[21 + i :])
        out.append((i, text))
    out += [(60, None), (61, ""), (62, "a" * 1000), (63, out[5][1]), (5, out[5][1]), (None, out[6][1]), (64, "é" * 300 + " x"), (65, " ".join(["w"] * 300))]
    return out


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame([(*r, "other", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("hot,shard,crowd", [(1000, 6000, 1000), (3, 5, 2), (10, 50, 10)])
def test_repeated_bytes_go(documents, rows, hot, shard, crowd, monkeypatch):
    monkeypatch.setattr(recurrence, "CROWD", crowd)
    texts = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(w[s : s + 200] for _, w in texts for s in range(len(w) - 199))
    expected = []
    for i, w in texts:
        gone = bytearray(len(w) + 1)
        for s in range(len(w) - 199):
            if times[w[s : s + 200]] > 1:
                gone[s : s + 200] = b"\1" * 200
        spans = sum(gone[j] and not (j and gone[j - 1]) for j in range(len(w)))
        expected.append((str(i), len(w), sum(gone), spans, bytes(x for x, y in zip(w, gone) if not y)))
    found = op01_suffix_array.dedup(documents, hot=hot, shard=shard).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == sorted(expected)
    assert {r.spans_ for r in found} == {1}


@pytest.mark.parametrize("hot,shard,crowd,held", [(256, 2000, 1000, 100), (2, 5, 2, 1000), (5, 50, 10, 1000), (5, 50, 2, 0)])
def test_passages_of_smaller_documents_go(documents, rows, hot, shard, crowd, held, monkeypatch):
    monkeypatch.setattr(recurrence, "CROWD", crowd)
    monkeypatch.setattr(op02_substring, "LOOKED_UP", held)
    first = {}
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    for i, x in texts:
        for s in range(len(x) - 49):
            if i is not None:
                first[tuple(x[s : s + 50])] = min(first.get(tuple(x[s : s + 50]), 1 << 40), i)
    expected = []
    for i, x in texts:
        gone = [0] * len(x)
        for s in range(len(x) - 49):
            if i is not None and first[tuple(x[s : s + 50])] < i:
                gone[s : s + 50] = [1] * 50
        expected.append((str(i), len(x), sum(gone), b" ".join(a for a, y in zip(x, gone) if not y).decode()))
    found = op02_substring.dedup(documents, hot=hot, shard=shard).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found) == sorted(expected)


def test_windows_that_one_piece_has_are_not_counted(spark, monkeypatch):
    rng, counted, plain = random.Random(9), [], op02_substring.in_batches

    def counting(df, run, schema):
        out = plain(df, run, schema)
        if isinstance(schema, str) and schema.startswith("fp bigint, h bigint"):
            counted.append(out.count())
        return out

    monkeypatch.setattr(op02_substring, "in_batches", counting)
    passage = words(rng, 60)
    own = lambda i, j: " ".join(f"{k}of{i}" for k in range(j, j + 45))
    rows = [(i, f"{own(i, 0)} {passage} {own(i, 45)}") for i in range(400)]
    found = op02_substring.dedup(spark.createDataFrame(rows, "doc_id long, text string"), hot=5, shard=50).collect()
    assert sorted((r.doc_id, r.kept) for r in found) == [(i, text if not i else " ".join(text.replace(passage, "").split())) for i, text in rows]
    # 11 windows recur; pieces at the edges of at most 8 partitions may keep their 41
    assert 11 <= sum(counted) <= 11 + 2 * 2 * 8 * 41


@pytest.mark.parametrize("hot,shard,crowd", [(256, 2000, 1000), (2, 5, 1)])
def test_passages_go_from_every_place_of_a_document(spark, hot, shard, crowd, monkeypatch):
    monkeypatch.setattr(recurrence, "CROWD", crowd)
    rng = random.Random(5)
    passage, other, far = words(rng, 70), words(rng, 60), [words(rng, 60) for _ in range(8)]
    own, by = f"{words(rng, 60)} {passage} {words(rng, 60)}", f"{words(rng, 60)} {other} {words(rng, 60)}"
    rows = [
        (3, f"{far[0]} {passage} {far[1]}"), (5, f"{far[2]} {own} {far[3]} {own} {far[4]} {own}"),
        (4, f"{far[5]} {other} {far[6]}"), (7, f"{far[7]} {by}"), (7, f"{by} {far[0][:40]}"),
    ]
    found = op02_substring.dedup(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot, shard=shard).collect()
    expected = [(i, text if i < 5 else " ".join(text.replace(passage, "").replace(other, "").split())) for i, text in rows]
    assert sorted((r.doc_id, r.kept) for r in found) == sorted(expected)


@pytest.mark.parametrize("work", [op01_suffix_array.dedup, op02_substring.dedup, op07_jaccard_join.join])
def test_empty_tables(spark, work):
    assert work(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("names,few", [(1, 0), (3, 0), (256, 0), (3, 10), (256, 1 << 17)])
def test_suffix_arrays_are_sorted_and_prefixes_exact(names, few, monkeypatch):
    monkeypatch.setattr(suffix_array_module, "FEW", few)
    monkeypatch.setattr(suffix_array_module, "NAMES", names)
    rng = random.Random(1)
    for turn in range(300):
        some = [rng.randint(1, rng.choice([1, 2, 3, 5, 400])) for _ in range(rng.randint(1, 60))]
        text = np.array(some * rng.choice([1, 1, 2, 5]) + some[: turn % 7] + [0])
        plain = text.tolist()
        array = suffix_array(text)
        assert array.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        shared, before = permuted_prefixes(text, array)
        for x, y in zip(array[1:], array[:-1]):
            n = 0
            while max(x, y) + n < len(plain) and plain[x + n] == plain[y + n]:
                n += 1
            assert shared[x] == n and before[x] == y


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set()


@pytest.mark.parametrize("block", [3, 140])
def test_jaccard_components(spark, block):
    rng = random.Random(1)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([6, 40, 120]))]
        last = list(base)
        for _ in range(rng.choice([1, 3, 30])):
            own = list(base) if rng.random() < 0.5 else list(last)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
            last = own
    line = "The common line of words that many documents have in common today"
    rows += [(1000 + j, line + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(30))) for j in range(60)]
    rows += [(2000, None), (2001, ""), (2002, "one"), (2003, "ONE"), (2004, "one two"), (0, rows[0][1]), (None, rows[1][1])]
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for a, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(a)] = min(least.get(root(a), 1 << 40), doc_id)
    found = op07_jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), block=block, open_block=block).collect()
    expected = [(str(doc_id), len(sets[a]), least.get(root(a))) for a, (doc_id, _) in enumerate(rows)]
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in found) == sorted(expected)


@pytest.mark.parametrize("flags", ["none", "all", "half"])
def test_links_do_not_depend_on_which_shingles_are_common(spark, rows, monkeypatch, flags):
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    joined = lambda: sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in op07_jaccard_join.join(documents).collect())
    expected = joined()
    every = np.unique(np.concatenate([op07_jaccard_join.shingles(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]), 4, np.empty(0, np.uint64))[0] for _, t in rows]))
    monkeypatch.setattr(op07_jaccard_join, "common_shingles", lambda *_: {"none": every[:0], "all": every, "half": every[::2]}[flags])
    assert joined() == expected


def test_common_shingles_are_counted_in_all_documents(spark):
    n = 60_000
    # shingle j is a document of its own: 23, 24 or 25 times, far apart, among texts that come once
    kinds = [(j, 23 + j % 3) for j in range(90)]
    text = {i * 2400 + j: f"many have {j} words" for j, times in kinds for i in range(times)}
    documents = spark.createDataFrame([(i, text.get(i, f"once {i} is enough")) for i in range(n)], "row long, text string")
    hashed = lambda t: op07_jaccard_join.shingles(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), 4, np.empty(0, np.uint64))[0][0]
    expected = sorted(int(h) for j, times in kinds if times >= 24 and (h := hashed(f"many have {j} words")) < (1 << 62) // 3)
    assert len(expected) > 5 and op07_jaccard_join.common_shingles(documents, 4).tolist() == expected


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_every_common_shingle_comes_last_in_the_order(spark, monkeypatch, most):
    rng = random.Random(5)
    lines = [words(rng, 8) for _ in range(6)]
    # lines come 23 to 28 times, those of 24 and more are common; texts of one line alone, and repeated rows, too
    rows = [(100 * j + i, f"{words(rng, 9)} {line} {words(rng, 9)}" if i else line) for j, line in enumerate(lines) for i in range(23 + j)]
    rows += [rows[0], (9000, None), (9001, "")]
    seen, sketches = [], op07_jaccard_join.sketches

    def spied(documents, k, percent, common):
        out = sketches(documents, k, percent, common)
        seen.append({r.row: (r.sketch, r.n) for r in out.collect()})
        texts.update({r.row: r.text for r in documents.collect()})
        return out

    texts = {}
    monkeypatch.setattr(op07_jaccard_join, "sketches", spied)
    monkeypatch.setattr(op07_jaccard_join, "COMMON_MOST", most)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    joined = sorted((str(r.doc_id), r.component_id) for r in op07_jaccard_join.join(documents, k=5, percent=80).collect())
    plain = lambda t: set(op07_jaccard_join.shingles(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), 5, np.empty(0, np.uint64))[0].tolist())
    times = Counter(g for _, t in rows for g in plain(t or ""))
    common = {g for g, n in times.items() if n >= 24}
    assert len(common) > 20 and max(common) > (1 << 62) * 2 // 3
    for row, (sketch, n) in seen[0].items():
        order = sorted(plain(texts[row]), key=lambda g: (g in common, g))
        assert n == len(order) and sketch == [g | (1 << 62) * (g in common) for g in order[: n - -(-n * 80 // 100) + 1 if n else 0]]
    assert joined == sorted((str(doc_id), doc_id) for doc_id, _ in rows)
