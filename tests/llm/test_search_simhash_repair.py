"""Lexical search, SimHash components and conversation repair against plain loops, and their edge cases."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from llm import op11_lexical_search, op12_simhash, op13_conversation_repair

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# -- lexical search ------------------------------------------------------------------------------


def scores_by_loops(documents, items, k):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counts = [(d, Counter(pattern.findall(lower(t)))) for d, t in documents]
    n, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(pattern.findall(lower(text)))
    out = set()
    for item, words in asked.items():
        found = []
        for d, c in counts:
            m = 100 - 50 + ((50 * sum(c.values()) * n) // total if total else 0)
            found.append((-sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 20 * m)) for w in words if c[w]), d is None, d))
        out |= {(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(f for f in found if f[0] < 0)[:k], 1)}
    return out


def test_search_gives_the_scores_of_plain_loops(spark):
    documents, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = scores_by_loops([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()], 50)
    assert {tuple(r) for r in op11_lexical_search.op11_lexical_search(spark, SMALL).collect()} == expected and len(expected) > 1900


def test_search_by_small_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(op11_lexical_search, "ITEM_BYTES", 400)
    monkeypatch.setattr(op11_lexical_search, "SLICE", 2000)
    documents, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = scores_by_loops([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.limit(9).collect()], 5)
    assert {tuple(r) for r in op11_lexical_search.search(documents.repartition(5), items.limit(9), k=5).collect()} == whole


def test_search_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " ?! \n", "x"), (4, "One ÉTÉ one", "x"), (5, "one été", "x"), (5, "one été", "x"), (None, "one été", "x"), (6, "two " * 50_000, "x"), (7, "one\x00two", "x"), (8, "O_ne", "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score string").withColumn("item", F.lit(1)).withColumn("RANK", F.lit(2))
    asked = [(1, "one ONE"), (2, None), (3, "nothing else"), (4, "été"), (4, "two"), (None, "ne"), (5, "!")]
    items = spark.createDataFrame(asked, "item_id int, text string").withColumn("doc_id", F.lit("mine"))
    found = op11_lexical_search.search(documents, items, k=3)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in found.collect()} == scores_by_loops([r[:2] for r in rows], asked, 3)
    assert op11_lexical_search.search(documents.limit(0), items).count() == 0 == op11_lexical_search.search(documents, items.limit(0)).count()
    by_name = op11_lexical_search.search(documents.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), items, k=3)
    assert {r.doc_id for r in by_name.where("item_id = 1").collect()} == {"d4", "d5"} and by_name.where("item_id = 1").count() == 3
    twice = op11_lexical_search.search(documents, items, k=1, multiplicity=True)
    assert twice.where("item_id = 1").first().score == 2 * found.where("item_id = 1 and rank = 1").first().score


# -- fingerprints ----------------------------------------------------------------------------------


def fingerprint_by_loops(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_loops(prints, radius=4):
    label = list(range(len(prints)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                label[b] = a
    return [top(i) for i in range(len(prints))]


def test_fingerprints_and_components_of_plain_loops(spark):
    documents = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect())
    prints = [fingerprint_by_loops(t) for _, t in documents]
    expected = {(d, f"{p:016x}", documents[c][0]) for (d, _), p, c in zip(documents, prints, components_by_loops(prints), strict=True)}
    assert {tuple(r) for r in op12_simhash.op12_simhash_near_dedup(spark, MIDDLE).collect()} == expected
    assert sum(d != c for d, _, c in expected) > 20


def clouds(seed, n):
    """Random fingerprints, half of them in clouds about a few centres."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    near = [rng.choice(centres) ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(9))}) for _ in range(n // 2)]
    return list(dict.fromkeys([*near, *(rng.getrandbits(64) for _ in range(n // 2)), 0]))


@pytest.mark.parametrize("part, together, room", [(1 << 18, 1 << 18, 1024), (16, 64, 1024), (1 << 18, 100, 1)])
def test_trees_of_all_shapes_link_the_same(spark, monkeypatch, part, together, room):
    for name, value in (("PART", part), ("TOGETHER", together), ("ROOM", room), ("WAVE", 64), ("PAIRS", 50)):
        monkeypatch.setattr(op12_simhash, name, value)
    prints = clouds(part + room, 600)
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    label = list(range(len(prints)))
    at = {p: i for i, p in enumerate(prints)}
    links = [(at[r.a % (1 << 64)], at[r.b % (1 << 64)]) for r in op12_simhash.links(nodes).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() and a != b for a, b in links)
    found = op12_simhash.settled(np.array(label), *np.array(links).T)
    assert found.tolist() == components_by_loops(prints)


def test_tree_edges_are_distances(spark):
    prints = np.array(clouds(7, 300), dtype=np.uint64)
    parent, edge, levels = op12_simhash.grown(prints, np.zeros(len(prints), dtype=np.int64))
    assert parent[0] == -1 and sorted(np.concatenate(levels)) == list(range(1, len(prints)))
    assert all(int(prints[i] ^ prints[parent[i]]).bit_count() == edge[i] for i in range(1, len(prints)))
    assert len(set(zip(parent.tolist(), edge.tolist(), strict=True))) == len(prints)


def test_fingerprints_of_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(3, None), (2, ""), (4, " \t\n"), (5, "one"), (6, "ONE"), (7, long), (8, long + " more"), (9, "a b c d"), (9, "a b c d"), (None, "a b\x0bc  d"), (None, "quite another"), (10, "é\x00 x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string").withColumn("print", F.lit("mine")).withColumn("of", F.lit(1)).withColumn("Fingerprint", F.lit(2)).withColumn("hot", F.lit(3))
    found = op12_simhash.near_duplicates(documents)
    assert found.columns == ["doc_id", "text", "print", "of", "hot", "fingerprint", "component_id"]
    ids = [r[0] for r in rows]
    prints = [fingerprint_by_loops(t) for _, t in rows]
    label = components_by_loops(prints)
    least = [min((ids[j] for j in range(len(rows)) if label[j] == label[i] and ids[j] is not None), default=None) for i in range(len(rows))]
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found.collect()) == Counter((i, f"{p:016x}", c) for i, p, c in zip(ids, prints, least, strict=True))
    assert op12_simhash.near_duplicates(documents.limit(0)).count() == 0


# -- conversations ----------------------------------------------------------------------------------


def least_by_search(turns):
    """(cost, audit) by Dijkstra's algorithm over (turns done, roles so far in short), least audit first among equals."""
    accept = re.compile(r"(s?(ua)+)?")
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, made = heapq.heappop(heap)
        short = made if len(made) < 3 else made[:1].replace("u", "").replace("a", "") + ("ua" if made[-1] == "a" else "u" if made[-2:] != "ua" else "")
        if at == len(turns) and accept.fullmatch(made):
            return cost, audit
        if (at, short, made == "") in seen:
            continue
        seen.add((at, short, made == ""))

        def push(price, letter, step, role, cost=cost, audit=audit, at=at, made=made):
            new = made + role
            if any(accept.fullmatch(new + rest) for rest in ("", "a", "ua")):
                heapq.heappush(heap, (cost + price, audit + letter, at + step, new))

        for role in "ua":
            push(3, "I", 0, role)
        if at < len(turns):
            role, gone, cut = turns[at]
            push(4, "D", 1, "")
            if not gone:
                push(3 * cut, "K", 1, role)
                for new in "ua":
                    push(3 + 3 * cut, "R", 1, new)
    raise AssertionError


def test_repairs_are_those_of_a_search():
    rng = random.Random(3)
    for n in [0, 1, 2, 3] * 40 + [8] * 60 + [30] * 10:
        turns = [(rng.choice("suaaux"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]
        code = bytes("suax".index(r) | (4 if g else 8 if c else 0) for r, g, c in turns)
        assert op13_conversation_repair.repair(code) == least_by_search([(r, g, c and not g) for r, g, c in turns]), turns


def test_long_conversations_are_repaired_in_linear_time():
    cost, audit = op13_conversation_repair.repair(bytes([0, *[1, 2] * 200_000, 4, 1]))
    assert cost == 7 and audit == "K" * 400_001 + "DKI"


def repaired_by_loops(rows):
    blank = lambda v: " " if v is None else str(v)
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        deal = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text, group = blank(role), blank(text), groups[conv]
        if deal == 0:
            continue
        text = "" if deal == 1 else re.sub("[.!?]", "", text) if deal == 2 else text
        group += [(turn, "user" if deal == 4 else role, text)] * (2 if deal == 3 else 1)
    out = set()
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, turns, kinds = set(), [], Counter()
        for _, role, text in group:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            kind = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            kinds[kind] += 1
            turns.append((role[:1] if role[:1] in ("s", "u", "a") else "x", kind in ("blank", "duplicate"), kind == "truncated"))
        cost, audit = least_by_search(turns)
        illegal = sum((a[0] + b[0]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        known = [t for t, _, _ in group if t is not None]
        lines, at, state = [], 0, ""
        for letter in audit:
            role, text = "user" if state in ("", "s", "a") else "assistant", ""
            if letter != "I":
                _, own, body = group[at]
                at += 1
                if letter == "D":
                    continue
                role, text = own if letter == "K" else role, body
            state = role[:1]
            lines.append(f"{role}:{text}")
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out.add((conv, gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def test_conversations_are_those_of_plain_loops(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MIDDLE}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = op13_conversation_repair.op13_conversation_repair(spark, MIDDLE)
    assert {tuple(r) for r in found.collect()} == repaired_by_loops(rows)


def test_conversations_of_odd_rows(spark):
    rng = random.Random(5)
    texts = [None, "", " \t", "Fine.", "Fine.", "cut", "é!", "two\nlines?", "x " * 5000 + "."]
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 1, 2, 3, 70]), rng.choice(["user", "assistant", "system", "", None, "tool", "ass"]), rng.choice(texts)) for _ in range(150)]
    rows += [(5, 0, "user", "Only.")] * 3 + [(6, i, ("assistant", "user")[i % 2], f"Turn {i}.") for i in range(3000)]
    rows += [(c, 0, "user", "Gone.") for c in range(100, 160)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("code", F.lit("mine")).withColumn("digest", F.lit(1)).withColumn("kind", F.lit(2))
    found = op13_conversation_repair.repaired(op13_conversation_repair.damaged(table))
    expected = repaired_by_loops(rows)
    assert {tuple(r) for r in found.collect()} == expected and any(e[7] == "" for e in expected)
    assert op13_conversation_repair.repaired(op13_conversation_repair.damaged(table.limit(0))).count() == 0


def test_terms_are_found_on_bytes():
    texts = ["a-B é_Z9", "", None, "\x7f\x80x"]
    found, rows = op11_lexical_search.terms(*op11_lexical_search.flat(pa.array(texts)))
    assert [w.decode() for w in found.to_pylist()] == ["a", "b", "é", "z9", "\x80x"] and rows.tolist() == [0, 4, 4, 4, 5]
