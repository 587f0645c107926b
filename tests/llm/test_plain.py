"""The quality classifier, language identification and the whole pipeline against plain loops."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import op05_quality, op09_language, vocab
from llm.hashing import mix, word_hashes
from llm.vocab import public_path

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def left_out(doc_id, modulus, remainder):
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def hash_of(word):
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return word_hashes(data, np.array([0, len(data)]))[0]


def plain_features(text):
    words = [hash_of(w) for w in WORD.findall(text or "")]
    pairs = [mix(a * op05_quality.PAIR + b) for a, b in zip(words, words[1:], strict=False)]
    shift = np.uint64(64 - int(math.log2(op05_quality.BUCKETS)))
    found = Counter(int((h >> shift)[0]) for h in words + pairs)
    return {b: n / math.sqrt(max(1, found.total())) for b, n in found.items()}


def plain_model(rows):
    """Weights and intercept by follow-the-regularised-leader, one coordinate at a time."""
    q, z, n, bias, bias_n = op05_quality, defaultdict(float), defaultdict(float), 0.0, 0.0

    def weight(b):
        if abs(z[b]) <= q.L1:
            return 0.0
        return -(z[b] - math.copysign(q.L1, z[b])) / ((q.BETA + math.sqrt(n[b])) / q.ALPHA + q.L2)

    share = Counter(y for _, y in rows)
    for _ in range(q.EPOCHS):
        for x, y in rows:
            w = {b: weight(b) for b in x}
            p = 1 / (1 + math.exp(-(sum(w[b] * v for b, v in x.items()) + bias)))
            slope = (p - y) * (len(rows) / (2 * share[y])) ** q.LEVEL
            for b, v in x.items():
                g = slope * v
                z[b] += g - (math.sqrt(n[b] + g * g) - math.sqrt(n[b])) / q.ALPHA * w[b]
                n[b] += g * g
            bias_n += slope**2
            bias -= q.ALPHA * slope / (q.BETA + math.sqrt(bias_n))
    return {b: weight(b) for b in z}, bias


def test_quality_scores_are_those_of_a_plain_loop(spark, tmp_path):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(60)
    texts = {r.doc_id: r.text for r in documents.collect()} | {10**6: None, 10**6 + 1: ""}
    labels = {i: i % 2 for i in texts if i % 5}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels.items()), "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    order = spark.createDataFrame([(i,) for i in labels], "doc_id long").select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)).alias("at"))
    turn = [r.doc_id for r in order.orderBy("at", "doc_id").collect() if not left_out(r.doc_id, 3, 1)]
    weights, bias = plain_model([(plain_features(texts[i]), labels[i]) for i in turn])
    found = op05_quality.op5_quality_classifier(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts) and any(weights.values())
    for r in found:
        total = sum(weights.get(b, 0.0) * v for b, v in plain_features(texts[r.doc_id]).items()) + bias
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-4)
        assert r.predicted == (r.score >= 0.5) and r.held_out == left_out(r.doc_id, 3, 1)


def test_both_qualities_are_found_in_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality is not null").select("doc_id", "quality")
    found = op05_quality.op5_quality_classifier(spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id").groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right"))
    right = {r.quality: r.right for r in found.collect()}
    assert right[0] > 0.9 and right[1] == 1


def plain_trigrams(text):
    fold = bytes(b if b > 127 else b | 32 if chr(b).isalpha() else 32 for b in (text or "").encode())
    fold = b" " + fold + b" "
    shift = 33 - op09_language.DIMENSIONS.bit_length()
    return Counter((int.from_bytes(fold[i : i + 3], "big") * 0x9E3779B1 % (1 << 32)) >> shift for i in range(len(fold) - 2))


def test_languages_are_those_of_a_plain_loop(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = documents.collect()
    learned = [plain_trigrams(r.text) for r in rows if r.lang is not None and r.text and not left_out(r.doc_id, 4, 2) and any(c.isalpha() for c in r.text)]
    model = op09_language.fit(documents.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    seen = Counter(d for x in learned for d in x)
    assert np.allclose(model.idf, [math.log((1 + len(learned)) / (1 + seen[d])) + 1 for d in range(op09_language.DIMENSIONS)], atol=1e-5)
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-5) and max(Counter(model.languages).values()) > 1
    found = {r.doc_id: r for r in op09_language.op9_language_id(spark, SMALL).collect()}
    assert len(found) == len(rows)
    for r in rows:
        vector = {d: math.log(1 + n) * float(model.idf[d]) for d, n in plain_trigrams(r.text).items()}
        length = math.sqrt(sum(v * v for v in vector.values()))
        near = [sum(v * float(c[d]) for d, v in vector.items()) / length for c in model.centroids]
        one = found[r.doc_id]
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (one.lang_pred, one.score) == ("und", 0.0)
            continue
        assert one.score == pytest.approx(max(near), abs=1e-4) and one.held_out == left_out(r.doc_id, 4, 2)
        assert max(x for x, name in zip(near, model.languages, strict=True) if name == one.lang_pred) > max(near) - 1e-4


def plain_language(spark, docs):
    """The ids that the language stage keeps, from the cosines of op. 9."""
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = op09_language.fit(frame.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    found = op09_language.identify(frame, model).collect()
    held, least, needed = defaultdict(list), None, {}
    for r in found:
        if r.lang is not None and left_out(r.doc_id, 4, 2) and r.lang == r.lang_pred:
            held[int(math.log2(len(r.text) + 1))].append(r.score)
    for n in range(31, -1, -1):
        if held[n]:
            low = sorted(held[n])[math.ceil(corpus_pipeline.LOW * len(held[n])) - 1]
            least = low if least is None else min(low, least)
        needed[n] = corpus_pipeline.REJECT if least is None else corpus_pipeline.SLACK * least
    return {r.doc_id for r in found if r.lang_pred != "und" and r.score >= needed[int(math.log2(len(r.text) + 1))]}


def plain_near_duplicates(docs):
    """The ids of the documents that are the smallest of those reachable by links."""
    sets = {}
    for i, text in docs.items():
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    own = {i: i for i in docs}

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    ids = sorted(docs)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                own[b] = a
    return {i for i in docs if root(i) == i}


def plain_substring(docs):
    words, first, out = {i: WORD.findall(t or "") for i, t in docs.items()}, {}, {}
    for i in sorted(docs):
        own = [tuple(words[i][j : j + 50]) for j in range(len(words[i]) - 49)]
        gone = {k for j, w in enumerate(own) if first.get(w, i) < i for k in range(j, j + 50)}
        for w in own:
            first.setdefault(w, i)
        out[i] = " ".join(w for k, w in enumerate(words[i]) if k not in gone) if gone else docs[i]
    return out


def best_fit(lengths):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(2048 - n)
    return len(rooms)


def test_pipeline_gives_the_rows_of_plain_stages(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    good = op05_quality.score(documents, op05_quality.fit(documents, labels)).where("score >= 0.5").collect()
    kept = plain_language(spark, [(r.doc_id, r.text, r.lang) for r in good])
    docs = {r.doc_id: r.text for r in good if r.doc_id in kept}
    alone = plain_near_duplicates(docs)
    docs = plain_substring({i: t for i, t in docs.items() if i in alone})
    tokenizer, expected = vocab.encoder(public_path("word_bpe_49k.json"), False).tokenizer, []
    for i, text in docs.items():
        ids = np.append(np.frombuffer(vocab.packed(tokenizer, [text or ""])[0], dtype="<u4"), np.uint32(0)).astype("<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            expected.append((i, k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())))
    found = corpus_pipeline.run(spark, SMALL).toPandas()
    assert 0 < len(alone) < len(kept) <= len(good) < documents.count()
    assert sorted(zip(found.doc_id, found.piece, found.start, found.length, found.ids_crc32, strict=True)) == sorted(expected)
    for _, own in found.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= 2048
    assert found.sequence_id.nunique() <= best_fit(found.length)
