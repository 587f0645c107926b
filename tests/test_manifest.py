"""Manifests locked to their content, and JSON judged against a schema."""

import hashlib

from vellum.sources import manifest

ENTRIES = [("a", "report", 3, "local"), ("b", "paper", 40, "local"), ("c", "paper", None, "local"), ("d", "report", 5, "download"), ("e", "report", 5, "download")]
CONTENTS = [("a", b"%PDF one"), ("b", b"plain"), ("d", b"%PDF new")]


def frames(spark):
    entries = spark.createDataFrame(ENTRIES, "id string, category string, pages long, origin string")
    return entries, spark.createDataFrame([(i, bytearray(c)) for i, c in CONTENTS], "id string, content binary")


def by_id(df, *columns):
    return {r.id: tuple(r[c] for c in columns) for r in df.collect()}


def test_entries_are_locked_to_their_content(spark):
    entries, contents = frames(spark)
    lock = manifest.locked(entries, contents, magic=b"%PDF")
    digest = lambda c: hashlib.sha256(c).hexdigest()
    assert by_id(lock, "bytes", "sha256", "error", "changed") == {
        "a": (8, digest(b"%PDF one"), None, None), "b": (None, None, "another kind of file", None), "c": (None, None, "missing source", None), "d": (8, digest(b"%PDF new"), None, None), "e": (None, None, "missing source", None),
    }
    earlier = spark.createDataFrame([("a", 8, digest(b"%PDF one")), ("d", 7, "old")], "id string, bytes long, sha256 string")
    again = manifest.locked(entries, contents, earlier, magic=b"%PDF")
    assert by_id(again, "changed") == {"a": (False,), "b": (None,), "c": (None,), "d": (True,), "e": (None,)}
    own = manifest.locked(entries, contents, earlier, magic=b"%PDF", origin="local")
    assert by_id(own, "bytes", "sha256", "error") == {"a": (8, digest(b"%PDF one"), None), "b": (None, None, "another kind of file"), "c": (None, None, "missing source"), "d": (7, "old", None)}
    assert set(by_id(manifest.chosen(lock), "id")) == {"a", "d"} and set(by_id(manifest.chosen(lock, categories=["report"], most_pages=4), "id")) == {"a"}
    assert set(by_id(manifest.chosen(lock, least_pages=4), "id")) == {"d"} and manifest.locked(entries.limit(0), contents).count() == 0


def test_texts_are_judged_by_their_schema(spark):
    texts = ['{"id": 1, "name": "x", "box": {"l": 1.5}}', '{"id": "1", "name": "x", "box": {"l": 1}}', '{"id": 1, "name": null}', '{"id": 1, "name": "x", "box": [1]}', '{"id": 1, "name": "x", "box": {"l": "a"}}', '{"id": 1, "name": "x", "tags": {}, "box": {"l": 2}}', "{", None, "[1]", '{"id": 1, "name": "x", "box": {"l": 2}, "tags": [], "ok": true}']
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, body string")
    found = manifest.judged(rows, "body", {"id": "BIGINT", "name": "STRING", "box.l": "DOUBLE"}, {"tags": "ARRAY", "ok": "BOOLEAN"})
    assert {r.n: r.message for r in found.collect()} == {
        0: None, 1: "id: STRING is not BIGINT", 2: "name: missing", 3: "box.l: missing", 4: "box.l: STRING is not DOUBLE", 5: "tags: OBJECT is not ARRAY", 6: "no JSON", 7: "no JSON", 8: "id: missing", 9: None,
    }
    assert found.where("ok").count() == 2 and manifest.judged(rows, "body", {}).where("ok").count() == 8
