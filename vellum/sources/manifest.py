"""Corpus manifests: entries locked to their content by size and hash, and chosen by category and pages; JSON judged against a schema.

Entries are (id, category, pages, origin, and more), contents (id, content binary).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def locked(entries: DataFrame, contents: DataFrame, earlier: DataFrame | None = None, *, magic: bytes = b"", origin: str | None = None) -> DataFrame:
    """``entries`` with bytes, sha256, error and changed.

    An entry without content, or whose content does not begin with ``magic``, has an error and neither size nor hash. With ``origin``, entries of
    other origins keep what ``earlier`` (id, bytes, sha256) says of them, or are left out where it says nothing. ``changed`` tells
    whether the hash is another one than in ``earlier``; it is null for new entries.
    """
    begins = F.substring("content", 1, len(magic)) == F.lit(magic) if magic else F.lit(True)
    error = F.when(F.col("content").isNull(), "missing source").when(~begins, "another kind of file")
    found = entries.join(contents.select("id", "content"), "id", "left").withColumn("error", error)
    good = lambda c: F.when(F.col("error").isNull(), c)
    found = found.withColumns({"bytes": good(F.octet_length("content").cast("bigint")), "sha256": good(F.sha2("content", 256))}).drop("content")
    if earlier is None:
        return found.withColumn("changed", F.lit(None).cast("boolean"))
    found = found.join(earlier.select("id", F.col("bytes").alias("old_bytes"), F.col("sha256").alias("old_sha256")), "id", "left")
    if origin is not None:
        own = F.col("origin") == origin
        found = found.where(own | F.col("old_sha256").isNotNull())
        keep = lambda new, old: F.when(own, F.col(new)).otherwise(F.col(old))
        found = found.withColumns({"bytes": keep("bytes", "old_bytes"), "sha256": keep("sha256", "old_sha256"), "error": F.when(own, F.col("error"))})
    return found.withColumn("changed", F.col("sha256") != F.col("old_sha256")).drop("old_bytes", "old_sha256")


def chosen(lock: DataFrame, *, categories: list[str] | None = None, least_pages: int = 0, most_pages: int | None = None) -> DataFrame:
    """Entries without an error, of some categories and numbers of pages; unknown numbers pass unless bounds are set."""
    pages = F.col("pages")
    keep = F.col("error").isNull()
    keep = keep if categories is None else keep & F.col("category").isin(categories)
    keep = keep & ((pages >= least_pages) if least_pages else F.lit(True))
    return lock.where(keep if most_pages is None else keep & (pages <= most_pages))


def judged(rows: DataFrame, column: str, required: dict[str, str], optional: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with ok and message: whether a JSON text has the fields of a schema, and the first fault, in the order of the fields.

    Fields are paths (``a`` or ``a.b``) with a kind: STRING, BIGINT, DOUBLE (any number), BOOLEAN, ARRAY or OBJECT. A null counts as missing.
    """
    value = F.try_parse_json(F.col(column))

    def fault(path: str, kind: str, *, needed: bool) -> Column:
        found = F.schema_of_variant(F.try_variant_get(value, f"$.{path}", "variant"))
        found = F.regexp_extract(found, r"^\w+", 0)
        found = F.when(found.startswith("DECIMAL"), "DOUBLE").otherwise(found)
        fits = found.isin("DOUBLE", "BIGINT", "FLOAT") if kind == "DOUBLE" else found == kind
        missing = found.isNull() | (found == "VOID")
        return F.when(missing, F.lit(f"{path}: missing") if needed else F.lit(None)).when(~fits, F.concat(F.lit(f"{path}: "), found, F.lit(f" is not {kind}")))

    faults = [fault(p, k, needed=True) for p, k in required.items()] + [fault(p, k, needed=False) for p, k in (optional or {}).items()]
    message = F.when(value.isNull(), "no JSON").otherwise(F.coalesce(*faults) if faults else F.lit(None))
    return rows.withColumn("message", message.cast("string")).withColumn("ok", F.col("message").isNull())
