"""What finished jobs leave in a store: Markdown, elements, the pictures of both, and a record of completion.

``stored`` is for ``foreachBatch``. All names depend on the job or on content alone, files appear as a whole, and a batch's
record replaces one of the same number, so a batch that is delivered twice, or by a task that is tried again, leaves what one delivery leaves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.sources.shared import opened, written

#: A picture within a text.
PICTURE = r"data:image/(\w+);base64,([A-Za-z0-9+/]+=*)"
FOLDER = "artifacts"
RECORD = "user_id string, job_id string, md_key string, json_key string, pages bigint, pictures array<string>, status string, message string"


def _content(uri: Column) -> Column:
    return F.unbase64(F.substring_index(uri, ",", -1))


def _name(uri: Column) -> Column:
    ending = F.substring_index(F.substring_index(uri, ";", 1), "/", -1)
    return F.concat(F.lit(f"{FOLDER}/image_"), F.sha2(_content(uri), 256), F.lit("."), ending)


def externalised(jobs: DataFrame, *texts: str) -> DataFrame:
    """``jobs`` with names in place of the pictures within the texts, and ``uris``: the pictures themselves, once each. Other uris stay as they are."""
    found = F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(PICTURE), F.lit(0)) for t in texts])))
    # a picture may be the start of another one, so longer ones go first
    found = F.array_sort(found, lambda a, b: F.length(b) - F.length(a))
    out = jobs.withColumn("uris", found)
    return out.withColumns({t: F.aggregate("uris", F.col(t), lambda text, uri: F.replace(text, uri, _name(uri))) for t in texts})


def embedded(jobs: DataFrame, text: str, pictures: DataFrame) -> DataFrame:
    """``jobs`` with pictures (name, data) back in place of their names in a text."""
    names = jobs.select("job_id", F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(rf"{FOLDER}/image_[0-9a-f]{{64}}\.\w+"), F.lit(0)))).alias("name"))
    uri = F.concat(F.lit("data:image/"), F.substring_index("name", ".", -1), F.lit(";base64,"), F.translate(F.base64("data"), "\r\n", ""))
    uris = names.join(pictures, "name").groupBy("job_id").agg(F.collect_list(F.struct("name", uri.alias("uri"))).alias("pictured"))
    out = jobs.join(uris, "job_id", "left")
    return out.withColumn(text, F.aggregate(F.coalesce("pictured", F.array().cast("array<struct<name:string,uri:string>>")), F.col(text), lambda t, p: F.replace(t, p["name"], p["uri"]))).drop("pictured")


def _put(rows: DataFrame, folder: str) -> DataFrame:
    """The rows (path, data) whose files are written under a folder, with the reason where one could not be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reasons = []
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    written(f"{folder}/{path}", data.as_py())
                    reasons.append(None)
                except Exception as why:
                    reasons.append(f"{type(why).__name__}: {why}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(reasons, pa.string())], names=["path", "reason"])

    return rows.select("path", "data").mapInArrow(run, "path string, reason string")


def _missing(rows: DataFrame, folder: str) -> DataFrame:
    """The rows (path, ...) whose files are not there yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        for batch in batches:
            infos = store.get_file_info([f"{root}/{p}" for p in batch.column(batch.schema.get_field_index("path")).to_pylist()])
            yield batch.filter(pa.array([not i.is_file for i in infos], pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def stored(folder: str) -> Callable[[DataFrame, int], None]:
    """A function of a batch of jobs (user_id, job_id, markdown, elements, pages, error) and its number.

    For a job without an error: ``processed/<user>/<job>/output.md`` and ``elements.json``, and each picture once, under its hash, over all jobs. The
    record of the batch has a row for each job, ``completed`` or ``failed`` with the reason.
    """
    root = folder.rstrip("/")

    def store(batch: DataFrame, number: int) -> None:
        jobs = externalised(batch, "markdown", "elements").withColumn("key", F.concat(F.lit("processed/"), "user_id", F.lit("/"), "job_id", F.lit("/")))
        jobs = jobs.withColumns({"md_key": F.concat("key", F.lit("output.md")), "json_key": F.concat("key", F.lit("elements.json"))}).persist()
        good = jobs.where("error is null")
        pictures = good.select(F.explode("uris").alias("uri")).distinct()
        pictures = _missing(pictures.select(_name(F.col("uri")).alias("path"), _content(F.col("uri")).alias("data")), root)
        files = good.select(F.explode(F.array(F.struct(F.col("md_key").alias("path"), F.encode("markdown", "utf-8").alias("data")), F.struct(F.col("json_key").alias("path"), F.encode("elements", "utf-8").alias("data")))).alias("f")).select("f.*")
        put = _put(files.unionByName(pictures), root).where("reason is not null").persist()
        needs = good.select("md_key", F.explode(F.concat(F.array("md_key", "json_key"), F.transform("uris", _name))).alias("path"))
        bad = needs.join(put, "path").groupBy("md_key").agg(F.min("reason").alias("reason"))
        done = jobs.join(bad, "md_key", "left")
        why = F.coalesce("error", "reason")
        key = lambda c: F.when(why.isNull(), F.col(c)).alias(c)
        record = done.select("user_id", "job_id", key("md_key"), key("json_key"), F.col("pages").cast("bigint").alias("pages"), F.array_sort(F.transform("uris", _name)).alias("pictures"), F.when(why.isNull(), "completed").otherwise("failed").alias("status"), why.alias("message"))
        record.write.mode("overwrite").parquet(f"{root}/completed/batch={number}")
        put.unpersist()
        jobs.unpersist()

    return store
