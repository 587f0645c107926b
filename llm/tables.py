"""Reading tables, cutting lineage, and the arithmetic that the queries share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a Python worker gets of a table at a time, and the setting that bounds it, which is 64 MB by default.
BATCH, BATCHES = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get rows in batches of ``BATCH``, unless the session sets a smaller bound than the default."""
    if spark.conf.get(BATCHES) == "67108864b":
        spark.conf.set(BATCHES, BATCH)


def give_back() -> None:
    """Return to the system what numpy and Arrow keep for reuse: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def in_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` in small batches; a task gives its memory back when it ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    small_batches(df.sparkSession)
    return df.mapInArrow(task, schema)


def in_groups(groups: GroupedData, run: Callable, schema: str) -> DataFrame:
    """``groups.applyInPandas`` that gives its memory back after each group."""

    def task(group):  # noqa: ANN001, ANN202
        try:
            return run(group)
        finally:
            give_back()

    return groups.applyInPandas(task, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only in local mode with none set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later stages start from the files.

    The shuffle files behind it are then of no use; collecting the driver's garbage lets Spark
    delete them, which keeps the disk that a query of several stages needs to that of one stage.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete the files of a table from ``written`` that no later stage reads."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.written_path)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def others(df: DataFrame, made: list[str]) -> list[str]:
    """The columns of ``df`` that are not named, in any case, like one that is to be made."""
    names = {c.lower() for c in made}
    return [c for c in df.columns if c.lower() not in names]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    names = {c.lower() for c in df.columns}
    while name.lower() in names:
        name += "_"
    return name


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id, written as text, leaves ``remainder``; a null id counts as ''."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % modulus == remainder
