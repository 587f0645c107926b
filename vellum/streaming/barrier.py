"""Completion barriers: a job's pages are held until all have come, then given out once, in order."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

OUTPUT = StructType([StructField("job_id", LongType()), StructField("pages", IntegerType()), StructField("payloads", StringType()), StructField("status", StringType())])


class Barrier(StatefulProcessor):
    """Pages (job_id, page_no, total, payload). A page counts once; a later delivery replaces its payload.

    With a time to live, a job that stays incomplete is given out as ``partial`` when it ends.
    """

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", StructType([StructField("page_no", LongType())]), StructType([StructField("payload", StringType())]))
        self.total = handle.getValueState("total", StructType([StructField("total", LongType()), StructField("done", IntegerType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        fresh = not self.total.exists()
        total, done = (0, 0) if fresh else self.total.get()
        new = {}
        for batch in rows:
            for page_no, of, payload in zip(batch.page_no, batch.total, batch.payload, strict=True):
                total = max(total, int(of))
                new[int(page_no)] = payload
        if not done:
            # pages that come all at once never go to the state
            have = new if fresh else {k[0]: v[0] for k, v in self.pages.iterator()} | new
            if len(have) >= total:
                done = 1
                if not fresh:
                    self.pages.clear()
                yield self.row(key, sorted(have.items()), "complete")
            else:
                for page_no, payload in new.items():
                    self.pages.updateValue((page_no,), (payload,))
                if self.ttl_ms and fresh:
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
        self.total.update((total, done))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        total, done = self.total.get()
        if not done:
            have = sorted((k[0], v[0]) for k, v in self.pages.iterator())
            self.pages.clear()
            self.total.update((total, 1))
            yield self.row(key, have, "partial")

    def close(self) -> None:
        pass

    @staticmethod
    def row(key: Any, have: list[tuple[int, str]], status: str) -> pd.DataFrame:
        return pd.DataFrame({"job_id": [key[0]], "pages": [len(have)], "payloads": [",".join(str(p) for _, p in have)], "status": [status]}).astype({"pages": "int32"})


def complete_jobs(pages: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Finished jobs of a stream of pages; needs the RocksDB state store."""
    return pages.groupBy("job_id").transformWithStateInPandas(Barrier(ttl_ms), OUTPUT, "Append", "ProcessingTime" if ttl_ms else "None")
