"""Event-time windows, for tables and for streams: with a watermark, late rows of a stream are dropped once it has passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _watched(events: DataFrame, late: str | None) -> DataFrame:
    return events.withWatermark("ts", late) if late else events


def counted(events: DataFrame, size: str, slide: str | None = None, *, late: str | None = None) -> DataFrame:
    """(opens, event_type, n, total) of tumbling windows, or of sliding ones."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    found = _watched(events, late).groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return found.select(F.col("w.start").alias("opens"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str, *, late: str | None = None) -> DataFrame:
    """(user_id, opens, last, n): a user's events without a gap of ``gap`` or longer between them."""
    found = _watched(events, late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.min("ts").alias("opens"), F.max("ts").alias("last"), F.count("*").alias("n"))
    return found.select("user_id", "opens", "last", "n")


def overdue(opened: DataFrame, closed: DataFrame, now: DataFrame, *, warn: float = 3.0, error: float = 10.0) -> DataFrame:
    """(job_id, seconds, state) of jobs (job_id, opened) that are not closed since: how long they have been open at ``now``."""
    still = opened.join(closed, "job_id", "left").where("closed is null or closed < opened").join(F.broadcast(now))  # one row
    seconds = F.round((F.unix_micros("now") - F.unix_micros("opened")) / 1_000_000, 3)
    state = F.when(seconds >= error, "error").when(seconds >= warn, "warning").otherwise("in time")
    return still.select("job_id", seconds.alias("seconds"), state.alias("state"))
