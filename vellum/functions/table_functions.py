"""Table functions and aggregates to call from SQL; ``register`` gives them to a session.

``otsl_slots(TABLE(tokens) PARTITION BY table_id ORDER BY pos)`` and ``packed_lines(TABLE(lines) PARTITION BY doc_id ORDER BY (pos), 128)`` get
one table's tokens or one document's lines at a time, in order, and keep no more than a counter or a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, udtf

from vellum.operators.tables import CELL_TOKENS


def _rows(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


@udtf(returnType=_rows(table_id=T.LongType(), pos=T.LongType(), token=T.StringType(), row_id=T.LongType(), col_id=T.LongType()))
class OtslSlots:
    """The cell tokens of a table's structure tokens (table_id, pos, token), with their row and column."""

    def __init__(self) -> None:
        self.row = self.column = 0

    def eval(self, token: Row) -> Iterator[tuple]:
        if token["token"] == "nl":
            self.row, self.column = self.row + 1, 0
            return
        if token["token"] in CELL_TOKENS:
            yield token["table_id"], token["pos"], token["token"], self.row, self.column
        self.column += 1


@udtf(returnType=_rows(doc_id=T.LongType(), chunk_id=T.LongType(), text=T.StringType(), n_tokens=T.LongType()))
class PackedLines:
    """Lines (doc_id, pos, text) in chunks of at most ``limit`` words; a longer line is cut into pieces of ``limit`` words."""

    def __init__(self) -> None:
        self.doc_id = None
        self.chunk, self.size, self.lines = 0, 0, []

    def done(self) -> tuple:
        out = self.doc_id, self.chunk, "\n".join(self.lines), self.size
        self.chunk, self.size, self.lines = self.chunk + 1, 0, []
        return out

    def eval(self, line: Row, limit: int) -> Iterator[tuple]:
        self.doc_id = line["doc_id"]
        words = line["text"].split()
        parts = [" ".join(words[i : i + limit]) for i in range(0, len(words), limit)] if len(words) > limit else [line["text"]]
        for i, part in enumerate(parts):
            n = min(limit, len(words) - i * limit)
            if self.lines and self.size + n > limit:
                yield self.done()
            self.lines.append(part)
            self.size += n

    def terminate(self) -> Iterator[tuple]:
        if self.lines:
            yield self.done()


@arrow_udf(T.DoubleType())
def percentile_95(values: pa.Array) -> float:
    """The value that 95 % of the values lie under, between the nearest two; null without values."""
    return pc.quantile(values.cast(pa.float64()).drop_null(), q=0.95)[0].as_py()


def register(spark: SparkSession) -> None:
    spark.udtf.register("otsl_slots", OtslSlots)
    spark.udtf.register("packed_lines", PackedLines)
    spark.udf.register("percentile_95", percentile_95)
