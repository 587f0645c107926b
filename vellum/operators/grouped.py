"""Work on whole groups of rows, many at a time: pages, tables or documents that are walked in order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def in_groups(rows: DataFrame, keys: list[str], order: list[str], work: Callable[[pd.DataFrame, list[int]], pd.DataFrame], schema: str) -> DataFrame:
    """``work(frame, edges)`` of frames that hold whole groups in order; group i has the rows edges[i] up to edges[i + 1].

    Rows are dealt by the keys once and sorted within their partitions; batches are cut where the keys
    change, so a task holds a batch and no more than one group beyond it. Keys may be null.
    """

    def turns(frame: pd.DataFrame) -> np.ndarray:
        out = np.zeros(len(frame) - 1, dtype=bool)
        for key in keys:
            a = frame[key]
            out |= ((a != a.shift()) & ~(a.isna() & a.shift().isna())).to_numpy(dtype=bool)[1:]
        return np.flatnonzero(out) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            joined = pd.concat([held[-1].tail(1), batch]) if held else batch
            shift = 1 if held else 0
            cut = turns(joined)
            if not len(cut):
                held.append(batch)
                continue
            last = int(cut[-1]) - shift
            frame = pd.concat([*held, batch.iloc[:last]], ignore_index=True)
            yield work(frame, [0, *turns(frame).tolist(), len(frame)])
            held = [batch.iloc[last:]]
        if held:
            frame = pd.concat(held, ignore_index=True)
            yield work(frame, [0, *turns(frame).tolist(), len(frame)])

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def each_group(rows: DataFrame, keys: list[str], order: list[str], work: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """``work(group)`` gives the rows of each group without its keys; ``schema`` starts with the keys."""
    names = [c.split()[0] for c in schema.split(", ")]

    def both(frame: pd.DataFrame, edges: list[int]) -> pd.DataFrame:
        out: list[tuple] = []
        for a, b in pairwise(edges):
            part = frame.iloc[a:b]
            head = tuple(part[k].iloc[0] for k in keys)
            out += [(*head, *row) for row in work(part)]
        return pd.DataFrame(out, columns=names)

    return in_groups(rows, keys, order, both, schema)


def turns_of(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before; nulls are alike."""
    if len(column) < 2:
        return np.zeros(0, dtype=np.int64)
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    lost = column.is_null().to_numpy(zero_copy_only=False)
    differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    return np.flatnonzero(differ | (lost[1:] != lost[:-1])) + 1


def in_tables(rows: DataFrame, key: str, order: list[str], work: Callable[[pa.Table, np.ndarray], pa.Table], schema: StructType) -> DataFrame:
    """``in_groups`` by one key on Arrow tables, so that columns which ``work`` only passes on are not made into objects."""
    given = to_arrow_schema(schema)

    def made(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        edges = np.concatenate([[0], turns_of(table.column(key).chunk(0)), [len(table)]])
        yield from work(table, edges).select(given.names).cast(given).to_batches(max_chunksize=10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            at = batch.schema.get_field_index(key)
            cut = turns_of(batch.column(at))
            if held and len(turns_of(pa.concat_arrays([held[-1].column(at).slice(len(held[-1]) - 1), batch.column(at).slice(0, 1)]))):
                cut = np.concatenate([[0], cut])
            if not len(cut):
                held.append(batch)
                continue
            last = int(cut[-1])
            whole = [*held, *([batch.slice(0, last)] if last else [])]
            yield from made(whole)
            held = [batch.slice(last)]
        if held:
            yield from made(held)

    return rows.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)
