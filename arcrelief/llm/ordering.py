"""Positions of rows within their key, whatever share of the rows one key owns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .store import map_batches


def with_positions(df: DataFrame, key: str, order: list) -> DataFrame:
    """``df`` with ``position``, a row's number (from 0) among those of its ``key`` (long, not
    null) in the given order.

    Rows are range partitioned, so a hot key spreads over tasks, and stored.  A task
    numbers its own rows; what a key has in earlier partitions is added from one count for
    each partition, all that reaches the driver.  Equal rows are told apart by where they
    were read.
    """
    tie = F.monotonically_increasing_id()
    sorted_by = [key, *order, "_tie"]
    placed = checkpointed(
        df.withColumn("_tie", tie).repartitionByRange(*sorted_by).sortWithinPartitions(*sorted_by)
        .drop("_tie"))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        n = total = 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            if not len(keys):
                continue
            first = int(keys[0]) if first is None else first
            same = len(keys) - int(np.searchsorted(keys, keys[-1], "left"))
            n = n + same if last == keys[-1] and same == len(keys) else same
            last, total = int(keys[-1]), total + len(keys)
        if first is not None:
            yield pa.RecordBatch.from_pylist([{
                "part": TaskContext.get().partitionId(), "first": first, "last": last, "n": n}])

    found = map_batches(placed.select(key), edges, "part LONG, first LONG, last LONG, n LONG").collect()
    before: dict[int, int] = {}
    open_key, so_far = None, 0
    for x in sorted(found, key=lambda x: x["part"]):
        if x["first"] == open_key:
            before[x["part"]] = so_far
        so_far = x["n"] + (so_far if x["first"] == x["last"] == open_key else 0)
        open_key = x["last"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
            if not len(keys):
                continue
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            at = np.arange(len(keys)) - np.repeat(starts, np.diff([*starts, len(keys)]))
            going_on = keys == keys[0]
            if last is None:
                at[going_on] += before.get(TaskContext.get().partitionId(), 0)
            elif last == keys[0]:
                at[going_on] += n
            last, n = int(keys[-1]), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at, pa.int64())], [*batch.schema.names, "position"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    return map_batches(placed, number, f"{fields}, position LONG")
