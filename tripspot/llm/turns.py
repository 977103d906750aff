"""Conversations as runs of sorted rows, and the stream of runs in a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

ROWS = 50_000
BYTES = 32 << 20
ORDER = ["conv", "turn", "role", "digest"]


def in_order(rows: DataFrame) -> DataFrame:
    """Rows (`conv`, `turn`, `role`, `text`, and more) with the `digest` of their text, range-partitioned and sorted by
    conversation, turn (null first), role and digest.

    Partition borders may fall inside a conversation, and even between equal rows, so a conversation with a third of all
    rows is many tasks. Texts are no sort keys: the sample of a range sort would bring whole texts to the driver.
    """
    keyed = rows.withColumn("digest", F.md5("text")).withColumn("_at", F.monotonically_increasing_id())
    return keyed.repartitionByRange(*ORDER, "_at").sortWithinPartitions(*ORDER).drop("_at")


def borders(column: pa.ChunkedArray) -> np.ndarray:
    """First row of each run of equal values; nulls are equal."""
    values = column.combine_chunks()
    now, last = values.slice(1), values.slice(0, len(values) - 1)
    differ = pc.fill_null(pc.not_equal(now, last), False).to_numpy(zero_copy_only=False)
    null = values.is_null().to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate([[True], differ | (null[1:] != null[:-1])]))


def runs(batches, key="conv", rows=ROWS, size=BYTES):
    """(table, first row of each run, which runs are open, number of the first run) for the sorted rows of a task.

    A run is open when it may be only a part of its conversation: at the borders of the task, and where a conversation
    of more rows or bytes than given is cut, so that a task holds no more of it. Numbers rise in the global order.
    """
    number = TaskContext.get().partitionId() << 33
    held, begun = None, True  # rows of the last run so far; whether they may have begun in an earlier part
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        start = borders(table.column(key))
        last = int(start[-1])
        if last:
            open_ = np.zeros(len(start) - 1, bool)
            open_[0] = begun
            yield table.slice(0, last), start[:-1], open_, number
            number += len(open_)
            held, begun = table.slice(last), False
        elif table.num_rows >= rows or table.nbytes >= size:
            yield table, start, np.ones(1, bool), number
            number += 1
            held, begun = None, True
        else:
            held = table
    if held is not None:
        yield held, np.zeros(1, np.int64), np.ones(1, bool), number


def flat_index(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes laid end to end: the group of each place, and its place within the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """The values as lists of the given lengths."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)
