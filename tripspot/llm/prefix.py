"""Running counts and sums in a global order, from per-partition totals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tripspot.operators.rows import checked_broadcast
from tripspot.session import Scratch


def _running(batches):
    """Position and sum before each row within its run of one group in this partition."""
    part = TaskContext.get().partitionId()
    group, position, total = None, 0, 0
    for batch in batches:
        groups, amounts = (batch.column(c).to_numpy() for c in ("group", "amount"))
        n = len(groups)
        if not n:
            continue
        index = np.arange(n)
        before = np.cumsum(amounts) - amounts
        new = np.ones(n, bool)
        new[1:] = groups[1:] != groups[:-1]
        new[0] = groups[0] != group
        start = np.flatnonzero(new)
        run = np.searchsorted(start, index, "right") - 1
        if len(start):
            since, left = start[run], before[start[run]]
        else:
            since, left = index * 0, index * 0
        positions = np.where(run >= 0, index - since, index + position)
        sums = np.where(run >= 0, before - left, before + total)
        group, position, total = groups[-1], int(positions[-1]) + 1, int(sums[-1] + amounts[-1])
        extra = [pa.array(np.full(n, part, np.int64)), pa.array(positions), pa.array(sums)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *extra], [*batch.schema.names, "part", "position", "before"]
        )


def prefix_sums(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """`rows` (with whole numbers `group` and `amount`, no nulls) and their `position` (from 0) and `before` (sum of the
    amounts before) within their group, in the order of the columns given.

    One range-partitioned sort over group and order splits a hot group over many tasks. Each task counts alone; the
    totals per task and group, at most one row for each task and one for each group, are summed into offsets. Nothing
    else is brought together. The sorted rows are written once, so a lost executor cannot change the borders.
    """
    keys = ["group", *order]
    fields = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    placed = scratch.store(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_running, f"{fields}, part long, position long, before long"),
        "placed",
    )
    earlier = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("group", "part").agg(F.count("*").alias("n"), F.sum("amount").alias("s"))
    offsets = scratch.store(
        totals.select(
            "group",
            "part",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
            F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s_before"),
        ),
        "offsets",
    )
    return (
        placed.join(checked_broadcast(offsets), ["group", "part"])
        .withColumn("position", F.col("position") + F.col("n_before"))
        .withColumn("before", F.col("before") + F.col("s_before"))
        .drop("part", "n_before", "s_before")
    )
