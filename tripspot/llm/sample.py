"""Bounded samples of labelled ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripspot.operators.rows import checked_broadcast


def first_by_hash(rows: DataFrame, group: str, n: F.Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Of each group the ids that come first in a hashed order, `n` of them (`most` at most), with their `place` from
    1; and the number of ids of each group.

    `rows` has columns id and `group`, no nulls. Ids beyond four times the share that is asked for, and some more, are
    left out before the ordering, so a hot group sends a bounded number of rows to the task that orders it. The ids left
    are far more than `most`, but for a chance that is nil in practice; then fewer are taken, never others.
    """
    rows = rows.select("id", group).distinct()
    counts = rows.groupBy(group).agg(F.count("*").alias("size"))
    share = F.lit((4.0 * most + 400) * 2.0**64) / F.col("size") - F.lit(2.0**63)
    near = rows.join(checked_broadcast(counts), group).filter(F.xxhash64("id") <= share)
    order = Window.partitionBy(group).orderBy(F.xxhash64("id"), "id")
    placed = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    return placed.filter(F.col("place") <= n).select("id", group, "place"), counts
