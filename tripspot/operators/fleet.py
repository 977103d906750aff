"""Vehicle snapshots."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def keyed_only(df: DataFrame, key="vehicle_id") -> DataFrame:
    """Drop messages without a key."""
    return df.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def latest_state(df: DataFrame, key="vehicle_id", order=("updated_at", "simulation_cycle")) -> DataFrame:
    """The row with the greatest order values of each key, in batch or as streaming state.

    An aggregate with map-side combine: a key with very many snapshots sends one row per task. State is one row
    per key.
    """
    rest = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(key, "_row.*").select(*df.columns)


def fleet_counters(vehicles: DataFrame) -> DataFrame:
    """A20."""
    return vehicles.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "available").alias("available"),
        F.count_if(F.col("status") == "occupied").alias("occupied"),
        F.count_if(F.col("speed_kmh") > 0).alias("moving"),
    )


def changed_between(
    before: DataFrame, after: DataFrame, key="vehicle_id", cols=("latitude", "longitude", "simulation_cycle")
) -> DataFrame:
    """Which keys differ between two snapshots of one row per key; a key in one snapshot only has changed."""
    sides = (df.select(key, F.struct(*cols).alias(name)) for name, df in (("before", before), ("after", after)))
    joined = next(sides).join(next(sides), key, "full")
    same = reduce(and_, [F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")) for c in cols])
    both = F.col("before").isNotNull() & F.col("after").isNotNull()
    return joined.withColumn("changed", ~(both & same))
