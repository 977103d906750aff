"""Stamp a stored table as a replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.functions.calendar import iso_seconds
from tripspot.functions.records import replay_id
from tripspot.operators.rows import global_index


def stamp_replay(df: DataFrame, order, start: str, step_s=30, scratch=None) -> DataFrame:
    """Row i of the given order gets start + i * step_s seconds. Zones are kept; a missing id is the SHA-1 of
    time, zones and row number."""
    placed = global_index(df, order, "_i", scratch)
    offset = F.make_dt_interval(secs=F.col("_i") * F.lit(step_s))
    stamped = placed.withColumn("pickup_datetime", iso_seconds(F.lit(start).cast("timestamp_ntz") + offset))
    made = replay_id("pickup_datetime", "pickup_zone", "dropoff_zone", "_i")
    given = F.nullif(F.col("event_id").cast("string"), F.lit("")) if "event_id" in df.columns else F.lit(None)
    return stamped.select(
        F.coalesce(given, made).alias("event_id"),
        "pickup_datetime",
        F.col("pickup_zone").cast("string").alias("pickup_zone"),
        F.col("dropoff_zone").cast("string").alias("dropoff_zone"),
    )
