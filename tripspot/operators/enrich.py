"""Zone enrichment and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.operators.rows import checked_broadcast


def _side(zones: DataFrame, side: str) -> DataFrame:
    return zones.select(
        F.col("LocationID").cast("string").alias(f"{side}_zone"),
        F.col("Borough").alias(f"{side}_borough"),
        F.col("Zone").alias(f"{side}_zone_name"),
        F.col("service_zone").alias(f"{side}_service_zone"),
    )


def enrich_zones(trips: DataFrame, zones: DataFrame, measure=True) -> DataFrame:
    """Left joins of the zone dimension on both trip ends; unmatched zones keep NULL names.

    The dimension is broadcast after a check of its size. With `measure=False` (a dimension computed by the same
    job) the choice is left to adaptive execution.
    """
    lookup = checked_broadcast(zones) if measure else zones
    return trips.join(_side(lookup, "pickup"), "pickup_zone", "left").join(
        _side(lookup, "dropoff"), "dropoff_zone", "left"
    )


def quality_measures() -> list:
    """The aggregates of A6, also usable with DataFrame.observe during a write."""
    return [
        F.count("*").alias("after_enrichment"),
        F.count_if(F.col("pickup_zone_name").isNull()).alias("unmatched_pickup"),
        F.count_if(F.col("dropoff_zone_name").isNull()).alias("unmatched_dropoff"),
    ]


def enrichment_quality(df: DataFrame) -> DataFrame:
    """Row count and unmatched ends in one pass."""
    return df.agg(*quality_measures())


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def assert_unique_key(df: DataFrame, key: str) -> None:
    """A7 as a guard."""
    found = duplicate_keys(df, key).count()
    if found:
        raise ValueError(f"{found} duplicate values of {key}")


def assert_same_count(before: int, after: int) -> None:
    """A8."""
    if before != after:
        raise ValueError(f"enrichment changed the row count from {before} to {after}")
