"""Comparisons, checks and profiles."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from tripspot.operators.clean import valid_zone_hour
from tripspot.operators.demand import zone_hour_counts


def diff_keyed(a: DataFrame, b: DataFrame, keys, vals) -> DataFrame:
    """Keys whose values differ, or that are on one side only. Empty means equal. NULL keys are compared too."""
    left = a.select(*[F.col(k).alias(f"a_{k}") for k in keys], *[F.col(v).alias(f"a_{v}") for v in vals], F.lit(1).alias("_a"))
    right = b.select(*[F.col(k).alias(f"b_{k}") for k in keys], *[F.col(v).alias(f"b_{v}") for v in vals], F.lit(1).alias("_b"))
    on = reduce(and_, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys])
    same = reduce(and_, [F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}")) for v in vals])
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return left.join(right, on, "full").filter(~(both & same)).select(
        *[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys], *[f"{side}_{v}" for v in vals for side in "ab"]
    )


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that occur more often in a (positive surplus) or in b (negative), found with one shuffle."""
    both = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(-1)))
    return both.groupBy(*a.columns).agg(F.sum("_side").alias("surplus")).filter(F.col("surplus") != 0)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal as multisets of rows."""
    return row_differences(a, b).isEmpty()


def kv_lines(trips: DataFrame) -> DataFrame:
    """S9 as text rows: zone, hour and 1, separated by tabs."""
    return trips.select(F.concat_ws("\t", "pickup_zone", F.col("pickup_hour").cast("string"), F.lit("1")).alias("value"))


def parse_kv_lines(lines: DataFrame) -> DataFrame:
    """Text rows to (zone, hour, n); rows without exactly three fields are dropped."""
    # Expanding a one-element array keeps later filters above the split, which then happens once per line.
    split = lines.select(F.explode(F.array(F.split("value", "\t", -1))).alias("fields"))
    return split.filter(F.size("fields") == 3).select(
        *[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(("zone", "hour", "n"))]
    )


def crosscheck_zone_hour(trips: DataFrame, kv: DataFrame) -> DataFrame:
    """V1: differences between the counts of trip rows and of the independently written key/value rows."""
    return diff_keyed(
        zone_hour_counts(trips), zone_hour_counts(valid_zone_hour(kv)), ["pickup_zone", "pickup_hour"], ["trip_count"]
    )


def profile(df: DataFrame, keys, ts=None, distinct=()) -> DataFrame:
    """Row count, NULLs per key, time range and distinct counts in one row; the schema is `df.schema`."""
    measures = [F.count("*").alias("row_count"), *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys]]
    if ts:
        measures += [F.min(ts).cast("string").alias("pickup_min"), F.max(ts).cast("string").alias("pickup_max")]
    measures += [F.count_distinct(c).alias(f"distinct_{c}") for c in distinct]
    return df.agg(*measures)


def run_checks(predictions: DataFrame, ranking: DataFrame, vehicles: DataFrame, moved: DataFrame, fleet=40) -> DataFrame:
    """V4: one pass/fail row per check. Every input is reduced to one row where it is."""
    explained = (F.count("*") > 0) & (F.count_if(F.coalesce(F.col("sample_count"), F.lit(0)) <= 0) == 0)
    checks = {
        "prediction_records": predictions.agg((F.count("*") > 0).alias("passed")),
        "hotspot_explanations": ranking.agg(explained.alias("passed")),
        "fleet_records": vehicles.agg((F.count("*") >= fleet).alias("passed")),
        "fleet_moved": moved.agg(F.coalesce(F.bool_or("changed"), F.lit(False)).alias("passed")),
    }
    rows = [result.select(F.lit(name).alias("check"), "passed") for name, result in checks.items()]
    return reduce(DataFrame.unionByName, rows)
