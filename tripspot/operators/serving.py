"""Queries on stored predictions and vehicles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripspot.functions.fixed import DISPATCH_REASON
from tripspot.functions.scoring import score_level
from tripspot.operators.rows import bounded_rows, global_index, sort_key


def for_zone(df: DataFrame, zone=None) -> DataFrame:
    """Rows of one zone; a blank zone keeps all rows."""
    zone = (zone or "").strip()
    return df.filter(F.col("pickup_zone") == zone) if zone else df


def zone_means(preds: DataFrame, zone=None) -> DataFrame:
    """A16 before the limit. Means are rounded far below a score's precision, so that the ranking does not depend
    on the order in which rows were added up."""
    return for_zone(preds, zone).groupBy("pickup_zone").agg(
        F.round(F.avg("hotspot_score"), 9).alias("hotspot_score"), F.count("*").alias("sample_count")
    )


def zone_ranking(preds: DataFrame, n=10, zone=None) -> DataFrame:
    """Zones with the highest mean score; ties by zone."""
    return zone_means(preds, zone).orderBy(F.desc("hotspot_score"), F.asc("pickup_zone")).limit(n)


def top_zones(preds: DataFrame, n=10) -> DataFrame:
    """O4 without the sample count."""
    return zone_ranking(preds, n).select("pickup_zone", "hotspot_score")


def last_then_asc(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n largest values, ascending."""
    return df.orderBy(F.desc(col)).limit(n).orderBy(F.asc(col))


def hourly_series(preds: DataFrame, n=24, zone=None) -> DataFrame:
    """Mean score of the latest n hours."""
    hourly = for_zone(preds, zone).groupBy(F.substring("event_time", 1, 13).alias("bucket")).agg(
        F.avg("hotspot_score").alias("value")
    )
    return last_then_asc(hourly, "bucket", n)


def summary(preds: DataFrame, zone=None) -> DataFrame:
    """Records, distinct zones and latest event time. Counting per zone first keeps the distinct count free of
    a row-expanding rewrite."""
    per_zone = for_zone(preds, zone).groupBy("pickup_zone").agg(
        F.count("*").alias("_n"), F.max("event_time").alias("_latest")
    )
    return per_zone.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("count"),
        F.count("pickup_zone").alias("zones"),
        F.max("_latest").alias("latest"),
    )


def latest_event_time(preds: DataFrame) -> DataFrame:
    """O11."""
    return preds.agg(F.max("event_time").alias("latest"))


def natural_order(df: DataFrame, col: str) -> DataFrame:
    """Whole numbers in numeric order, then other values as text."""
    number = F.col(col).try_cast("bigint")
    return df.orderBy(number.isNull(), number, F.col(col))


def zone_list(preds: DataFrame) -> DataFrame:
    """A19."""
    return natural_order(preds.select("pickup_zone").distinct(), "pickup_zone")


def latest_predictions(preds: DataFrame, n=20, zone=None) -> DataFrame:
    """Newest predictions first; n is kept within 1..100."""
    n = min(max(int(n), 1), 100)
    return for_zone(preds, zone).orderBy(F.desc("event_time"), F.asc("event_id")).limit(n)


def available_vehicles(vehicles: DataFrame) -> DataFrame:
    """P17."""
    return vehicles.filter(F.col("status") == "available").select("vehicle_id", "pickup_zone", "updated_at")


def fleet_order(vehicles: DataFrame, by="vehicle_id") -> DataFrame:
    """By id, or newest first."""
    if by == "updated_at":
        return vehicles.orderBy(F.desc("updated_at"), F.asc("vehicle_id"))
    return vehicles.orderBy("vehicle_id")


def rank_zip(left: DataFrame, left_order, right: DataFrame, right_order, n=None, name="position", scratch=None) -> DataFrame:
    """First left row with first right row, second with second, as far as the shorter side goes.

    With n both sides are cut to their first n rows by top-k before they are numbered. Without n the rows are numbered
    by a distributed sort; with orders by name (`name`, `-name`) the longer side is first cut near the length of the
    shorter, so that rows without a partner are neither sorted nor written.
    """
    sides = [(left, left_order), (right, right_order)]
    if n is None and all(isinstance(key, str) for _, order in sides for key in order):
        shorter = min(df.count() for df, _ in sides)
        sides = [(bounded_rows(df, order, shorter), order) for df, order in sides]

    def numbered(df, order):
        order = [sort_key(key) if isinstance(key, str) else key for key in order]
        if n is None:
            return global_index(df, order, name, scratch)
        return df.orderBy(*order).limit(n).withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)

    return numbered(*sides[0]).join(numbered(*sides[1]), name)


def hotspot_summary(preds: DataFrame, n=10, lang="vi") -> DataFrame:
    """The ranked zones with their level."""
    return zone_ranking(preds, n).select(
        F.col("pickup_zone").alias("zone"),
        F.round("hotspot_score", 2).alias("hotspot_score"),
        score_level("hotspot_score", lang).alias("hotspot_level"),
        "sample_count",
    )


def dispatch(preds: DataFrame, vehicles: DataFrame, n=10, lang="vi") -> DataFrame:
    """Send the i-th newest available vehicle to the i-th hottest zone."""
    zones = zone_means(preds).select(F.col("pickup_zone").alias("target_zone"), "hotspot_score")
    pairs = rank_zip(
        available_vehicles(vehicles),
        [F.desc("updated_at"), F.asc("vehicle_id")],
        zones,
        [F.desc("hotspot_score"), F.asc("target_zone")],
        n,
    )
    return pairs.orderBy("position").select(
        "vehicle_id",
        F.col("pickup_zone").alias("from_zone"),
        "target_zone",
        F.round("hotspot_score", 2).alias("hotspot_score"),
        F.lit(DISPATCH_REASON[lang]).alias("reason"),
    )


def overview(preds: DataFrame, zone=None) -> dict:
    """The four results of the overview. Cache `preds` before when it is expensive to read."""
    return {
        "summary": summary(preds, zone),
        "ranking": zone_ranking(preds, 10, zone).select("pickup_zone", "hotspot_score"),
        "series": hourly_series(preds, 24, zone),
        "predictions": latest_predictions(preds, 30, zone),
    }
