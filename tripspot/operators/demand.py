"""Trip counts. Every count combines on the map side before its shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.functions.calendar import pickup_hour, pickup_dow
from tripspot.operators.clean import RAW_PICKUP, RAW_TIME, non_empty, with_event_time


def _hour(df: DataFrame):
    return F.col("pickup_hour") if "pickup_hour" in df.columns else pickup_hour("pickup_datetime")


def _dow(df: DataFrame):
    return F.col("pickup_dow") if "pickup_dow" in df.columns else pickup_dow("pickup_datetime")


def zone_hour_counts(df: DataFrame) -> DataFrame:
    """A1: trips per zone and hour, from trip rows or from key/value rows (zone, hour, n)."""
    if "n" in df.columns:
        grouped = df.groupBy(F.col("zone").alias("pickup_zone"), F.col("hour").alias("pickup_hour"))
        return grouped.agg(F.sum("n").alias("trip_count"))
    return df.groupBy("pickup_zone", _hour(df).alias("pickup_hour")).agg(F.count("*").alias("trip_count"))


def raw_zone_hours(raw: DataFrame) -> DataFrame:
    """V1: zone and hour of every raw row that has a zone and a time; rows are neither given ids nor de-duplicated."""
    time, zone = (RAW_TIME, RAW_PICKUP) if RAW_TIME in raw.columns else ("pickup_datetime", "pickup_zone")
    rows = raw.select(F.col(time).alias("pickup_datetime"), F.col(zone).cast("string").alias("pickup_zone"))
    timed = with_event_time(non_empty(rows, ["pickup_datetime", "pickup_zone"])).filter("event_time is not null")
    return timed.select("pickup_zone", pickup_hour("event_time").alias("pickup_hour"))


def zone_hour_dow_counts(df: DataFrame) -> DataFrame:
    """A2: trips per zone, hour and weekday, as double."""
    keys = ("pickup_zone", _hour(df).alias("pickup_hour"), _dow(df).alias("pickup_dow"))
    return df.groupBy(*keys).agg(F.count("*").cast("double").alias("trip_count"))


def daily_demand(df: DataFrame) -> DataFrame:
    """A3: trips per date, zone, hour and weekday, as double."""
    date = F.col("service_date") if "service_date" in df.columns else F.to_date("pickup_datetime")
    keys = (
        date.alias("service_date"),
        "pickup_zone",
        _hour(df).alias("pickup_hour"),
        _dow(df).alias("pickup_dow"),
    )
    return df.groupBy(*keys).agg(F.count("*").cast("double").alias("trip_count"))


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    """O2: top-k without a full sort; give an order that ends in a unique key."""
    return df.orderBy(*order).limit(n)


def top_zone_hour_dow(df: DataFrame, n=20) -> DataFrame:
    """A4: busiest zone, hour and weekday."""
    counted = df.groupBy("pickup_zone", "pickup_zone_name", "pickup_borough", "pickup_hour", "pickup_dow").agg(
        F.count("*").alias("trip_count")
    )
    order = [F.desc("trip_count"), *map(F.asc, ("pickup_zone", "pickup_hour", "pickup_dow", "pickup_zone_name"))]
    return top_n(counted, order, n)


def has_borough(df: DataFrame) -> DataFrame:
    """P16."""
    return df.filter(F.col("pickup_borough").isNotNull())


def borough_hour_profile(df: DataFrame) -> DataFrame:
    """A5: trips and distinct active zones per borough and hour.

    Counting per zone first leaves one row per (borough, hour, zone), so the distinct count is a plain count and the
    trips are shuffled once, already combined.
    """
    per_zone = has_borough(df).groupBy("pickup_borough", "pickup_hour", "pickup_zone").agg(F.count("*").alias("_n"))
    return per_zone.groupBy("pickup_borough", "pickup_hour").agg(
        F.sum("_n").alias("trip_count"), F.count("pickup_zone").alias("active_pickup_zones")
    )


def sorted_profile(df: DataFrame) -> DataFrame:
    """O3."""
    return borough_hour_profile(df).orderBy("pickup_borough", "pickup_hour")


def first_zone_hours(df: DataFrame, n=50) -> DataFrame:
    """O1."""
    return zone_hour_counts(df).orderBy("pickup_zone", "pickup_hour").limit(n)


def numeric_order(df: DataFrame, cols) -> DataFrame:
    """Ascending by the numeric value of text columns."""
    return df.orderBy(*[F.col(c).try_cast("bigint").asc() for c in cols])


def rows_per_year(df: DataFrame, ts="pickup_datetime") -> DataFrame:
    """A22."""
    per_year = df.groupBy(F.year(ts).alias("pickup_year")).agg(F.count("*").alias("row_count"))
    return per_year.orderBy("pickup_year")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A24."""
    return df.select(col).distinct()


def row_accounting(counts: DataFrame) -> DataFrame:
    """Input rows and output groups of a zone/hour count."""
    return counts.agg(
        F.coalesce(F.sum("trip_count"), F.lit(0)).cast("long").alias("input_rows"), F.count("*").alias("output_groups")
    )
