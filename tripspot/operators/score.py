"""Relative hotspot score and temporal split."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from tripspot.functions.calendar import hour_key_of
from tripspot.functions.scoring import relative_score
from tripspot.operators.clean import since
from tripspot.operators.demand import daily_demand

FIRST_SCORED_DATE = "2022-01-01"
BUCKET = ("service_date", "pickup_hour", "pickup_dow")


def bucket_max(demand: DataFrame) -> DataFrame:
    """Busiest zone's trips in each (date, hour, weekday) bucket. The window runs on counted rows: a bucket has
    at most one row per zone, whatever the number of trips behind it."""
    return demand.withColumn("bucket_max", F.max("trip_count").over(Window.partitionBy(*BUCKET)))


def hotspot_score(demand: DataFrame) -> DataFrame:
    """Score 0-100 relative to the busiest zone of the bucket, and the weather key of the hour."""
    return (
        bucket_max(demand)
        .withColumn("hotspot_score", relative_score("trip_count", "bucket_max"))
        .drop("bucket_max")
        .withColumn("weather_hour", hour_key_of("service_date", "pickup_hour"))
    )


def daily_scores(trips: DataFrame, first_date=FIRST_SCORED_DATE) -> DataFrame:
    """A3, P9 and W2. A date column is filtered as it is; a timestamp is compared directly as well, so that the
    comparison is pushed down to the files."""
    if "service_date" in trips.columns:
        return hotspot_score(daily_demand(since(trips, "service_date", first_date)))
    recent = trips.filter(F.col("pickup_datetime") >= F.lit(first_date).cast("timestamp_ntz"))
    return hotspot_score(daily_demand(recent))


class Split(NamedTuple):
    """Result of a temporal split; the dates are the borders."""

    train: DataFrame
    test: DataFrame
    train_start: object
    train_end: object
    test_start: object
    test_end: object
    train_days: int
    test_days: int


def temporal_split(df: DataFrame, date_col="service_date", frac=0.8) -> Split:
    """The earliest share of the distinct dates trains, the latest dates test.

    The distinct dates (365 a year) are found in parallel and only they are brought together; both sides are then
    plain date filters with constants, which prune partitions and row groups.
    """
    distinct = df.select(date_col).dropna().distinct()
    dates = distinct.agg(F.sort_array(F.collect_list(date_col)).alias("dates")).first()["dates"]
    if len(dates) < 2:
        raise ValueError(f"a temporal split needs at least two dates, found {len(dates)}")
    cut = min(max(1, int(len(dates) * frac)), len(dates) - 1)
    column = F.col(date_col)
    return Split(
        train=df.filter(column <= F.lit(dates[cut - 1])),
        test=df.filter(column >= F.lit(dates[cut])),
        train_start=dates[0],
        train_end=dates[cut - 1],
        test_start=dates[cut],
        test_end=dates[-1],
        train_days=cut,
        test_days=len(dates) - cut,
    )
