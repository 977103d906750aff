"""Historical baseline and anomaly flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.functions.scoring import alert_flag

BASELINE_KEYS = ["pickup_zone", "pickup_hour", "pickup_dow"]
# Sums of doubles depend on the order of their rows in the last digits; a limit must not.
PLACES = 9


def historical_baseline(train: DataFrame, score="hotspot_score") -> DataFrame:
    """Mean, population deviation and number of training scores per zone, hour and weekday, to 9 places, so that
    they do not change with the partitioning."""
    return train.groupBy(*BASELINE_KEYS).agg(
        F.round(F.coalesce(F.avg(score), F.lit(0.0)), PLACES).alias("mean"),
        F.round(F.coalesce(F.stddev_pop(score), F.lit(0.0)), PLACES).alias("stddev"),
        F.count("*").alias("count"),
    )


def with_threshold(df: DataFrame, baseline: DataFrame, sigma=3.0, min_support=5, sparse_mean=100.0) -> DataFrame:
    """Mean, deviation, limit and support of a row's key.

    Below `min_support` (or without a baseline) the limit is 100 and nothing can exceed it. Give the baseline as a
    stored table behind `checked_broadcast`: then the rows of `df` stay where they are. A baseline computed in the same
    job would have Spark shuffle them before its size is known.
    """
    known = baseline.select(
        *BASELINE_KEYS, F.col("mean").alias("_mean"), F.col("stddev").alias("_stddev"), F.col("count").alias("_count")
    )
    enough = F.coalesce(F.col("_count"), F.lit(0)) >= min_support
    limit = F.least(F.lit(100.0), F.round(F.col("_mean") + F.lit(float(sigma)) * F.col("_stddev"), PLACES))
    return (
        df.join(known, BASELINE_KEYS, "left")
        .withColumns(
            {
                "historical_mean_score": F.when(enough, F.col("_mean")).otherwise(F.lit(float(sparse_mean))),
                "historical_stddev_score": F.when(enough, F.col("_stddev")).otherwise(F.lit(0.0)),
                "anomaly_threshold": F.when(enough, limit).otherwise(F.lit(100.0)),
                "historical_baseline_samples": F.coalesce(F.col("_count"), F.lit(0)).cast("int"),
            }
        )
        .drop("_mean", "_stddev", "_count")
    )


def flag_anomaly(df: DataFrame, baseline: DataFrame, score="hotspot_score", **limits) -> DataFrame:
    """Flag scores above their limit, then round the published figures."""
    flagged = with_threshold(df, baseline, **limits).withColumn("alert_flag", alert_flag(score, "anomaly_threshold"))
    published = ("anomaly_threshold", "historical_mean_score", "historical_stddev_score")
    return flagged.withColumns({name: F.round(name, 2) for name in published})
