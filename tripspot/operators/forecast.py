"""Hourly forecast per zone."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from tripspot.functions.calendar import hour_key, pickup_dow, pickup_hour, wall_clock
from tripspot.functions.labels import weather_label
from tripspot.functions.scoring import clamp_score, score_level
from tripspot.operators.baseline import flag_anomaly
from tripspot.operators.weather import fill_weather


def next_hours(now, hours=3) -> list:
    """The next whole hours after `now`; the number is kept within 1..6."""
    start = now.replace(minute=0, second=0, microsecond=0, tzinfo=None)
    return [start + timedelta(hours=i + 1) for i in range(min(max(int(hours), 1), 6))]


def forecast_grid(hours, zones: DataFrame) -> DataFrame:
    """Every zone at every forecast hour. The hours (at most six) are a constant array that each zone row
    expands, so no join is needed."""
    times = F.array(*[wall_clock(h) for h in hours])
    grid = zones.select("pickup_zone", F.explode(times).alias("forecast_time"))
    return grid.withColumns(
        {
            "weather_hour": hour_key("forecast_time"),
            "pickup_hour": pickup_hour("forecast_time"),
            "pickup_dow": pickup_dow("forecast_time"),
        }
    )


def top_zones_per_hour(forecasts: DataFrame, k=None, hour="weather_hour") -> DataFrame:
    """Zones of each hour by rounded score, ties by zone; the first k if given (cut before the shuffle)."""
    order = Window.partitionBy(hour).orderBy(F.desc("hotspot_score"), F.asc("pickup_zone"))
    ranked = forecasts.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def forecast(model, now, zones, weather, fallback, baseline, hours=3, sparse_mean=0.0, lang="vi", k=None) -> DataFrame:
    """M9: scored, labelled, flagged and ranked zones of the next hours."""
    times = next_hours(now, hours)
    keys = [t.strftime("%Y-%m-%dT%H") for t in times]
    grid = fill_weather(forecast_grid(times, zones), weather.filter(F.col("weather_hour").isin(keys)), fallback)
    scored = model.transform(grid).withColumn("hotspot_score", clamp_score("predicted_hotspot_score"))
    flagged = flag_anomaly(scored, baseline, sparse_mean=sparse_mean)
    labelled = flagged.withColumns(
        {
            "hotspot_level": score_level("hotspot_score", lang),
            "weather_description": weather_label("weather_code", lang),
            "hotspot_score": F.round("hotspot_score", 2),
        }
    )
    return top_zones_per_hour(labelled, k).select(
        "weather_hour", "pickup_hour", "pickup_dow", "rank", "pickup_zone", "hotspot_score", "hotspot_level",
        "alert_flag", "anomaly_threshold", "historical_mean_score", "historical_stddev_score",
        "historical_baseline_samples", "weather_missing", "weather_description",
    )


def zone_map(zones: DataFrame, forecasts: DataFrame, hour: str) -> DataFrame:
    """Every zone with its score at one forecast hour and its map class."""
    at = forecasts.filter(F.col("weather_hour") == hour).select("pickup_zone", "hotspot_score")
    score = F.coalesce(F.col("hotspot_score"), F.lit(0.0))
    return (
        zones.join(at, "pickup_zone", "left")
        .withColumn("forecast_known", F.col("hotspot_score").isNotNull())
        .withColumn("hotspot_score", score)
        .withColumn("map_class", F.when(score >= 50, "hot").when(score >= 25, "medium").otherwise("low"))
    )
