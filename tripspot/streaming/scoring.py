"""Scored events."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F

from tripspot.functions.fixed import NUMERIC_WEATHER_FIELDS
from tripspot.functions.scoring import clamp_score, score_level
from tripspot.operators.baseline import flag_anomaly
from tripspot.operators.clean import with_hour_key
from tripspot.operators.weather import fill_weather

PREDICTION_COLUMNS = (
    "event_id", "event_time", "pickup_zone", "dropoff_zone", "pickup_hour", "pickup_dow", *NUMERIC_WEATHER_FIELDS,
    "weather_code", "weather_missing", "weather_source", "hotspot_score", "hotspot_level", "alert_flag",
    "anomaly_threshold", "historical_mean_score", "historical_stddev_score", "historical_baseline_samples",
)


def score_stream(events: DataFrame, predict, weather: DataFrame, fallback, baseline: DataFrame, lang="vi") -> DataFrame:
    """Weather, prediction, level and anomaly flag of each event, on a stream or on a batch.

    `predict` adds predicted_hotspot_score: the `transform` method of a fitted model, or any other function on
    DataFrames. Weather and baseline are static tables, joined; nothing is collected.
    """
    filled = fill_weather(with_hour_key(events), weather, fallback)
    scored = predict(filled).withColumn("hotspot_score", clamp_score("predicted_hotspot_score"))
    levelled = scored.withColumn("hotspot_level", score_level("hotspot_score", lang))
    flagged = flag_anomaly(levelled, baseline)
    # The stored event time is the text the message came with.
    return flagged.withColumn("event_time", F.col("pickup_datetime")).select(*PREDICTION_COLUMNS)


def refreshed(load, seconds=1800.0, clock=time.monotonic):
    """A function that gives what `load` gave, loading again when that is older than `seconds`."""
    state = {}

    def current():
        if "at" not in state or clock() - state["at"] >= seconds:
            state.update(value=load(), at=clock())
        return state["value"]

    return current


def scoring_sink(store, predict, weather, fallback, baseline: DataFrame, lang="vi"):
    """T2 as a foreachBatch function in front of a store such as `upsert_batch`. `weather` may be a function that
    gives the forecast table for each batch, such as `refreshed`, so that a running query sees new forecasts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table = weather() if callable(weather) else weather
        store(score_stream(batch, predict, table, fallback, baseline, lang), batch_id)

    return write
