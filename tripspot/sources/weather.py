"""Hourly weather documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripspot.functions.fixed import WEATHER_FIELDS
from tripspot.operators.weather import explode_hourly, merge_latest

PAYLOAD_SCHEMA = "hourly struct<time: array<string>, {}>".format(
    ", ".join(f"{name}: array<double>" for name in WEATHER_FIELDS)
)


def read_weather_json(spark: SparkSession, *paths) -> DataFrame:
    """Weather rows of one document per path, or of many in a folder of files; where hours overlap the
    later path wins, within a document the later element."""
    reader = spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", True)
    return merge_latest([explode_hourly(reader.json(path), position="_place") for path in paths], position="_place")
