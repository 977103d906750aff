"""Topics. The connector package is added to the session by the user (spark.jars.packages)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspot.functions.records import encode_json


def kafka_options(servers: str, topic: str, starting="latest", max_per_trigger=None) -> dict:
    """Options of the event source; a lost offset does not stop the query."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_events(spark: SparkSession, servers: str, topic: str, starting="latest", max_per_trigger=None) -> DataFrame:
    """Streaming DataFrame with the topic's `value`."""
    options = kafka_options(servers, topic, starting, max_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def to_kafka_value(df: DataFrame, key=None, columns=None) -> DataFrame:
    """One JSON text `value` per row, and a `key` column if one is named."""
    value = encode_json(*(columns or df.columns)).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def kafka_writer(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Stream writer of a DataFrame made by `to_kafka_value`."""
    return (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
