"""T4: start queries."""

from __future__ import annotations

from pyspark.sql import DataFrame


def start_query(df: DataFrame, sink, checkpoint: str, trigger="2 seconds", available_now=False, output_mode="append", name=None):
    """T4: start a query with a foreachBatch sink. It restarts from `checkpoint`; `available_now` stops it after the
    data at hand."""
    writer = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode(output_mode)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()
