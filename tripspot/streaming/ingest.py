"""Messages to trip events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.functions.records import parse_event
from tripspot.operators.clean import require, with_calendar, with_event_time


def parse_events(messages: DataFrame, value="value") -> DataFrame:
    """JSON messages to events with time, hour and weekday. Messages that are malformed, or lack an id, a zone or
    a readable time, are dropped."""
    # Expanding a one-element array keeps the filters above the parser; they would each parse the text again below it.
    events = messages.select(F.inline(F.array(parse_event(value))))
    return with_calendar(require(with_event_time(events), ["event_id", "event_time", "pickup_zone"]))
