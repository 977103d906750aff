"""JSON records and record ids."""

from pyspark.sql import Column, functions as F

EVENT_SCHEMA = "event_id string, pickup_datetime string, pickup_zone string, dropoff_zone string"


def parse_event(value, schema=EVENT_SCHEMA) -> Column:
    """JSON text (or bytes) to a struct; malformed text gives NULL fields."""
    text = F.col(value) if isinstance(value, str) else value
    return F.from_json(text.cast("string"), schema)


def encode_json(*cols) -> Column:
    """the given columns as one JSON object, null fields kept."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def replay_id(*cols) -> Column:
    """SHA-1 over the columns joined with '|'."""
    return F.sha1(F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]))


def surrogate_key(*cols) -> Column:
    """SHA-256 over the columns joined with '|'."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256)
