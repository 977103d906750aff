"""Normalise, clean and de-duplicate trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.functions.calendar import as_local_time, hour_key, pickup_dow, pickup_hour
from tripspot.operators.rows import repeat_rows

# Column names of the public yellow-cab trip record layout.
RAW_TIME, RAW_PICKUP, RAW_DROPOFF = "tpep_pickup_datetime", "PULocationID", "DOLocationID"
TRIP_COLUMNS = ("event_id", "pickup_datetime", "pickup_zone", "dropoff_zone")
NULL_MARK = "\\N"


def with_event_id(df: DataFrame, keys, name="event_id") -> DataFrame:
    """A surrogate id that does not depend on file layout or partitioning.

    The id hashes the keys, the other columns and a running number among rows that are equal in every column.
    Equal rows are counted (with map-side combine) and written out again as often as they were counted, so the
    numbering needs no window and no key, however frequent, is handled by one task.
    """
    if name in df.columns:
        return df
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    numbered = repeat_rows(counted, "_copies", "_ordinal")
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in (*keys, *rest, "_ordinal")]
    return numbered.withColumn(name, F.sha2(F.concat_ws("|", *texts), 256)).select(name, *df.columns)


def project_trips(df: DataFrame) -> DataFrame:
    """Raw columns to trip columns, zones as text."""
    return df.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col(RAW_TIME).alias("pickup_datetime"),
        F.col(RAW_PICKUP).cast("string").alias("pickup_zone"),
        F.col(RAW_DROPOFF).cast("string").alias("dropoff_zone"),
    )


def normalize_trips(df: DataFrame) -> DataFrame:
    """Either input layout to the four trip columns."""
    if RAW_TIME not in df.columns:
        return df.select(*TRIP_COLUMNS)
    keys = [RAW_TIME, RAW_PICKUP, RAW_DROPOFF]
    needed = df.select(*(["event_id"] if "event_id" in df.columns else []), *keys)
    return project_trips(with_event_id(needed, keys))


def trim_zones(df: DataFrame) -> DataFrame:
    """P4."""
    return df.withColumns({c: F.trim(c) for c in ("pickup_zone", "dropoff_zone")})


def with_event_time(df: DataFrame, col="pickup_datetime", fmt=None, name="event_time") -> DataFrame:
    """P5: parsed event time; text that cannot be parsed gives NULL. The value is wall-clock time."""
    parsed = F.try_to_timestamp(F.col(col), F.lit(fmt)).cast("timestamp_ntz") if fmt else as_local_time(col)
    return df.withColumn(name, parsed)


def require(df: DataFrame, cols) -> DataFrame:
    """Drop rows in which a required field is NULL. Empty text is kept."""
    return df.dropna(subset=list(cols))


def dedup(df: DataFrame, key="event_id", order=("pickup_datetime", "pickup_zone", "dropoff_zone")) -> DataFrame:
    """One row per key, the first in the given order.

    An aggregate and not a window: copies of a key are combined before the shuffle, so a key with very many copies
    costs no more than any other.
    """
    keys = [key] if isinstance(key, str) else list(key)
    leading = [c for c in order if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in leading]
    if not leading and not rest:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*leading, *rest)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def with_calendar(df: DataFrame, ts="event_time") -> DataFrame:
    """Hour and day of week (Sunday = 0)."""
    return df.withColumns({"pickup_hour": pickup_hour(ts), "pickup_dow": pickup_dow(ts)})


def since(df: DataFrame, col: str, date: str) -> DataFrame:
    """Rows on or after a date; the comparison reaches the file scan."""
    return df.filter(F.col(col) >= F.lit(date).cast("date"))


def valid_zone_hour(df: DataFrame) -> DataFrame:
    """P10: key/value rows with a zone and with digits only in hour and n; numbers are normalised (07 -> 7)."""
    digits = "^[0-9]+$"
    return (
        df.filter((F.col("zone") != "") & F.col("hour").rlike(digits) & F.col("n").rlike(digits))
        .withColumns({"hour": F.col("hour").cast("int"), "n": F.col("n").cast("long")})
    )


def non_empty(df: DataFrame, cols) -> DataFrame:
    """Skip rows in which one of the columns is NULL or empty."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))
    return df


def with_hour_key(df: DataFrame, ts="event_time", name="weather_hour") -> DataFrame:
    """P12."""
    return df.withColumn(name, hour_key(ts))


def clean_trips(df: DataFrame, unique_ids=False) -> DataFrame:
    """P4-P8 in order. `unique_ids` skips the shuffle of P7 where the ids are known to be unique (P2 made them)."""
    timed = with_event_time(trim_zones(df))
    if unique_ids:
        # A made id is never NULL; testing it would hash every row twice, as filters move below projections.
        return with_calendar(require(timed, ["event_time", "pickup_zone"]))
    ready = require(timed, ["event_id", "event_time", "pickup_zone"])
    # The parsed time follows from the given one, so it is not shuffled but parsed again.
    return with_calendar(with_event_time(dedup(ready.drop("event_time"))))
