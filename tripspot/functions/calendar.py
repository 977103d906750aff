"""Calendar expressions on the zone-less pickup time, so results do not depend on the session time zone."""

from pyspark.sql import Column, functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_local_time(value) -> Column:
    """P5: text or timestamp to a wall-clock timestamp; text that cannot be parsed becomes NULL."""
    return _col(value).try_cast("timestamp_ntz")


def wall_clock(moment) -> Column:
    """A Python datetime as a constant. It goes through text: a datetime literal would be shifted by the difference
    between the machine's and the session's time zone."""
    return F.lit(moment.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def pickup_hour(ts) -> Column:
    return F.hour(ts)


def pickup_dow(ts) -> Column:
    """Day of week, Sunday = 0."""
    return F.dayofweek(ts) - 1


def hour_key_of(date, hour) -> Column:
    """Text key yyyy-MM-ddTHH from a date and an hour. Formatting an instant would shift the wall-clock hours
    that a clock change skips, so the key is put together from its parts."""
    return F.concat(_col(date).cast("string"), F.lit("T"), F.lpad(_col(hour).cast("string"), 2, "0"))


def hour_key(ts) -> Column:
    """P12 of a timestamp."""
    return hour_key_of(F.to_date(ts), F.hour(ts))


def iso_seconds(ts) -> Column:
    """Wall-clock text yyyy-MM-ddTHH:mm:ss."""
    whole = F.substring(_col(ts).cast("timestamp_ntz").cast("string"), 1, 19)
    return F.translate(whole, " ", "T")
