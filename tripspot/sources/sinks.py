"""File sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def is_done(spark: SparkSession, path: str) -> bool:
    """Whether a finished job has left its success marker at the path."""
    try:
        spark.read.format("binaryFile").load(f"{path.rstrip('/')}/_SUCCESS")
        return True
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def by_service_date(df: DataFrame) -> DataFrame:
    """Rows of a date brought together for writing; a date far larger than the others is split at run time."""
    dated = df if "service_date" in df.columns else df.withColumn("service_date", F.to_date("event_time"))
    return dated.hint("rebalance", "service_date")


def write_curated(df: DataFrame, path: str, mode="overwrite", force=False, arranged=False) -> bool:
    """Curated trips as Parquet, one folder per service date with few large files.

    mode="ignore" does nothing when a finished output exists, unless forced. `arranged` says that the rows went
    through `by_service_date` before. Returns whether it wrote.
    """
    if mode == "ignore":
        if not force and is_done(df.sparkSession, path):
            return False
        mode = "overwrite"
    rows = df if arranged else by_service_date(df)
    rows.write.mode(mode).partitionBy("service_date").parquet(path)
    return True


def _spread(bits: Column) -> Column:
    """The 16 low bits of a number, a zero after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return bits


def curve_position(*columns: tuple[Column, int, int]) -> Column:
    """Place of a row on a curve through the square of two numbers, each given with its least and greatest value: their
    bits in turn. Neighbours on it are near in both numbers. Nulls count as the least value."""
    parts = []
    for i, (value, low, high) in enumerate(columns):
        scaled = F.floor((value - F.lit(low)) * 65535 / max(1, high - low)).cast("long")
        parts.append(F.shiftleft(_spread(F.coalesce(F.greatest(F.lit(0), F.least(F.lit(65535), scaled)), F.lit(0).cast("long"))), i))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def write_clustered(df: DataFrame, path: str, zone="pickup_zone", time="event_time", rows_per_file=5_000_000, mode="overwrite") -> None:
    """Records along a curve through zone and hour, so that each file holds few zones and few hours, and a
    filter on both skips nearly all files by their least and greatest values.

    Bounds come from one aggregate, the order from a range sort on the curve; a zone and hour with very many rows is
    split over files by the time. Zones are numbers as text; others are placed first. Times are ISO text.
    """
    number = F.col(zone).try_cast("long")
    hour = F.floor(F.unix_seconds(F.substring(time, 1, 19).try_cast("timestamp")) / 3600)
    low_zone, high_zone, low_hour, high_hour = df.agg(F.min(number), F.max(number), F.min(hour), F.max(hour)).first()
    place = curve_position((number, low_zone or 0, high_zone or 0), (hour, low_hour or 0, high_hour or 0))
    ordered = df.withColumn("_place", place).repartitionByRange("_place", time).sortWithinPartitions("_place", time)
    ordered.drop("_place").write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_zone_hour_tsv(trips: DataFrame, path: str, mode="overwrite") -> None:
    """One line (zone, hour, 1) per trip; files are split as the trips are."""
    rows = trips.select("pickup_zone", "pickup_hour", F.lit(1).alias("n"))
    rows.write.mode(mode).option("sep", "\t").csv(path)


def write_zone_hour_csv(counts: DataFrame, path: str, mode="overwrite") -> None:
    """Counts with a header, in order of zone and hour across the files."""
    ordered = counts.select("pickup_zone", "pickup_hour", "trip_count").orderBy("pickup_zone", "pickup_hour")
    ordered.write.mode(mode).option("header", True).csv(path)


def write_report(df: DataFrame, path: str, mode="overwrite", fmt="json") -> None:
    """Query results and metrics as JSON lines; the baseline goes to Parquet, as it is joined again."""
    df.write.mode(mode).format(fmt).save(path)
