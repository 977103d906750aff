"""Raw trips to curated trips in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tripspot.operators.clean import RAW_TIME, clean_trips, normalize_trips
from tripspot.operators.enrich import assert_same_count, assert_unique_key, enrich_zones, quality_measures
from tripspot.operators.rows import is_small
from tripspot.sources.sinks import by_service_date, is_done, write_curated
from tripspot.sources.trips import read_trips_any
from tripspot.sources.zones import read_zone_lookup


def curate(raw: DataFrame, zones: DataFrame, measure=True) -> DataFrame:
    """P1-P8 and J1. Ids made by P2 are unique, so only given ids are de-duplicated."""
    made_ids = RAW_TIME in raw.columns and "event_id" not in raw.columns
    return enrich_zones(clean_trips(normalize_trips(raw), unique_ids=made_ids), zones, measure)


def run_etl(spark: SparkSession, raw: DataFrame, zones: DataFrame, path: str) -> dict:
    """Write the curated trips once and return the quality figures measured during that write.

    With a zone table that can be broadcast the trips are arranged by date while they are still narrow. Counters of a
    job may count a retried task twice, so a difference is confirmed by counting before it is reported as an error.
    """
    assert_unique_key(zones, "LocationID")
    small = is_small(zones)
    made_ids = RAW_TIME in raw.columns and "event_id" not in raw.columns
    given, before, after = Observation("given"), Observation("before"), Observation("after")
    cleaned = clean_trips(normalize_trips(raw.observe(given, F.count("*").alias("raw_rows"))), unique_ids=made_ids)
    counted = cleaned.observe(before, F.count("*").alias("before_enrichment"))
    arranged = by_service_date(counted) if small else counted
    enriched = enrich_zones(arranged, F.broadcast(zones) if small else zones, measure=False)
    write_curated(enriched.observe(after, *quality_measures()), path, arranged=small)
    figures = {**given.get, **before.get, **after.get}
    # Rows without a zone or a readable time, and all but one of the rows with one id.
    figures["dropped_rows"] = figures["raw_rows"] - figures["before_enrichment"]
    if figures["before_enrichment"] != figures["after_enrichment"]:
        assert_same_count(cleaned.count(), spark.read.parquet(path).count())
    return figures


def etl_job(spark: SparkSession, parquet: str, csv: str, lookup: str, out: str, force=False) -> dict | None:
    """The whole job from paths; does nothing when a finished output exists and `force` is not set."""
    if not force and is_done(spark, out):
        return None
    return run_etl(spark, read_trips_any(spark, parquet, csv), read_zone_lookup(spark, lookup), out)
