"""Latest vehicle states from a snapshot stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspot.operators.fleet import keyed_only, latest_state

VEHICLE_SCHEMA = (
    "vehicle_id string, status string, route_status string, pickup_zone string, dropoff_zone string, "
    "latitude double, longitude double, destination_latitude double, destination_longitude double, "
    "speed_kmh double, heading_degrees double, progress_pct double, eta_minutes double, updated_at string, "
    "simulation_cycle int, route_source string, route_error string"
)


ORDER = ("updated_at", "simulation_cycle")
# State in RocksDB outside the heap; a batch uploads its changes and not the whole state.
CHANGELOG_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def keep_state_with_changelog(spark: SparkSession) -> None:
    """For streams started from now on in the session."""
    for name, value in CHANGELOG_STATE.items():
        spark.conf.set(name, value)


def latest_vehicle(snapshots: DataFrame, late=None, window="1 hour") -> DataFrame:
    """Newest snapshot per vehicle by event fields, so messages may arrive in any order. Run it in update mode into
    the keyed store, which keeps the newest record of a vehicle.

    Without `late` the state holds one row per vehicle for ever. With it (an interval) the state holds one row per
    vehicle and window of event time, and windows older than the newest time less `late` leave it: vehicles that fell
    silent cost nothing. A snapshot that arrives late within the limit is counted in its window and wins in the store if
    it is its vehicle's newest; later ones, and such without a time that can be read, are dropped.
    """
    rows = keyed_only(snapshots)
    if late is None:
        return latest_state(rows)
    timed = rows.withColumn("_at", F.col("updated_at").try_cast("timestamp")).filter("_at is not null").withWatermark("_at", late)
    newest = F.max_by(F.struct(*[c for c in rows.columns if c != "vehicle_id"]), F.struct(*ORDER)).alias("_row")
    kept = timed.groupBy("vehicle_id", F.window("_at", window)).agg(newest)
    return kept.select("vehicle_id", "_row.*").select(*rows.columns)
