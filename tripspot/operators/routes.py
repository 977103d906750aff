"""Progress of vehicles along their routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.functions.geo import heading_degrees, segment_lengths_m
from tripspot.functions.scoring import clamp_score


def route_progress(routes: DataFrame, vehicles: DataFrame | None = None) -> DataFrame:
    """Remaining metres, progress, heading and arrival time of each vehicle.

    A route is one array<struct<lon,lat>> per vehicle, so all of it is computed inside the row: no explode and no
    shuffle except the join with `vehicles`, which is left out when `routes` has the state columns already:
    segment_index (from 0), segment_progress_m, route_distance_m, speed_kmh, longitude, latitude.
    """
    df = routes if vehicles is None else vehicles.join(routes, "vehicle_id", "left")
    points, at = F.col("route"), F.col("segment_index")
    segments = F.coalesce(F.size(points), F.lit(0)) - 1
    ahead = F.slice(F.col("_lengths"), at + 1, F.greatest(segments - at, F.lit(0)))
    left = F.aggregate(ahead, F.lit(0.0), lambda total, metres: total + metres) - F.col("segment_progress_m")
    following = F.get(points, at + 1)
    no_route, arrived = segments < 1, at >= segments
    done = F.lit(1.0) - F.col("remaining_m") / F.greatest(F.col("route_distance_m"), F.lit(1.0))
    return (
        df.withColumn("_lengths", segment_lengths_m(points))
        .withColumn("remaining_m", F.when(no_route | arrived, 0.0).otherwise(left))
        .withColumn(
            "progress_pct", F.when(no_route, 0.0).when(arrived, 100.0).otherwise(clamp_score(done * 100))
        )
        .withColumn(
            "heading_degrees",
            F.when(no_route | arrived, 0.0).otherwise(
                heading_degrees(F.col("longitude"), F.col("latitude"), following["lon"], following["lat"])
            ),
        )
        .withColumn("eta_minutes", F.col("remaining_m") / 1000 / F.greatest(F.col("speed_kmh"), F.lit(1.0)) * 60)
        .drop("_lengths")
    )
