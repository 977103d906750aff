"""Great-circle geometry as column expressions."""

from pyspark.sql import Column, functions as F

from tripspot.functions.fixed import EARTH_RADIUS_M


def great_circle_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """G1: haversine distance in metres between two points in degrees."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(1.0) - a, F.lit(0.0))))


def segment_lengths_m(points: Column) -> Column:
    """Lengths between neighbouring points of a polyline array<struct<lon,lat>>."""
    segments = F.greatest(F.size(points) - 1, F.lit(0))
    return F.zip_with(
        F.slice(points, 1, segments),
        F.slice(points, 2, segments),
        lambda a, b: great_circle_m(a["lon"], a["lat"], b["lon"], b["lat"]),
    )


def heading_degrees(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Direction from the first to the second point: 0 is north, 90 is east."""
    return F.degrees(F.atan2(lon2 - lon1, lat2 - lat1))
