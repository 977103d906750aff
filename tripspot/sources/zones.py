"""Zone dimension."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspot.operators.serving import natural_order
from tripspot.sources.trips import read_csv_by_header

LOOKUP_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")
GEOJSON_SCHEMA = "features array<struct<properties: struct<LocationID: string>>>"


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV; its columns may stand in any order."""
    return read_csv_by_header(spark, path, {"LocationID": "int"}).select(*LOOKUP_COLUMNS)


def zones_from_geojson(spark: SparkSession, path: str, seen: DataFrame | None = None) -> DataFrame:
    """Distinct zone ids of the map features in numeric order; without the file the zones seen in the data."""
    try:
        features = spark.read.schema(GEOJSON_SCHEMA).option("multiLine", True).json(path)
        zones = features.select(F.explode("features.properties.LocationID").alias("pickup_zone"))
    except AnalysisException as error:
        if seen is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        zones = seen.select("pickup_zone")
    return natural_order(zones.dropna().distinct(), "pickup_zone")
