"""The given tables in the shapes the operators work on. All rows of a table are used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspot.functions.calendar import hour_key, hour_key_of, iso_seconds, pickup_dow, pickup_hour
from tripspot.functions.scoring import score_level
from tripspot.plans.etl import curate

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prop_k():
    return F.get_json_object("props", "$.k").cast("int")


def raw_trips(spark, sf_dir, ids=True) -> DataFrame:
    """Raw trip layout from `events`."""
    return table(spark, sf_dir, "events").select(
        *(["event_id"] if ids else []),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("user_id") % 26).cast("int").alias("PULocationID"),
        (prop_k() % 26).alias("DOLocationID"),
    )


def zones(spark, sf_dir) -> DataFrame:
    """Zone lookup from `nation` and `region`."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_nationkey") % 2 == 0, "Zone A").otherwise("Zone B").alias("service_zone"),
    )


def curated_trips(spark, sf_dir) -> DataFrame:
    """Cleaned and enriched trips."""
    # The zone table is computed here, so measuring it would run its join once more; Spark knows the sizes of its files.
    return curate(raw_trips(spark, sf_dir), zones(spark, sf_dir), measure=False)


def demand_trips(spark, sf_dir) -> DataFrame:
    """Trips of 26 zones with very different demand over 120 dates, from `lineitem`."""
    days = (F.col("l_orderkey") % 120).cast("int")
    dated = table(spark, sf_dir, "lineitem").select(
        F.date_add(F.lit("2024-01-01").cast("date"), days).alias("service_date"),
        F.floor(F.col("l_quantity") * F.col("l_quantity") / 100).cast("string").alias("pickup_zone"),
        F.col("l_linenumber").alias("pickup_hour"),
    )
    return dated.withColumn("pickup_dow", pickup_dow("service_date"))


def hourly_weather(hours: DataFrame) -> DataFrame:
    """Weather rows computed from (weather_hour, day, n): some fields of some hours are NULL."""
    codes = F.array(*[F.lit(c) for c in (0, 2, 3, 45, 61, 71, 80, 95, 100)])
    day, n = F.dayofyear("day"), F.col("n")
    return hours.select(
        "weather_hour",
        F.when(n % 11 != 0, (day % 17 - 3).cast("double")).alias("temperature_2m"),
        ((n % 7) / 10).alias("precipitation"),
        (day % 3).cast("double").alias("snowfall"),
        (n % 25).cast("double").alias("wind_speed_10m"),
        (n % 50 + 40).cast("double").alias("relative_humidity_2m"),
        F.when(n % 13 != 0, F.get(codes, (n % 9).cast("int")).cast("double")).alias("weather_code"),
    )


def _event_hours(spark, sf_dir) -> DataFrame:
    hours = table(spark, sf_dir, "events").groupBy(hour_key("ts").alias("weather_hour"), F.to_date("ts").alias("day"))
    return hours.agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))


def all_weather(spark, sf_dir) -> DataFrame:
    """Hourly weather of every hour of `events`."""
    return hourly_weather(_event_hours(spark, sf_dir))


def weather(spark, sf_dir) -> DataFrame:
    """Hourly weather with gaps, for joins that must fill them: hours without an error event are absent."""
    return hourly_weather(_event_hours(spark, sf_dir).filter(F.col("errors") > 0))


def demand_weather(spark, sf_dir) -> DataFrame:
    """Weather for every hour of the demand trips, without gaps."""
    hours = (
        demand_trips(spark, sf_dir)
        .groupBy(hour_key_of("service_date", "pickup_hour").alias("weather_hour"), F.col("service_date").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    return hourly_weather(hours).fillna({"temperature_2m": 5.0, "weather_code": 3.0})


def predictions(spark, sf_dir) -> DataFrame:
    """Stored predictions with a score given by a formula, from `events`."""
    score = (F.col("event_id") * 37 % 1000) / 10.0
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        iso_seconds("ts").alias("event_time"),
        (F.col("user_id") % 26).cast("string").alias("pickup_zone"),
        (prop_k() % 26).cast("string").alias("dropoff_zone"),
        pickup_hour("ts").alias("pickup_hour"),
        pickup_dow("ts").alias("pickup_dow"),
        score.alias("hotspot_score"),
        score_level(score, "en").alias("hotspot_level"),
    )


def vehicles(spark, sf_dir) -> DataFrame:
    """Snapshots of 40 vehicles from `events`."""
    return vehicles_of(table(spark, sf_dir, "events"))


def vehicles_of(events: DataFrame) -> DataFrame:
    """Vehicle snapshots from rows of `events`, in batch or as a stream."""
    return events.select(
        F.format_string("V-%03d", F.col("user_id") % 40).alias("vehicle_id"),
        F.when(F.col("event_type").isin("view", "click"), "available").otherwise("occupied").alias("status"),
        (F.col("user_id") % 26).cast("string").alias("pickup_zone"),
        (prop_k() % 26).cast("string").alias("dropoff_zone"),
        (F.lit(40.6) + prop_k() / 1000).alias("latitude"),
        (F.lit(-74.1) + prop_k() / 1000).alias("longitude"),
        F.col("value").alias("speed_kmh"),
        F.col("ts").cast("string").alias("updated_at"),
        F.col("event_id").cast("int").alias("simulation_cycle"),
    )


def routes(spark, sf_dir) -> DataFrame:
    """One polyline per vector of `embeddings`: neighbouring pairs of values are points around one place."""
    values = F.col("embedding")
    pairs = F.sequence(F.lit(0), F.floor(F.size(values) / 2).cast("int") - 1)
    route = F.transform(
        pairs,
        lambda i: F.struct(
            (F.lit(-74.0) + F.get(values, i * 2).cast("double") / 10).alias("lon"),
            (F.lit(40.7) + F.get(values, i * 2 + 1).cast("double") / 10).alias("lat"),
        ),
    )
    at = (F.col("vec_id") % 40).cast("int")
    here = F.get(F.col("route"), F.least(at, F.size("route") - 1))
    return (
        table(spark, sf_dir, "embeddings")
        .withColumn("route", route)
        .select(
            F.col("vec_id").cast("string").alias("vehicle_id"),
            "route",
            at.alias("segment_index"),
            (F.col("vec_id") % 50).cast("double").alias("segment_progress_m"),
            (F.lit(400000.0) + F.col("vec_id")).alias("route_distance_m"),
            (F.col("vec_id") % 60).cast("double").alias("speed_kmh"),
            here["lon"].alias("longitude"),
            here["lat"].alias("latitude"),
        )
    )


def messages(spark, sf_dir, streaming=False) -> DataFrame:
    """Trip messages as a topic carries them: JSON text in `value`. Error events carry a time that cannot be read."""
    if streaming:
        source = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    else:
        source = table(spark, sf_dir, "events")
    time = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(iso_seconds("ts"))
    fields = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        time.alias("pickup_datetime"),
        (F.col("user_id") % 26).cast("string").alias("pickup_zone"),
        (prop_k() % 26).cast("string").alias("dropoff_zone"),
    )
    return source.select(F.to_json(fields).alias("value"))
