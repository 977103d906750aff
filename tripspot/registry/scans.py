"""Sources and sinks on the given tables."""

from pyspark.sql import functions as F

from tripspot import fixtures as fx
from tripspot.operators.clean import normalize_trips, valid_zone_hour
from tripspot.operators.demand import zone_hour_counts
from tripspot.operators.rows import sample_rows
from tripspot.operators.serving import for_zone
from tripspot.operators.verify import kv_lines, parse_kv_lines
from tripspot.plans.incremental import incremental_etl
from tripspot.plans.reports import register_views, run_sql
from tripspot.registry.base import owned, query, sql
from tripspot.sources.kafka import to_kafka_value
from tripspot.sources.sinks import is_done, write_clustered, write_curated, write_report, write_zone_hour_csv, write_zone_hour_tsv
from tripspot.sources.trips import bounded_source, read_trips, read_trips_any, read_trips_csv, read_zone_hour_tsv
from tripspot.sources.zones import read_zone_lookup


@query("s1_parquet_scan", "select * from events")
def s1(spark, d):
    return read_trips(spark, f"{d}/events.parquet")


@query(
    "s2_csv_scan",
    sql(
        """select cast(event_id as varchar) as event_id, tpep_pickup_datetime, PULocationID, DOLocationID from raw""",
        "raw",
    ),
)
def s2(spark, d):
    path = owned(spark).path("csv")
    raw = fx.raw_trips(spark, d)
    raw.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("string")).write.option("header", True).csv(path)
    return read_trips_csv(spark, path)


@query("s2_zone_lookup", sql("select * from zones", "zones"))
def s2_lookup(spark, d):
    # The columns of the file stand in another order.
    path = owned(spark).path("lookup")
    fx.zones(spark, d).select("Zone", "LocationID", "service_zone", "Borough").write.option("header", True).csv(path)
    return read_zone_lookup(spark, path)


@query(
    "s3_source_fallback",
    sql("select cast(event_id as varchar) as event_id, tpep_pickup_datetime, PULocationID, DOLocationID from raw", "raw"),
)
def s3(spark, d):
    path = owned(spark).path("fallback")
    raw = fx.raw_trips(spark, d)
    raw.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("string")).write.option("header", True).csv(path)
    return read_trips_any(spark, f"{path}-absent", path)


@query("s4_pruned_scan", "select event_id, ts from events")
def s4(spark, d):
    return read_trips(spark, f"{d}/events.parquet", columns=["event_id", "ts"])


# Every seventh pickup zone is NULL, so that the rule has rows to drop.
HOLES = "(select event_id, case when event_id % 7 <> 0 then PULocationID end as PULocationID, DOLocationID from raw)"
BOUNDED = f"select * from {HOLES} where PULocationID is not null and DOLocationID is not null"


def with_holes(spark, d):
    rows = fx.raw_trips(spark, d).select("event_id", "PULocationID", "DOLocationID")
    return rows.withColumn("PULocationID", F.when(F.col("event_id") % 7 != 0, F.col("PULocationID")))


@query("s5_bounded_source", sql(f"{BOUNDED} order by event_id limit 5000", "raw"))
def s5(spark, d):
    return bounded_source(with_holes(spark, d), 5000, order=["event_id"], scratch=owned(spark), slack=500)


@query("s5_unlimited_source", sql(BOUNDED, "raw"))
def s5_unlimited(spark, d):
    return bounded_source(with_holes(spark, d), 0)


@query(
    "s7_json_records",
    sql(
        """select cast(json_object('event_id', event_id, 'pickup_datetime', event_time, 'pickup_zone', pickup_zone,
                                   'dropoff_zone', dropoff_zone) as varchar) as value
           from predictions""",
        "predictions",
    ),
)
def s7(spark, d):
    events = fx.predictions(spark, d).withColumn("pickup_datetime", F.col("event_time"))
    return to_kafka_value(events, columns=["event_id", "pickup_datetime", "pickup_zone", "dropoff_zone"])


@query("s8_tsv_source", sql("select pickup_zone as zone, cast(pickup_hour as varchar) as hour, '1' as n from trips", "trips"))
def s8(spark, d):
    path = owned(spark).path("tsv")
    write_zone_hour_tsv(fx.curated_trips(spark, d), path)
    return read_zone_hour_tsv(spark, path)


@query(
    "s9_tsv_lines",
    sql("select pickup_zone || chr(9) || cast(pickup_hour as varchar) || chr(9) || '1' as value from trips", "trips"),
)
def s9(spark, d):
    return kv_lines(fx.curated_trips(spark, d))


@query(
    "s10_curated_sink",
    sql(
        "select *, cast(event_time as date) as service_date from curated",
        "curated",
    ),
)
def s10(spark, d):
    path = owned(spark).path("curated")
    write_curated(fx.curated_trips(spark, d), path)
    return read_trips(spark, path)


@query("s11_skip_if_done", sql("select count(*) as row_count, true as was_done, false as wrote_again from trips", "trips"))
def s11(spark, d):
    path = owned(spark).path("guard")
    write_curated(fx.curated_trips(spark, d), path, mode="ignore")
    again = write_curated(fx.curated_trips(spark, d), path, mode="ignore")
    stored = spark.read.parquet(path).agg(F.count("*").alias("row_count"))
    return stored.select("row_count", F.lit(is_done(spark, path)).alias("was_done"), F.lit(again).alias("wrote_again"))


ZONE_HOURS = sql("select pickup_zone, pickup_hour, count(*) as trip_count from trips group by all", "trips")


@query("s12_sorted_csv_sink", ZONE_HOURS)
def s12(spark, d):
    path = owned(spark).path("counts")
    write_zone_hour_csv(zone_hour_counts(fx.curated_trips(spark, d)), path)
    schema = "pickup_zone string, pickup_hour int, trip_count long"
    return spark.read.option("header", True).schema(schema).csv(path)


@query("s14_json_report", ZONE_HOURS)
def s14(spark, d):
    path = owned(spark).path("report")
    write_report(zone_hour_counts(fx.curated_trips(spark, d)), path)
    return spark.read.schema("pickup_zone string, pickup_hour int, trip_count long").json(path)


TOP = """select pickup_zone, pickup_zone_name, pickup_borough, pickup_hour, pickup_dow, count(*) as trip_count
         from curated group by all
         order by trip_count desc, pickup_zone, pickup_hour, pickup_dow limit 20"""
PROFILE = """select pickup_borough, pickup_hour, count(*) as trip_count,
                    count(distinct pickup_zone) as active_pickup_zones
             from curated where pickup_borough is not null group by all"""


@query("s17_sql_top_zone_hour_dow", sql(TOP, "curated"))
def s17_top(spark, d):
    register_views(spark, fx.curated_trips(spark, d))
    return run_sql(spark, "top_zone_hour_dow")


@query("s17_sql_borough_hour_profile", sql(PROFILE, "curated"))
def s17_profile(spark, d):
    register_views(spark, fx.curated_trips(spark, d))
    return run_sql(spark, "borough_hour_profile")


@query("o8_sample_rows", "select least(1000, count(*)) as rows, least(1000, count(*)) as ids, 0::bigint as strange from events")
def o8(spark, d):
    events = fx.table(spark, d, "events").select("event_id")
    known = events.withColumn("known", F.lit(1))
    return sample_rows(events, 1000).join(known, "event_id", "left").agg(
        F.count("*").alias("rows"), F.count_distinct("event_id").alias("ids"), F.count_if(F.col("known").isNull()).alias("strange")
    )


@query(
    "p1_layout_without_ids",
    sql(
        r"""
        select sha256(concat_ws('|', coalesce(cast(tpep_pickup_datetime as varchar), '\N'),
                      coalesce(cast(PULocationID as varchar), '\N'), coalesce(cast(DOLocationID as varchar), '\N'),
                      cast(row_number() over (partition by tpep_pickup_datetime, PULocationID, DOLocationID) as varchar)
               )) as event_id,
               tpep_pickup_datetime as pickup_datetime, cast(PULocationID as varchar) as pickup_zone,
               cast(DOLocationID as varchar) as dropoff_zone
        from raw""",
        "raw",
    ),
)
def p1(spark, d):
    return normalize_trips(fx.raw_trips(spark, d, ids=False))


@query(
    "p10_valid_zone_hour",
    """
    select case when event_type = 'signup' then '' else cast(user_id % 26 as varchar) end as zone,
           cast(hour(ts) as integer) as hour, cast(7 as bigint) as n
    from events
    where event_type not in ('signup', 'error', 'view')
    """,
)
def p10(spark, d):
    # Lines with an empty zone, an hour that is no number, and a missing field are in between the good ones.
    kind, hour = F.col("event_type"), F.hour("ts").cast("string")
    zone = F.when(kind == "signup", "").otherwise((F.col("user_id") % 26).cast("string"))
    lines = fx.table(spark, d, "events").select(
        F.when(kind == "view", F.concat_ws("\t", zone, hour))
        .otherwise(F.concat_ws("\t", zone, F.when(kind == "error", "x").otherwise(hour), F.lit("07")))
        .alias("value")
    )
    return valid_zone_hour(parse_kv_lines(lines))


def in_loads(spark, d, ids, name):
    """Trips of `events` in three files, loaded in two runs and a third that finds nothing new; returns the curated table.
    Each trip is in the file of its date or, one of nine, in the last file."""
    folder, scratch = owned(spark).path(name), owned(spark)
    raw = fx.raw_trips(spark, d, ids)
    at = F.col("tpep_pickup_datetime")
    number = F.when(F.hour(at) * 60 + F.minute(at) < 160, 2).otherwise(F.dayofyear(at) % 2)
    raw = scratch.store(raw.withColumn("file", number), f"{name}-files")
    zones = scratch.store(fx.zones(spark, d), "zones")
    out, state = f"{folder}/curated", f"{folder}/state"
    for numbers in ([0], [1, 2], []):
        for n in numbers:
            raw.filter(F.col("file") == n).drop("file").write.parquet(f"{folder}/in/{n}")
        done = incremental_etl(spark, f"{folder}/in", zones, out, state)
        assert (done is None) == (not numbers)
    return spark.read.parquet(out)


CURATED_COLUMNS = ["event_id", "service_date", "pickup_zone", "pickup_hour", "pickup_zone_name", "dropoff_borough"]


@query(
    "s10_incremental",
    sql("select event_id, cast(event_time as date) as service_date, pickup_zone, pickup_hour, pickup_zone_name, dropoff_borough from curated", "curated"),
)
def s10_incremental(spark, d):
    return in_loads(spark, d, True, "loads").select(*CURATED_COLUMNS)


@query(
    "p2_two_loads",
    sql(
        """select sha256(concat_ws('|', strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S')
                         || case when microsecond(tpep_pickup_datetime) % 1000000 = 0 then ''
                                 else '.' || rtrim(strftime(tpep_pickup_datetime, '%f'), '0') end,
                         cast(PULocationID as varchar), cast(DOLocationID as varchar),
                  cast(row_number() over (partition by tpep_pickup_datetime, PULocationID, DOLocationID) as varchar))) as event_id,
               tpep_pickup_datetime as pickup_datetime, cast(PULocationID as varchar) as pickup_zone
           from raw""",
        "raw",
    ),
)
def p2_loads(spark, d):
    return in_loads(spark, d, False, "id-loads").select("event_id", "pickup_datetime", "pickup_zone")


@query(
    "p15_clustered_filter",
    sql("select * from predictions where pickup_zone = '7' and event_time[1:10] = '2024-01-09'", "predictions"),
)
def p15_clustered(spark, d):
    path = owned(spark).path("clustered")
    write_clustered(fx.predictions(spark, d), path)
    day = F.col("event_time").between("2024-01-09", "2024-01-09T99")
    return for_zone(spark.read.parquet(path), "7").filter(day)
