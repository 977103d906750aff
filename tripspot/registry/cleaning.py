"""Cleaning and scalar functions."""

from pyspark.sql import functions as F

from tripspot import fixtures as fx
from tripspot.functions.calendar import iso_seconds
from tripspot.functions.records import replay_id, surrogate_key
from tripspot.functions.scoring import alert_flag, clamp_score, relative_score, score_level
from tripspot.operators import clean as c
from tripspot.operators.demand import has_borough
from tripspot.operators.evaluation import with_rates
from tripspot.operators.fleet import keyed_only
from tripspot.operators.serving import available_vehicles, for_zone
from tripspot.operators.verify import parse_kv_lines
from tripspot.operators.weather import code_text
from tripspot.registry.base import level_sql, query, sql
from tripspot.streaming.ingest import parse_events

@query(
    "p2_surrogate_ids_of_equal_rows",
    r"""
    select sha256(concat_ws('|', cast(user_id % 26 as varchar), event_type,
           cast(row_number() over (partition by user_id % 26, event_type) as varchar))) as event_id,
           cast(user_id % 26 as varchar) as pickup_zone, event_type
    from events
    """,
)
def p2(spark, d):
    rows = fx.table(spark, d, "events").select(
        (F.col("user_id") % 26).cast("string").alias("pickup_zone"), "event_type"
    )
    return c.with_event_id(rows, ["pickup_zone"])


@query(
    "p3_project_trips",
    sql("select event_id, pickup_datetime, pickup_zone, dropoff_zone from trips", "trips"),
)
def p3(spark, d):
    return c.project_trips(fx.raw_trips(spark, d))


@query("p4_trim_zones", sql("select event_id, pickup_zone, dropoff_zone from trips", "trips"))
def p4(spark, d):
    trips = c.normalize_trips(fx.raw_trips(spark, d))
    padded = trips.withColumns({z: F.concat(F.lit("  "), z, F.lit(" ")) for z in ("pickup_zone", "dropoff_zone")})
    return c.trim_zones(padded).select("event_id", "pickup_zone", "dropoff_zone")


@query(
    "p5_event_time",
    "select event_id, case when event_type <> 'error' then date_trunc('second', ts) end as event_time from events",
)
def p5(spark, d):
    text = F.when(F.col("event_type") == "error", "31/31/2024").otherwise(F.date_trunc("second", "ts").cast("string"))
    rows = fx.table(spark, d, "events").select("event_id", text.alias("pickup_datetime"))
    return c.with_event_time(rows).select("event_id", "event_time")


@query(
    "p6_required_fields",
    sql("select event_id, pickup_zone, dropoff_zone from trips where pickup_zone <> '5' and dropoff_zone <> '7'", "trips"),
)
def p6(spark, d):
    trips = c.project_trips(fx.raw_trips(spark, d)).withColumns(
        {"pickup_zone": F.nullif("pickup_zone", F.lit("5")), "dropoff_zone": F.nullif("dropoff_zone", F.lit("7"))}
    )
    return c.require(trips, ["event_id", "pickup_zone", "dropoff_zone"]).select("event_id", "pickup_zone", "dropoff_zone")


@query(
    "p7_dedup",
    """
    select event_id, pickup_datetime, pickup_zone, value from (
        select user_id as event_id, ts as pickup_datetime, event_type as pickup_zone, value,
               row_number() over (partition by user_id order by ts, event_type, value) as r
        from events) where r = 1
    """,
)
def p7(spark, d):
    # Users stand for ids, so each id has many copies.
    rows = fx.table(spark, d, "events").select(
        F.col("user_id").alias("event_id"), F.col("ts").alias("pickup_datetime"),
        F.col("event_type").alias("pickup_zone"), "value",
    )
    return c.dedup(rows)


@query("p8_calendar", sql("select event_id, pickup_hour, pickup_dow from trips", "trips"))
def p8(spark, d):
    trips = c.with_event_time(c.project_trips(fx.raw_trips(spark, d)))
    return c.with_calendar(trips).select("event_id", "pickup_hour", "pickup_dow")


@query("p9_since", "select o_orderkey, cast(o_orderdate as date) as service_date from orders where o_orderdate >= date '1998-01-01'")
def p9(spark, d):
    orders = fx.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("service_date"))
    return c.since(orders, "service_date", "1998-01-01")


@query(
    "p11_non_empty",
    """select event_id, ts, event_type from events where event_type not in ('error', 'signup')""",
)
def p11(spark, d):
    kind = F.col("event_type")
    rows = fx.table(spark, d, "events").select(
        "event_id", "ts", F.when(kind == "error", "").when(kind == "signup", F.lit(None)).otherwise(kind).alias("event_type")
    )
    return c.non_empty(rows, ["ts", "event_type"])


@query("p12_hour_key", "select event_id, strftime(ts, '%Y-%m-%dT%H') as weather_hour from events")
def p12(spark, d):
    return c.with_hour_key(fx.table(spark, d, "events"), "ts").select("event_id", "weather_hour")


@query(
    "p13_clamp_score",
    """select event_id, least(greatest(coalesce(case when event_type <> 'error' then value * 3 - 50 end, 0.0), 0.0), 100.0)
              as hotspot_score from events""",
)
def p13(spark, d):
    score = F.when(F.col("event_type") != "error", F.col("value") * 3 - 50)
    return fx.table(spark, d, "events").select("event_id", clamp_score(score).alias("hotspot_score"))


@query(
    "p14_score_level",
    sql(f"select event_id, {level_sql('hotspot_score', 'vi')} as hotspot_level from predictions", "predictions"),
)
def p14(spark, d):
    return fx.predictions(spark, d).select("event_id", score_level("hotspot_score").alias("hotspot_level"))


@query("p15_zone_filter", sql("select * from predictions where pickup_zone = '7'", "predictions"))
def p15(spark, d):
    return for_zone(fx.predictions(spark, d), " 7 ")


@query("p15_all_zones", sql("select * from predictions", "predictions"))
def p15_all(spark, d):
    return for_zone(fx.predictions(spark, d), "")


@query(
    "p16_has_borough",
    sql("select event_id, pickup_zone, pickup_borough from curated where pickup_borough is not null", "curated"),
)
def p16(spark, d):
    return has_borough(fx.curated_trips(spark, d)).select("event_id", "pickup_zone", "pickup_borough")


@query(
    "p17_available_vehicles",
    sql("select vehicle_id, pickup_zone, updated_at from vehicles where status = 'available'", "vehicles"),
)
def p17(spark, d):
    return available_vehicles(fx.vehicles(spark, d))


@query(
    "p18_keyed_vehicles",
    sql("select vehicle_id, simulation_cycle from vehicles where status = 'available'", "vehicles"),
)
def p18(spark, d):
    free = F.col("status") == "available"
    blank = F.when(F.col("simulation_cycle") % 2 == 0, "")
    rows = fx.vehicles(spark, d).withColumn("vehicle_id", F.when(free, F.col("vehicle_id")).otherwise(blank))
    return keyed_only(rows).select("vehicle_id", "simulation_cycle")


@query(
    "f2_parse_events",
    sql(
        """select p.event_id, cast(replace(p.event_time, 'T', ' ') as timestamp) as event_time, pickup_zone, dropoff_zone,
                  pickup_hour, pickup_dow
           from predictions p join events e on p.event_id = cast(e.event_id as varchar) where event_type <> 'error'""",
        "predictions",
    ),
)
def f2(spark, d):
    return parse_events(fx.messages(spark, d)).drop("pickup_datetime")


@query(
    "f3_string_functions",
    """
    select event_type as zone, cast(hour(ts) as integer) as hour, 1::bigint as n
    from events where event_type <> 'error' and user_id % 7 <> 0
    """,
)
def f3(spark, d):
    # Padded zones, hours with leading zeros or no digits, lines with a field too few: trimmed, split, matched and cast.
    padded = F.concat(F.lit("  "), "event_type", F.lit(" "))
    rows = c.trim_zones(fx.table(spark, d, "events").withColumns({"pickup_zone": padded, "dropoff_zone": padded}))
    hour = F.when(F.col("event_type") == "error", "x1").otherwise(F.lpad(F.hour("ts").cast("string"), 2, "0"))
    third = F.when(F.col("user_id") % 7 != 0, "1")  # a null is left out by concat_ws
    return c.valid_zone_hour(parse_kv_lines(rows.select(F.concat_ws("\t", "pickup_zone", hour, third).alias("value"))))


@query(
    "f4_hash_keys",
    sql(
        """
        select event_id, sha256(concat_ws('|', cast(pickup_datetime as varchar), pickup_zone, dropoff_zone)) as key_256,
               sha1(concat_ws('|', cast(pickup_datetime as varchar), pickup_zone, dropoff_zone, event_id)) as key_1
        from trips""",
        "trips",
    ),
)
def f4(spark, d):
    return c.project_trips(fx.raw_trips(spark, d)).select(
        "event_id",
        surrogate_key("pickup_datetime", "pickup_zone", "dropoff_zone").alias("key_256"),
        replay_id("pickup_datetime", "pickup_zone", "dropoff_zone", "event_id").alias("key_1"),
    )


@query(
    "f5_date_functions",
    """
    select event_id, cast(ts as date) as service_date, strftime(ts, '%Y-%m-%dT%H') as weather_hour,
           cast(hour(ts) as integer) as pickup_hour, cast(dayofweek(ts) as integer) as pickup_dow, strftime(ts, '%Y-%m-%dT%H:%M:%S') as second
    from events where event_type <> 'error' and ts >= timestamp '2024-01-05 00:00:00'
    """,
)
def f5(spark, d):
    # Times as text, some of which no time can be read from.
    text = F.when(F.col("event_type") == "error", "soon").otherwise(F.col("ts").cast("string"))
    rows = fx.table(spark, d, "events").select("event_id", text.alias("pickup_datetime"))
    timed = c.with_hour_key(c.with_calendar(c.require(c.with_event_time(rows), ["event_time"])))
    dated = c.since(timed.withColumn("service_date", F.to_date("event_time")), "service_date", "2024-01-05")
    return dated.select("event_id", "service_date", "weather_hour", "pickup_hour", "pickup_dow", iso_seconds("event_time").alias("second"))


@query(
    "f6_f7_f8_math_conditional_cast",
    f"""
    select event_id, least(greatest(coalesce(v, 0.0), 0.0), 100.0) as bounded, round(v / greatest(user_id % 26, 1.0) * 100.0, 2) as share,
           {level_sql("coalesce(v, 0.0)")} as level, case when v > user_id % 100 then 'CRITICAL_ANOMALY' else 'NORMAL' end as flag,
           cast(cast(v as integer) as varchar) as code, case when tp + fp <> 0 then tp / (tp + fp) end as precision,
           case when tp + fn <> 0 then tp / (tp + fn) end as recall
    from (select event_id, user_id, case when event_type <> 'view' then floor(value * 3 - 50) end as v,
                 user_id % 2 as tp, user_id % 3 as fp, user_id % 5 as fn from events)
    """,
)
def f6(spark, d):
    value, user = F.when(F.col("event_type") != "view", F.floor(F.col("value") * 3 - 50).cast("double")), F.col("user_id")
    rows = fx.table(spark, d, "events").withColumns(
        {"v": value, "true_positive": user % 2, "false_positive": user % 3, "false_negative": user % 5}
    )
    return with_rates(rows).select(
        "event_id", clamp_score("v").alias("bounded"), relative_score("v", (user % 26).cast("double")).alias("share"),
        score_level("v", "en").alias("level"), alert_flag("v", (user % 100).cast("double")).alias("flag"), code_text("v").alias("code"),
        "precision", "recall",
    )
