"""Joins, set operations and checks."""

from datetime import datetime

from pyspark.sql import functions as F

from tripspot import fixtures as fx
from tripspot.functions.fixed import WEATHER_FIELDS
from tripspot.functions.labels import weather_label
from tripspot.operators import hashtree, serving, verify
from tripspot.operators.baseline import flag_anomaly, historical_baseline, with_threshold
from tripspot.operators.clean import normalize_trips, clean_trips, with_hour_key
from tripspot.operators.demand import zone_hour_counts
from tripspot.operators.enrich import enrich_zones
from tripspot.operators.fleet import changed_between, latest_state
from tripspot.operators.forecast import forecast_grid, next_hours, top_zones_per_hour, zone_map
from tripspot.operators.rows import checked_broadcast
from tripspot.operators.score import daily_scores, temporal_split
from tripspot.operators.weather import (
    explode_hourly, fill_weather, hourly_side, join_weather, merge_latest, weather_outlook,
)
from tripspot.registry.base import label_sql, owned, query, sql
from tripspot.sources.sinks import write_report, write_zone_hour_tsv
from tripspot.sources.trips import read_zone_hour_tsv
from tripspot.sources.weather import read_weather_json
from tripspot.sources.zones import zones_from_geojson

NOW = datetime(2024, 1, 15, 9, 40)
FALLBACK = {"temperature_2m": 4.5, "precipitation": 0.25, "snowfall": 1.0, "weather_code": 3.0}
ROUNDED_LIMITS = """round(case when n >= 5 then mean else {sparse} end, 6) as historical_mean_score,
                    round(case when n >= 5 then stddev else 0.0 end, 6) as historical_stddev_score,
                    round(case when n >= 5 then least(100.0, round(mean + 3 * stddev, 9)) else 100.0 end, 6) as anomaly_threshold,
                    cast(coalesce(n, 0) as integer) as historical_baseline_samples"""
# As published: two places, half away from zero, on the decimal value.
LIMITS = """round(cast(case when n >= 5 then mean else {sparse} end as decimal(18, 9)), 2)::double as historical_mean_score,
            round(cast(case when n >= 5 then stddev else 0.0 end as decimal(18, 9)), 2)::double as historical_stddev_score,
            round(cast(case when n >= 5 then least(100.0, round(mean + 3 * stddev, 9)) else 100.0 end as decimal(18, 9)), 2)::double
            as anomaly_threshold"""
LIMIT_COLUMNS = ("historical_mean_score", "historical_stddev_score", "anomaly_threshold")


def scores(spark, d):
    return daily_scores(fx.demand_trips(spark, d))


def stored_baseline(spark, d):
    """The baseline as a job finds it: a small Parquet table."""
    path = owned(spark).path("baseline")
    write_report(historical_baseline(temporal_split(scores(spark, d)).train), path, fmt="parquet")
    return checked_broadcast(spark.read.parquet(path))


def stored_weather(spark, d):
    path = owned(spark).path("hours")
    write_report(fx.weather(spark, d), path, fmt="parquet")
    return hourly_side(spark.read.parquet(path))


def rounded(df, cols, places=6):
    return df.withColumns({c: F.round(c, places) for c in cols})


@query("j1_enrich_zones", sql("select * from curated", "curated"))
def j1(spark, d):
    trips = clean_trips(normalize_trips(fx.raw_trips(spark, d)))
    return enrich_zones(trips, fx.zones(spark, d))


@query(
    "j2_weather_training_join",
    sql(
        """select s.*, w.* exclude (weather_hour, weather_code), 0.0::double as weather_missing,
                  cast(cast(weather_code as integer) as varchar) as weather_code
           from scores s join demand_weather w using (weather_hour)""",
        "scores", "demand_weather",
    ),
)
def j2(spark, d):
    return join_weather(scores(spark, d), fx.demand_weather(spark, d))


FILLED = """coalesce(temperature_2m, 4.5) as temperature_2m, coalesce(precipitation, 0.25) as precipitation,
            coalesce(snowfall, 1.0) as snowfall, coalesce(wind_speed_10m, 0.0) as wind_speed_10m,
            coalesce(relative_humidity_2m, 0.0) as relative_humidity_2m,
            cast(cast(coalesce(weather_code, 3.0) as integer) as varchar) as weather_code"""
GAP = "(temperature_2m is null or precipitation is null or weather_code is null)"


@query(
    "j3_weather_serving_join",
    sql(
        f"""select event_id, weather_hour, {FILLED}, case when {GAP} then 1.0 else 0.0 end::double as weather_missing,
                   case when {GAP} then 'historical_fallback' else 'Open-Meteo forecast' end as weather_source
            from (select event_id, strftime(event_time, '%Y-%m-%dT%H') as weather_hour from trips)
            left join weather using (weather_hour)""",
        "trips", "weather",
    ),
)
def j3(spark, d):
    trips = with_hour_key(clean_trips(normalize_trips(fx.raw_trips(spark, d)))).select("event_id", "weather_hour")
    return fill_weather(trips, stored_weather(spark, d), FALLBACK)


@query(
    "j4_baseline_threshold",
    sql(
        f"""select t.service_date, t.pickup_zone, t.pickup_hour, {ROUNDED_LIMITS.format(sparse="100.0")}
            from test t left join baseline using (pickup_zone, pickup_hour, pickup_dow)""",
        "test", "baseline",
    ),
)
def j4(spark, d):
    limits = with_threshold(temporal_split(scores(spark, d)).test, stored_baseline(spark, d))
    return rounded(limits, LIMIT_COLUMNS).select(
        "service_date", "pickup_zone", "pickup_hour", *LIMIT_COLUMNS, "historical_baseline_samples"
    )


@query(
    "j4_sparse_baseline_threshold",
    sql(
        f"""select p.event_id, {ROUNDED_LIMITS.format(sparse="0.0")}
            from predictions p left join baseline using (pickup_zone, pickup_hour, pickup_dow)""",
        "predictions", "baseline",
    ),
)
def j4_sparse(spark, d):
    # Most hours of the predictions have no baseline at all.
    limits = with_threshold(fx.predictions(spark, d), stored_baseline(spark, d), sparse_mean=0.0)
    return rounded(limits, LIMIT_COLUMNS).select("event_id", *LIMIT_COLUMNS, "historical_baseline_samples")


@query(
    "j5_positional_zip",
    sql(
        """select l.position, vehicle_id, updated_at, target_zone, hotspot_score
           from (select *, row_number() over (order by updated_at desc, vehicle_id) - 1 as position
                 from vehicles where status = 'available') l
           join (select pickup_zone as target_zone, hotspot_score,
                        row_number() over (order by hotspot_score desc, pickup_zone) - 1 as position
                 from zone_means) r using (position)""",
        "vehicles", "zone_means",
    ),
)
def j5(spark, d):
    zones = serving.zone_means(fx.predictions(spark, d)).select(F.col("pickup_zone").alias("target_zone"), "hotspot_score")
    pairs = serving.rank_zip(
        serving.available_vehicles(fx.vehicles(spark, d)).drop("pickup_zone"),
        ["-updated_at", "vehicle_id"],
        zones,
        ["-hotspot_score", "target_zone"],
        scratch=owned(spark),
    )
    return pairs.select("position", "vehicle_id", "updated_at", "target_zone", "hotspot_score")


@query(
    "j6_forecast_grid",
    sql(
        """select pickup_zone, forecast_time, strftime(forecast_time, '%Y-%m-%dT%H') as weather_hour,
                  cast(hour(forecast_time) as integer) as pickup_hour,
                  cast(dayofweek(forecast_time) as integer) as pickup_dow
           from (select distinct pickup_zone from predictions),
                (select timestamp '2024-01-15 10:00:00' + to_hours(cast(i as integer)) as forecast_time from range(6) r(i))""",
        "predictions",
    ),
)
def j6(spark, d):
    return forecast_grid(next_hours(NOW, 9), fx.predictions(spark, d).select("pickup_zone").distinct())


@query(
    "j7_diff_of_aggregates",
    sql(
        """with a as (select pickup_zone, pickup_hour, count(*) as trip_count from trips group by all),
                b as (select dropoff_zone as pickup_zone, pickup_hour, count(*) as trip_count from trips group by all)
           select pickup_zone, pickup_hour, a.trip_count as a_trip_count, b.trip_count as b_trip_count
           from a full join b using (pickup_zone, pickup_hour)
           where a.trip_count is distinct from b.trip_count""",
        "trips",
    ).replace("\nwith a as", ",\na as", 1),
)
def j7(spark, d):
    trips = clean_trips(normalize_trips(fx.raw_trips(spark, d)))
    drops = trips.select(F.col("dropoff_zone").alias("pickup_zone"), "pickup_hour")
    keys = ["pickup_zone", "pickup_hour"]
    return verify.diff_keyed(zone_hour_counts(trips), zone_hour_counts(drops), keys, ["trip_count"])


@query(
    "j8_weather_labels",
    sql(f"select weather_hour, {label_sql('weather_code')} as description from all_weather", "all_weather"),
)
def j8(spark, d):
    return fx.all_weather(spark, d).select("weather_hour", weather_label("weather_code").alias("description"))


SNAPSHOT = """select * exclude (r) from (select *, row_number() over (
                  partition by vehicle_id order by updated_at desc, simulation_cycle desc) as r
              from vehicles where {}) where r = 1"""


@query(
    "j9_changed_vehicles",
    sql(
        f"""select vehicle_id, a.latitude is distinct from b.latitude or a.longitude is distinct from b.longitude
                   or a.simulation_cycle is distinct from b.simulation_cycle as changed
            from ({SNAPSHOT.format("updated_at < '2024-01-15'")}) a full join ({SNAPSHOT.format("true")}) b
            using (vehicle_id)""",
        "vehicles",
    ),
)
def j9(spark, d):
    vehicles = fx.vehicles(spark, d)
    before = latest_state(vehicles.filter(F.col("updated_at") < "2024-01-15"))
    return changed_between(before, latest_state(vehicles)).select("vehicle_id", "changed")


HOUR_SCORES = """select event_time[1:13] as weather_hour, pickup_zone, round(max(hotspot_score), 2) as hotspot_score
                 from predictions group by all"""


def hour_scores(spark, d):
    hour = F.substring("event_time", 1, 13).alias("weather_hour")
    return fx.predictions(spark, d).groupBy(hour, "pickup_zone").agg(F.round(F.max("hotspot_score"), 2).alias("hotspot_score"))


@query(
    "j10_zone_map",
    sql(
        f"""select cast(LocationID as varchar) as pickup_zone, Zone as zone_name,
                   coalesce(hotspot_score, 0.0) as hotspot_score, hotspot_score is not null as forecast_known,
                   case when hotspot_score >= 50 then 'hot' when hotspot_score >= 25 then 'medium' else 'low' end as map_class
            from zones left join (select * from ({HOUR_SCORES}) where weather_hour = '2024-01-15T10') h
            on cast(LocationID as varchar) = pickup_zone""",
        "zones", "predictions",
    ),
)
def j10(spark, d):
    zones = fx.zones(spark, d).select(F.col("LocationID").cast("string").alias("pickup_zone"), F.col("Zone").alias("zone_name"))
    return zone_map(zones, hour_scores(spark, d), "2024-01-15T10")


@query(
    "o7_zones_per_hour",
    sql(
        f"""select * from (select *, cast(row_number() over (
                partition by weather_hour order by hotspot_score desc, pickup_zone) as integer) as rank
            from ({HOUR_SCORES})) where rank <= 5""",
        "predictions",
    ),
)
def o7(spark, d):
    return top_zones_per_hour(hour_scores(spark, d), 5)


@query(
    "t3_anomaly_flags",
    sql(
        f"""select service_date, pickup_zone, pickup_hour, historical_baseline_samples, {LIMITS.format(sparse="100.0")},
                   case when hotspot_score > t then 'CRITICAL_ANOMALY' else 'NORMAL' end as alert_flag
            from (select s.*, n, mean, stddev, cast(coalesce(n, 0) as integer) as historical_baseline_samples,
                         case when n >= 5 then least(100.0, round(mean + 3 * stddev, 9)) else 100.0 end as t
                  from test s left join baseline using (pickup_zone, pickup_hour, pickup_dow))""",
        "test", "baseline",
    ),
)
def t3(spark, d):
    flagged = flag_anomaly(temporal_split(scores(spark, d)).test, stored_baseline(spark, d))
    return flagged.select("service_date", "pickup_zone", "pickup_hour", "historical_baseline_samples", *LIMIT_COLUMNS, "alert_flag")


WEATHER_ROWS = sql("select * from all_weather", "all_weather")


def payload(weather, by):
    """Weather rows as documents of parallel arrays, one per value of `by` (a month, a week)."""
    rows = F.sort_array(F.collect_list(F.struct("weather_hour", *WEATHER_FIELDS)))
    arrays = [F.transform("rows.weather_hour", lambda hour: F.concat(hour, F.lit(":00"))).alias("time")]
    arrays += [F.col(f"rows.{name}").alias(name) for name in WEATHER_FIELDS]
    return weather.groupBy(by).agg(rows.alias("rows")).select(F.struct(*arrays).alias("hourly"))


@query("f1_explode_hourly", WEATHER_ROWS)
def f1(spark, d):
    return explode_hourly(payload(fx.all_weather(spark, d), F.substring("weather_hour", 1, 10)))


@query(
    "s18_weather_documents",
    sql(
        """select * replace (case when weather_hour >= '2024-01-16' then temperature_2m + 1 else temperature_2m end
                             as temperature_2m) from all_weather""",
        "all_weather",
    ),
)
def s18(spark, d):
    # Two sets of documents; the second repeats the later days with other values and wins.
    weather = fx.all_weather(spark, d)
    later = weather.filter(F.col("weather_hour") >= "2024-01-16").withColumn("temperature_2m", F.col("temperature_2m") + 1)
    # One document to a file.
    path, day = owned(spark).path("weather"), F.substring("weather_hour", 1, 10)
    for name, part in (("first", weather), ("second", later)):
        payload(part, day).write.option("maxRecordsPerFile", 1).json(f"{path}/{name}")
    return read_weather_json(spark, f"{path}/first", f"{path}/second")


@query(
    "u1_merge_latest",
    sql(
        """select weather_hour, case when weather_hour >= '2024-01-10' then -1.0 else temperature_2m end as temperature_2m
           from all_weather""",
        "all_weather",
    ),
)
def u1(spark, d):
    old = fx.all_weather(spark, d)
    new = old.filter(F.col("weather_hour") >= "2024-01-10").withColumn("temperature_2m", F.lit(-1.0))
    columns = ["weather_hour", "temperature_2m"]
    return merge_latest([old.select(*columns), new.select(*columns)])


@query(
    "u1_repeated_hours",
    sql("select weather_hour, temperature_2m + 3 as temperature_2m from all_weather", "all_weather"),
)
def u1_repeated(spark, d):
    # A document that has each hour three times with other values: the last of them counts.
    rows = fx.all_weather(spark, d).withColumn("i", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])))
    ordered = F.sort_array(F.collect_list(F.struct("i", "weather_hour", (F.col("temperature_2m") + F.col("i")).alias("t"))))
    documents = rows.groupBy(F.substring("weather_hour", 1, 10).alias("day")).agg(ordered.alias("rows"))
    hourly = F.struct(F.col("rows.weather_hour").alias("time"), F.col("rows.t").alias("temperature_2m"))
    exploded = explode_hourly(documents.select(hourly.alias("hourly")), position="place")
    return merge_latest([exploded], position="place").select("weather_hour", "temperature_2m")


@query(
    "u2_row_differences",
    sql(
        """select pickup_zone, pickup_hour, sum(side)::bigint as surplus
           from (select pickup_zone, pickup_hour, 1 as side from trips
                 union all select dropoff_zone, pickup_hour, -1 from trips)
           group by all having sum(side) <> 0""",
        "trips",
    ),
)
def u2(spark, d):
    trips = clean_trips(normalize_trips(fx.raw_trips(spark, d)))
    drops = trips.select(F.col("dropoff_zone").alias("pickup_zone"), "pickup_hour")
    return verify.row_differences(trips.select("pickup_zone", "pickup_hour"), drops)


@query(
    "u2_same_rows",
    sql("select count(*) as groups, true as same from (select distinct pickup_zone, pickup_hour from trips)", "trips"),
)
def u2_same(spark, d):
    trips = clean_trips(normalize_trips(fx.raw_trips(spark, d)))
    counts = zone_hour_counts(trips)
    same = verify.same_rows(counts, zone_hour_counts(trips.repartition(16)))
    return counts.agg(F.count("*").alias("groups")).select("groups", F.lit(same).alias("same"))


CHANGED = """select event_id, event_type, case when event_id % 97 = 0 then value + 1 else value end as value, user_id
             from events, range(1, 4) r(copy) where copy <= case when event_id % 101 = 0 then 0 when event_id % 103 = 0 then 3 else 1 end"""
GIVEN = "select event_id, event_type, value, user_id from events"


def given_and_changed(spark, d):
    """Events, and events of which some have another value, some are missing and some are there three times."""
    given = fx.table(spark, d, "events").select("event_id", "event_type", "value", "user_id")
    times = F.when(F.col("event_id") % 101 == 0, 0).when(F.col("event_id") % 103 == 0, 3).otherwise(1)
    changed = given.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).drop("_copy")
    return given, changed.withColumn("value", F.when(F.col("event_id") % 97 == 0, F.col("value") + 1).otherwise(F.col("value")))


@query(
    "u2_tree_diff",
    f"""select *, 'given' as side from (({GIVEN}) except all ({CHANGED}))
        union all select *, 'changed' as side from (({CHANGED}) except all ({GIVEN}))""",
)
def u2_tree(spark, d):
    given, changed = given_and_changed(spark, d)
    found = hashtree.tree_differences(given, changed.repartition(5), owned(spark), enough=50)
    copies = F.explode(F.array_repeat(F.when(F.col("surplus") > 0, "given").otherwise("changed"), F.abs("surplus").cast("int")))
    return found.withColumn("side", copies).drop("surplus")


@query(
    "j7_tree_diff_keyed",
    f"""with a as (select event_type, user_id, count(*) as n from ({GIVEN}) group by all),
             b as (select event_type, user_id, count(*) as n from ({CHANGED}) group by all)
        select event_type, user_id, a.n as a_n, b.n as b_n from a full join b using (event_type, user_id) where a.n is distinct from b.n""",
)
def j7_tree(spark, d):
    a, b = (df.groupBy("event_type", "user_id").agg(F.count("*").alias("n")) for df in given_and_changed(spark, d))
    return hashtree.tree_diff_keyed(a, b, ["event_type", "user_id"], ["n"], owned(spark), enough=50)


@query(
    "v1_crosscheck",
    sql("select count(*) as groups, 0::bigint as differences from (select distinct pickup_zone, pickup_hour from trips)", "trips"),
)
def v1(spark, d):
    trips = clean_trips(normalize_trips(fx.raw_trips(spark, d)))
    path = owned(spark).path("kv")
    write_zone_hour_tsv(trips, path)
    differences = verify.crosscheck_zone_hour(trips, read_zone_hour_tsv(spark, path)).count()
    groups = zone_hour_counts(trips).agg(F.count("*").alias("groups"))
    return groups.select("groups", F.lit(differences).cast("long").alias("differences"))


MOVED = f"""select a.latitude is distinct from b.latitude or a.longitude is distinct from b.longitude
                   or a.simulation_cycle is distinct from b.simulation_cycle as changed
            from ({SNAPSHOT.format("updated_at < '2024-01-15'")}) a full join fleet b using (vehicle_id)"""


@query(
    "v4_run_checks",
    sql(
        """select 'prediction_records' as check, count(*) > 0 as passed from predictions
           union all select 'hotspot_explanations', count(*) > 0 from zone_means
           union all select 'fleet_records', count(*) >= 40 from fleet
           union all select 'fleet_moved', bool_or(changed) from (""" + MOVED + ")",
        "predictions", "zone_means", "fleet",
    ).replace(" as check", ' as "check"'),
)
def v4(spark, d):
    vehicles = fx.vehicles(spark, d)
    after = latest_state(vehicles)
    before = latest_state(vehicles.filter(F.col("updated_at") < "2024-01-15"))
    preds = fx.predictions(spark, d)
    return verify.run_checks(preds, serving.zone_ranking(preds), after, changed_between(before, after))


@query(
    "v4_failed_checks",
    sql(
        """select 'prediction_records' as check, count(*) > 0 as passed from predictions
           union all select 'hotspot_explanations', min(case when cast(pickup_zone as integer) > 3 then sample_count else 0 end) > 0 from zone_means
           union all select 'fleet_records', count(*) >= 41 from fleet
           union all select 'fleet_moved', count(*) < 0 from fleet""",
        "predictions", "zone_means", "fleet",
    ).replace(" as check", ' as "check"'),
)
def v4_failed(spark, d):
    # A fleet that stands still and is one vehicle short; zones without an explanation.
    fleet, preds = latest_state(fx.vehicles(spark, d)), fx.predictions(spark, d)
    known = F.when(F.col("pickup_zone").cast("int") > 3, F.col("sample_count")).otherwise(0)
    ranking = serving.zone_means(preds).withColumn("sample_count", known)
    return verify.run_checks(preds, ranking, fleet, changed_between(fleet, fleet), fleet=41)


@query(
    "m10_weather_outlook",
    sql(
        f"""select cast(i as integer) as "offset", hour_start, weather_hour, {FILLED},
                   case when {GAP} then 1.0 else 0.0 end::double as weather_missing,
                   case when {GAP} then 'historical_fallback' else 'Open-Meteo forecast' end as weather_source,
                   {label_sql("coalesce(weather_code, 3.0)")} as description,
                   case when i = 0 then 'Hiện tại · ' else '' end || strftime(hour_start, '%H:%M') as label
            from (select i, hour_start, strftime(hour_start, '%Y-%m-%dT%H') as weather_hour
                  from (select i, timestamp '2024-01-15 09:00:00' + to_hours(cast(i as integer)) as hour_start from range(4) r(i)))
            left join weather using (weather_hour)""",
        "weather",
    ),
)
def m10(spark, d):
    return weather_outlook(NOW, fx.weather(spark, d), FALLBACK)


@query(
    "s19_zones_from_geojson",
    sql("select distinct cast(LocationID as varchar) as pickup_zone from zones", "zones"),
)
def s19(spark, d):
    path = owned(spark).path("geojson")
    feature = F.struct(F.struct(F.col("LocationID").cast("string").alias("LocationID")).alias("properties"))
    write_report(fx.zones(spark, d).agg(F.collect_list(feature).alias("features")), path)
    return zones_from_geojson(spark, path)


@query(
    "s19_zones_seen",
    sql("select distinct pickup_zone from predictions", "predictions"),
)
def s19_seen(spark, d):
    return zones_from_geojson(spark, owned(spark).path("absent"), fx.predictions(spark, d))
