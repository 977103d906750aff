"""Counts, windows, orders and serving queries."""

from pyspark.sql import Window, functions as F

from tripspot import fixtures as fx
from tripspot.functions.geo import great_circle_m
from tripspot.operators import demand, enrich, evaluation, fleet, mergeable, score, serving, verify, weather
from tripspot.operators.baseline import historical_baseline
from tripspot.operators.clean import clean_trips, normalize_trips, valid_zone_hour, with_hour_key
from tripspot.plans.etl import run_etl
from tripspot.plans.reports import save_reports
from tripspot.operators.routes import route_progress
from tripspot.registry.base import level_sql, owned, query, sql
from tripspot.registry.joins import rounded, scores
from tripspot.registry.scans import PROFILE, TOP, ZONE_HOURS
from tripspot.streaming.replay import stamp_replay


def trips(spark, d):
    return clean_trips(normalize_trips(fx.raw_trips(spark, d)))


@query("a1_zone_hour_counts", ZONE_HOURS)
def a1(spark, d):
    return demand.zone_hour_counts(trips(spark, d))


@query("a1_zone_hour_counts_of_records", ZONE_HOURS)
def a1_records(spark, d):
    records = verify.parse_kv_lines(verify.kv_lines(trips(spark, d)))
    return demand.zone_hour_counts(valid_zone_hour(records))


@query(
    "a2_zone_hour_dow_counts",
    sql("select pickup_zone, pickup_hour, pickup_dow, cast(count(*) as double) as trip_count from demand group by all", "demand"),
)
def a2(spark, d):
    return demand.zone_hour_dow_counts(fx.demand_trips(spark, d))


@query("a3_daily_demand", sql("select * from daily", "daily"))
def a3(spark, d):
    return demand.daily_demand(fx.demand_trips(spark, d))


@query("a4_top_zone_hour_dow", sql(TOP, "curated"))
def a4(spark, d):
    return demand.top_zone_hour_dow(fx.curated_trips(spark, d))


@query("a5_borough_hour_profile", sql(PROFILE, "curated"))
def a5(spark, d):
    return demand.borough_hour_profile(fx.curated_trips(spark, d))


@query(
    "a6_enrichment_quality",
    sql(
        """select count(*) as after_enrichment, count(*) filter (where pickup_zone_name is null) as unmatched_pickup,
                  count(*) filter (where dropoff_zone_name is null) as unmatched_dropoff from curated""",
        "curated",
    ),
)
def a6(spark, d):
    return enrich.enrichment_quality(fx.curated_trips(spark, d))


@query("a7_duplicate_keys", "select l_orderkey, count(*) as copies from lineitem group by all having count(*) > 1")
def a7(spark, d):
    return enrich.duplicate_keys(fx.table(spark, d, "lineitem"), "l_orderkey")


@query(
    "a7_unique_zones",
    sql(
        """select LocationID, count(*) as copies from (select LocationID from zones union all select 3 union all select 7 union all select 7)
           group by all having count(*) > 1""",
        "zones",
    ),
)
def a7_zones(spark, d):
    # A zone table in which two ids are repeated.
    zones = fx.zones(spark, d)
    again = zones.filter("LocationID in (3, 7)").withColumn("_n", F.explode(F.sequence(F.lit(1), F.when(F.col("LocationID") == 7, 2).otherwise(1))))
    return enrich.duplicate_keys(zones.unionByName(again.drop("_n")), "LocationID")


@query(
    "a9_historical_baseline",
    sql(
        """select pickup_zone, pickup_hour, pickup_dow, round(mean, 6) as mean, round(stddev, 6) as stddev, n as count
           from baseline""",
        "baseline",
    ),
)
def a9(spark, d):
    baseline = historical_baseline(score.temporal_split(scores(spark, d)).train)
    return rounded(baseline, ["mean", "stddev"])


@query(
    "a10_weather_medians",
    sql(
        """select median(temperature_2m) as temperature_2m, median(precipitation) as precipitation,
                  median(snowfall) as snowfall, median(wind_speed_10m) as wind_speed_10m,
                  median(relative_humidity_2m) as relative_humidity_2m
           from train join demand_weather using (weather_hour)""",
        "train", "demand_weather",
    ),
)
def a10(spark, d):
    split = score.temporal_split(scores(spark, d))
    return weather.weather_medians(weather.join_weather(split.train, fx.demand_weather(spark, d)), exact=True)


MEDIAN_FIELDS = ("temperature_2m", "precipitation", "snowfall", "wind_speed_10m", "relative_humidity_2m")


@query(
    "a10_production_medians",
    "select " + ", ".join(f"true as {name}" for name in MEDIAN_FIELDS),
)
def a10_production(spark, d):
    """The form that training uses: each value's rank is within a hundredth of the middle."""
    rows = weather.join_weather(score.temporal_split(scores(spark, d)).train, fx.demand_weather(spark, d))
    found = weather.weather_medians(rows).first()
    below = [F.avg((F.col(n) < found[n]).cast("double")).alias(f"{n}_low") for n in MEDIAN_FIELDS]
    upto = [F.avg((F.col(n) <= found[n]).cast("double")).alias(f"{n}_high") for n in MEDIAN_FIELDS]
    ranks = rows.agg(*below, *upto)
    return ranks.select(*[((F.col(f"{n}_low") <= 0.51) & (F.col(f"{n}_high") >= 0.49)).alias(n) for n in MEDIAN_FIELDS])


@query(
    "a11_mode_of_weather_code",
    sql(
        """select cast(cast(weather_code as integer) as varchar) as weather_code, count(*) as count
           from train join demand_weather using (weather_hour) group by all order by count desc, weather_code limit 1""",
        "train", "demand_weather",
    ),
)
def a11(spark, d):
    split = score.temporal_split(scores(spark, d))
    return weather.mode_of(weather.join_weather(split.train, fx.demand_weather(spark, d)), "weather_code")


# Predictions that err to both sides, so that each kind of error occurs.
EVAL = "(select hotspot_score as y, 0.8 * hotspot_score + case when pickup_hour % 2 = 0 then 25 else -15 end as p from scores)"


def guess(a, even, odd):
    return F.col("hotspot_score") * a + F.when(F.col("pickup_hour") % 2 == 0, even).otherwise(odd)


def evaluated(spark, d):
    return scores(spark, d).withColumn("predicted_hotspot_score", guess(0.8, 25, -15))


CONFUSION = """count(*) filter (where y >= 50 and p >= 50) as true_positive,
               count(*) filter (where y < 50 and p >= 50) as false_positive,
               count(*) filter (where y >= 50 and p < 50) as false_negative"""
ERRORS = """round(avg(abs(y - p)), 6) as mae, round(sqrt(avg((y - p) * (y - p))), 6) as rmse,
            round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) as r2"""


@query("a12_confusion", sql(f"select {CONFUSION} from {EVAL}", "scores"))
def a12(spark, d):
    return evaluation.confusion(evaluated(spark, d))


@query("a13_regression_metrics", sql(f"select {ERRORS} from {EVAL}", "scores"))
def a13(spark, d):
    return rounded(evaluation.regression_metrics(evaluated(spark, d)), ["mae", "rmse", "r2"])


RATES = """true_positive / nullif(true_positive + false_positive, 0) as precision,
           true_positive / nullif(true_positive + false_negative, 0) as recall"""


@query("a14_precision_recall", sql(f"select *, {RATES} from (select {CONFUSION}, count(*) as rows from {EVAL})", "scores"))
def a14(spark, d):
    return evaluation.precision_recall(evaluated(spark, d))


@query(
    "a15_coverage",
    sql(
        """select count(*) as eligible_rows, count(w.weather_hour) as covered_rows,
                  count(w.weather_hour) / count(*) as coverage
           from (select strftime(event_time, '%Y-%m-%dT%H') as weather_hour from trips) t
           left join (select * from weather where temperature_2m is not null and weather_code is not null) w
           using (weather_hour)""",
        "trips", "weather",
    ),
)
def a15(spark, d):
    return weather.coverage(with_hour_key(trips(spark, d)), fx.weather(spark, d))


RANKING = "select * from zone_means {} order by hotspot_score desc, pickup_zone limit 10"


@query("a16_zone_ranking", sql(RANKING.format(""), "zone_means"))
def a16(spark, d):
    return serving.zone_ranking(fx.predictions(spark, d))


@query("a16_ranking_of_one_zone", sql(RANKING.format("where pickup_zone = '7'"), "zone_means"))
def a16_zone(spark, d):
    return serving.zone_ranking(fx.predictions(spark, d), zone="7")


SERIES = """select * from (select event_time[1:13] as bucket, round(avg(hotspot_score), 6) as value from predictions {}
            group by all order by bucket desc limit 24) order by bucket"""


@query("a17_hourly_series", sql(SERIES.format(""), "predictions"))
def a17(spark, d):
    return rounded(serving.hourly_series(fx.predictions(spark, d)), ["value"])


@query("a17_series_of_one_zone", sql(SERIES.format("where pickup_zone = '7'"), "predictions"))
def a17_zone(spark, d):
    return rounded(serving.hourly_series(fx.predictions(spark, d), zone="7"), ["value"])


SUMMARY = """select count(*) as count, count(distinct pickup_zone) as zones, max(event_time) as latest from predictions"""


@query("a18_summary", sql(SUMMARY, "predictions"))
def a18(spark, d):
    return serving.summary(fx.predictions(spark, d))


@query("a18_summary_of_one_zone", sql(SUMMARY + " where pickup_zone = '7'", "predictions"))
def a18_zone(spark, d):
    return serving.summary(fx.predictions(spark, d), "7")


@query(
    "a19_zone_list",
    sql(
        """select pickup_zone, row_number() over (order by try_cast(pickup_zone as bigint) is null, try_cast(pickup_zone as bigint), pickup_zone) as position
           from (select distinct pickup_zone from predictions)""",
        "predictions",
    ),
)
def a19(spark, d):
    return in_place(serving.zone_list(fx.predictions(spark, d)))


@query(
    "a20_fleet_counters",
    sql(
        """select count(*) as total, count(*) filter (where status = 'available') as available,
                  count(*) filter (where status = 'occupied') as occupied, count(*) filter (where speed_kmh > 0) as moving
           from fleet""",
        "fleet",
    ),
)
def a20(spark, d):
    return fleet.fleet_counters(fleet.latest_state(fx.vehicles(spark, d)))


@query(
    "a21_profile",
    sql(
        """select count(*) as row_count, count(*) - count(event_id) as null_event_id,
                  count(*) - count(pickup_zone_name) as null_pickup_zone_name,
                  cast(min(pickup_datetime) as varchar) as pickup_min, cast(max(pickup_datetime) as varchar) as pickup_max,
                  count(distinct pickup_zone) as distinct_pickup_zone
           from curated""",
        "curated",
    ),
)
def a21(spark, d):
    curated = fx.curated_trips(spark, d)
    return verify.profile(curated, ["event_id", "pickup_zone_name"], "pickup_datetime", ["pickup_zone"])


@query(
    "a22_rows_per_year",
    "select cast(year(o_orderdate) as integer) as pickup_year, count(*) as row_count from orders group by all",
)
def a22(spark, d):
    return demand.rows_per_year(fx.table(spark, d, "orders"), "o_orderdate")


@query("a24_distinct_hours", "select distinct strftime(ts, '%Y-%m-%dT%H') as weather_hour from events")
def a24(spark, d):
    return demand.distinct_values(with_hour_key(fx.table(spark, d, "events"), "ts"), "weather_hour")


@query("a24_service_dates", sql("select distinct service_date from demand", "demand"))
def a24_dates(spark, d):
    return demand.distinct_values(fx.demand_trips(spark, d), "service_date")


@query(
    "a25_row_accounting",
    sql("select count(*) as input_rows, count(distinct (pickup_zone, pickup_hour)) as output_groups from trips", "trips"),
)
def a25(spark, d):
    return demand.row_accounting(demand.zone_hour_counts(trips(spark, d)))


@query(
    "w1_bucket_max",
    sql(
        """select *, max(trip_count) over (partition by service_date, pickup_hour, pickup_dow) as bucket_max from daily""",
        "daily",
    ),
)
def w1(spark, d):
    return score.bucket_max(demand.daily_demand(fx.demand_trips(spark, d)))


@query("w2_hotspot_score", sql("select * from scores", "scores"))
def w2(spark, d):
    return scores(spark, d)


@query(
    "w2_hotspot_score_of_events",
    sql(
        """with daily as (select cast(event_time as date) as service_date, pickup_zone, pickup_hour, pickup_dow,
                                 cast(count(*) as double) as trip_count from trips group by all)
           select d.*, round(trip_count / greatest(max(trip_count) over (
                      partition by service_date, pickup_hour, pickup_dow), 1.0) * 100.0, 2) as hotspot_score,
                  strftime(service_date, '%Y-%m-%d') || 'T' || lpad(cast(pickup_hour as varchar), 2, '0') as weather_hour
           from daily d""",
        "trips",
    ).replace("\nwith daily as", ",\ndaily as", 1),
)
def w2_events(spark, d):
    return score.daily_scores(trips(spark, d))


@query(
    "p19_temporal_split",
    sql("select side, service_date, count(*) as rows from scores join split using (service_date) group by all", "split"),
)
def p19(spark, d):
    split = score.temporal_split(scores(spark, d))
    sides = split.train.withColumn("side", F.lit("train")).unionByName(split.test.withColumn("side", F.lit("test")))
    return sides.groupBy("side", "service_date").agg(F.count("*").alias("rows"))


@query("o1_first_zone_hours", ZONE_HOURS + " order by pickup_zone, pickup_hour limit 50")
def o1(spark, d):
    return demand.first_zone_hours(trips(spark, d))


@query(
    "o2_top_n",
    "select l_orderkey, count(*) as lines from lineitem group by all order by lines desc, l_orderkey limit 20",
)
def o2(spark, d):
    lines = fx.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    return demand.top_n(lines, [F.desc("lines"), F.asc("l_orderkey")], 20)


def in_place(df):
    """The rows with their position in the order that the operator gives them; a few result rows only."""
    placed = df.withColumn("_at", F.monotonically_increasing_id())
    return placed.withColumn("position", F.row_number().over(Window.orderBy("_at")).cast("long")).drop("_at")


PLACED = "select *, row_number() over (order by {}) as position from ({})"


@query("o3_sorted_profile", sql(PLACED.format("pickup_borough, pickup_hour", PROFILE), "curated"))
def o3(spark, d):
    return in_place(demand.sorted_profile(fx.curated_trips(spark, d)))


@query("o4_top_zones", sql("select pickup_zone, hotspot_score from (" + RANKING.format("") + ")", "zone_means"))
def o4(spark, d):
    return serving.top_zones(fx.predictions(spark, d))


LATEST = "select * from predictions order by event_time desc, event_id limit {}"


@query("o5_latest_predictions", sql(LATEST.format(20), "predictions"))
def o5(spark, d):
    return serving.latest_predictions(fx.predictions(spark, d))


@query("o5_latest_predictions_clamped", sql(LATEST.format(100), "predictions"))
def o5_clamped(spark, d):
    return serving.latest_predictions(fx.predictions(spark, d), 5000)


@query(
    "o6_last_then_ascending",
    sql(PLACED.format("bucket", "select distinct event_time[1:13] as bucket from predictions order by bucket desc limit 24"), "predictions"),
)
def o6(spark, d):
    buckets = fx.predictions(spark, d).select(F.substring("event_time", 1, 13).alias("bucket")).distinct()
    return in_place(serving.last_then_asc(buckets, "bucket", 24))


@query(
    "o9_natural_order",
    """select v as value, row_number() over (order by try_cast(v as bigint) is null, try_cast(v as bigint), v) as position
       from (select distinct case when event_type = 'view' then event_type else cast(user_id as varchar) end as v from events)""",
)
def o9(spark, d):
    user = F.col("user_id").cast("string")
    mixed = F.when(F.col("event_type") == "view", F.col("event_type")).otherwise(user)
    values = fx.table(spark, d, "events").select(mixed.alias("value")).distinct()
    return in_place(serving.natural_order(values, "value"))


@query("o10_vehicles_by_id", sql(PLACED.format("vehicle_id", "select vehicle_id, status, updated_at from fleet"), "fleet"))
def o10(spark, d):
    return in_place(serving.fleet_order(fleet.latest_state(fx.vehicles(spark, d))).select("vehicle_id", "status", "updated_at"))


@query(
    "o10_available_newest_first",
    sql(PLACED.format("updated_at desc, vehicle_id", "select vehicle_id, pickup_zone, updated_at from fleet where status = 'available'"), "fleet"),
)
def o10_newest(spark, d):
    return in_place(serving.fleet_order(serving.available_vehicles(fleet.latest_state(fx.vehicles(spark, d))), "updated_at"))


@query("o11_latest_event_time", sql("select max(event_time) as latest from predictions", "predictions"))
def o11(spark, d):
    return serving.latest_event_time(fx.predictions(spark, d))


@query(
    "o12_numeric_order",
    sql(
        PLACED.format("cast(pickup_zone as integer), pickup_hour", "select pickup_zone, pickup_hour, count(*) as trip_count from trips group by all"),
        "trips",
    ),
)
def o12(spark, d):
    return in_place(demand.numeric_order(demand.zone_hour_counts(trips(spark, d)), ["pickup_zone", "pickup_hour"]))


@query(
    "d1_dispatch",
    sql(
        """select vehicle_id, from_zone, target_zone, round(hotspot_score, 2) as hotspot_score,
                  'Được xếp hạng theo score trung bình của replay' as reason
           from (select vehicle_id, pickup_zone as from_zone,
                        row_number() over (order by updated_at desc, vehicle_id) as i
                 from fleet where status = 'available')
           join (select pickup_zone as target_zone, hotspot_score,
                        row_number() over (order by hotspot_score desc, pickup_zone) as i from zone_means) using (i)
           where i <= 10""",
        "fleet", "zone_means",
    ),
)
def d1(spark, d):
    return serving.dispatch(fx.predictions(spark, d), fleet.latest_state(fx.vehicles(spark, d)))


@query(
    "d1_hotspot_summary",
    sql(
        f"""select pickup_zone as zone, round(hotspot_score, 2) as hotspot_score,
                   {level_sql("hotspot_score", "vi")} as hotspot_level, sample_count from ({RANKING.format("")})""",
        "zone_means",
    ),
)
def d1_summary(spark, d):
    return serving.hotspot_summary(fx.predictions(spark, d))


@query("d2_overview_summary", sql(SUMMARY, "predictions"))
def d2_summary(spark, d):
    return serving.overview(fx.predictions(spark, d))["summary"]


@query("d2_overview_ranking", sql("select pickup_zone, hotspot_score from (" + RANKING.format("") + ")", "zone_means"))
def d2_ranking(spark, d):
    return serving.overview(fx.predictions(spark, d))["ranking"]


@query("d2_overview_series", sql(SERIES.format(""), "predictions"))
def d2_series(spark, d):
    return rounded(serving.overview(fx.predictions(spark, d))["series"], ["value"])


@query("d2_overview_predictions", sql(LATEST.format(30), "predictions"))
def d2_predictions(spark, d):
    return serving.overview(fx.predictions(spark, d))["predictions"]


CANDIDATES = """select '{}' as candidate, hotspot_score as y, 0.8 * hotspot_score + case when pickup_hour % 2 = 0 then 25 else -15 end as p
                from scores
                union all
                select '{}', hotspot_score, 0.82 * hotspot_score + case when pickup_hour % 2 = 0 then 23 else -14 end from scores"""
WEATHER_BETTER, WEATHER_WORSE = CANDIDATES.format("calendar", "weather"), CANDIDATES.format("weather", "calendar")


def candidate_metrics(spark, d, worse="calendar", better="weather"):
    rows = scores(spark, d)
    tested = [
        rows.select(F.lit(name).alias("candidate"), "hotspot_score", guess(*figures).alias("predicted_hotspot_score"))
        for name, figures in ((worse, (0.8, 25, -15)), (better, (0.82, 23, -14)))
    ]
    return evaluation.holdout_metrics(tested[0].unionByName(tested[1]), by=["candidate"])


@query(
    "m6_holdout_metrics",
    sql(f"select *, {RATES} from (select candidate, {ERRORS}, {CONFUSION}, count(*) as rows from ({WEATHER_BETTER}) group by all)", "scores"),
)
def m6(spark, d):
    return rounded(candidate_metrics(spark, d), ["mae", "rmse", "r2"])


SELECTION = """select *, weather_rmse < calendar_rmse and weather_mae <= calendar_mae * 1.02 as weather_selected,
                   case when weather_rmse < calendar_rmse and weather_mae <= calendar_mae * 1.02 then 'weather' else 'calendar' end
                   as selected
            from (select round(max(rmse) filter (where candidate = 'calendar'), 6) as calendar_rmse,
                         round(max(mae) filter (where candidate = 'calendar'), 6) as calendar_mae,
                         round(max(rmse) filter (where candidate = 'weather'), 6) as weather_rmse,
                         round(max(mae) filter (where candidate = 'weather'), 6) as weather_mae
                  from (select candidate, avg(abs(y - p)) as mae, sqrt(avg((y - p) * (y - p))) as rmse
                        from ({}) group by candidate))"""


def selected(metrics):
    return rounded(evaluation.select_model(metrics), ["calendar_rmse", "calendar_mae", "weather_rmse", "weather_mae"])


@query("m7_select_model", sql(SELECTION.format(WEATHER_BETTER), "scores"))
def m7(spark, d):
    return selected(candidate_metrics(spark, d))


@query("m7_reject_model", sql(SELECTION.format(WEATHER_WORSE), "scores"))
def m7_reject(spark, d):
    return selected(candidate_metrics(spark, d, "weather", "calendar"))


HAVERSINE = """2 * 6371000.0 * atan2(
    sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))
         * pow(sin(radians({lon2} - {lon1}) / 2), 2)),
    sqrt(greatest(0, 1 - pow(sin(radians({lat2} - {lat1}) / 2), 2) - cos(radians({lat1})) * cos(radians({lat2}))
         * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""


@query(
    "g1_great_circle",
    sql(
        f"""select vehicle_id, simulation_cycle,
                   round({HAVERSINE.format(lon1="longitude", lat1="latitude", lon2="-73.96", lat2="40.73")}, 4) as metres
            from vehicles""",
        "vehicles",
    ),
)
def g1(spark, d):
    metres = great_circle_m(F.col("longitude"), F.col("latitude"), F.lit(-73.96), F.lit(40.73))
    return fx.vehicles(spark, d).select("vehicle_id", "simulation_cycle", F.round(metres, 4).alias("metres"))


@query(
    "g2_route_progress",
    f"""
    with points as (
        select vec_id, i, -74.0::double + cast(embedding[2 * i + 1] as double) / 10 as lon,
               40.7::double + cast(embedding[2 * i + 2] as double) / 10 as lat, len(embedding) // 2 as n
        from embeddings, range(1000) r(i) where i < len(embedding) // 2),
    segments as (
        select *, lead(lon) over w as lon2, lead(lat) over w as lat2 from points
        window w as (partition by vec_id order by i)),
    sums as (
        select vec_id, n, vec_id % 40 as seg, vec_id % 50 as done, vec_id % 60 as speed,
               sum({HAVERSINE.format(lon1="lon", lat1="lat", lon2="lon2", lat2="lat2")}) filter (where i >= vec_id % 40) as ahead,
               max(degrees(atan2(lon2 - lon, lat2 - lat))) filter (where i = vec_id % 40) as heading
        from segments group by all),
    state as (
        select *, case when seg >= n - 1 then 0.0 else ahead - done end as remaining_m from sums)
    select cast(vec_id as varchar) as vehicle_id, round(remaining_m, 4) as remaining_m,
           round(case when seg >= n - 1 then 100.0
                 else least(greatest((1 - remaining_m / greatest(400000.0 + vec_id, 1)) * 100, 0.0), 100.0) end, 4) as progress_pct,
           round(case when seg >= n - 1 then 0.0 else heading end, 4) as heading_degrees,
           round(remaining_m / 1000 / greatest(speed, 1) * 60, 4) as eta_minutes
    from state
    """,
)
def g2(spark, d):
    measures = ["remaining_m", "progress_pct", "heading_degrees", "eta_minutes"]
    return rounded(route_progress(fx.routes(spark, d)), measures, 4).select("vehicle_id", *measures)


@query(
    "t7_stamp_replay",
    sql(
        """
        select sha1(concat_ws('|', pickup_datetime, pickup_zone, dropoff_zone, cast(i as varchar))) as event_id,
               pickup_datetime, pickup_zone, dropoff_zone
        from (select *, strftime(timestamp '2024-06-01 08:00:00' + to_seconds(30 * i), '%Y-%m-%dT%H:%M:%S') as pickup_datetime
              from (select cast(PULocationID as varchar) as pickup_zone, cast(DOLocationID as varchar) as dropoff_zone,
                           row_number() over (order by tpep_pickup_datetime, event_id) - 1 as i from raw))""",
        "raw",
    ),
)
def t7(spark, d):
    raw = fx.raw_trips(spark, d).select(
        F.col("event_id").alias("row_id"), "tpep_pickup_datetime",
        F.col("PULocationID").alias("pickup_zone"), F.col("DOLocationID").alias("dropoff_zone"),
    )
    return stamp_replay(raw, [F.asc("tpep_pickup_datetime"), F.asc("row_id")], "2024-06-01 08:00:00")


@query(
    "t8_latest_vehicle_batch",
    sql("select vehicle_id, status, pickup_zone, speed_kmh, updated_at, simulation_cycle from fleet", "fleet"),
)
def t8(spark, d):
    return fleet.latest_state(fx.vehicles(spark, d)).select(
        "vehicle_id", "status", "pickup_zone", "speed_kmh", "updated_at", "simulation_cycle"
    )


def daily_parts(spark, d, part, rows, name):
    """Parts of the training dates, kept in two runs that overlap in some dates; the later run replaces them."""
    path, day = owned(spark).path(name), F.dayofyear("service_date")
    rows = owned(spark).store(rows, f"{name}-rows")
    for share in (day % 3 != 1, day % 3 != 2):
        mergeable.keep_daily(part(rows.filter(share)), path)
    return spark.read.parquet(path)


@query(
    "a8_row_counts",
    sql(
        """select (select count(*) from raw) as raw_rows, count(*) as before_enrichment, count(*) as after_enrichment,
                  (select count(*) from raw) - count(*) as dropped_rows, count(*) filter (where pickup_zone_name is null) as unmatched_pickup,
                  count(*) filter (where dropoff_zone_name is null) as unmatched_dropoff from curated""",
        "raw", "curated",
    ),
)
def a8(spark, d):
    """The figures that the ETL measures during its one write; it stops if enrichment changed the row count."""
    zones = owned(spark).store(fx.zones(spark, d), "zones")
    figures = run_etl(spark, fx.raw_trips(spark, d), zones, owned(spark).path("etl"))
    names = ["raw_rows", "before_enrichment", "after_enrichment", "dropped_rows", "unmatched_pickup", "unmatched_dropoff"]
    return spark.createDataFrame([tuple(figures[n] for n in names)], ", ".join(f"{n} long" for n in names))


@query("v3_report_plans", "select 'borough_hour_profile' as query, true as filter_reaches_scan, true as columns_pruned")
def v3(spark, d):
    """What the saved plan of a report says of its scan."""
    path = owned(spark).path("reports")
    curated = owned(spark).store(fx.curated_trips(spark, d), "curated")
    curated.write.parquet(f"{path}/curated")
    save_reports(spark, f"{path}/curated", f"{path}/out")
    plan = spark.read.json(f"{path}/out/borough_hour_profile/plan")
    return plan.select(
        "query",
        F.col("plan").contains("PushedFilters: [IsNotNull(pickup_borough)]").alias("filter_reaches_scan"),
        F.col("plan").contains("ReadSchema: struct<pickup_zone:string,pickup_hour:int,pickup_borough:string>").alias("columns_pruned"),
    )


@query(
    "a9_mergeable_moments",
    sql("select pickup_zone, pickup_hour, pickup_dow, mean, stddev, n as count from baseline", "baseline"),
)
def a9_moments(spark, d):
    train = score.temporal_split(scores(spark, d)).train
    return mergeable.merge_moments(daily_parts(spark, d, mergeable.daily_moments, train, "moments"))


@query("a10_merged_sketches", " union all ".join(f"select '{name}' as field, true as within" for name in MEDIAN_FIELDS))
def a10_sketches(spark, d):
    rows = weather.join_weather(score.temporal_split(scores(spark, d)).train, fx.demand_weather(spark, d))
    found = mergeable.merge_quantiles(daily_parts(spark, d, mergeable.daily_sketches, rows, "sketches"))
    return mergeable.rank_errors(rows, found).select("field", (F.col("rank_error") <= 0.01).alias("within"))


@query(
    "a11_merged_mode",
    sql(
        """select cast(cast(weather_code as integer) as varchar) as weather_code, count(*) as count
           from train join demand_weather using (weather_hour) group by all order by count desc, weather_code limit 1""",
        "train", "demand_weather",
    ),
)
def a11_merged(spark, d):
    rows = weather.join_weather(score.temporal_split(scores(spark, d)).train, fx.demand_weather(spark, d))
    return mergeable.merge_mode(daily_parts(spark, d, mergeable.daily_counts, rows, "codes"))
