"""Features, models and forecast."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tripspot import fixtures as fx
from tripspot.operators import ml
from tripspot.operators.forecast import forecast
from tripspot.operators.score import temporal_split
from tripspot.operators.weather import join_weather
from tripspot.plans.training import train
from tripspot.registry.base import label_sql, level_sql, owned, query, sql
from tripspot.registry.joins import FALLBACK, FILLED, GAP, LIMITS, NOW, scores, stored_baseline, stored_weather

_TRAINED: dict = {}


def trained(spark, d):
    """The training run on the demand trips, once per session and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _TRAINED:
        _TRAINED[key] = train(fx.demand_trips(spark, d), fx.demand_weather(spark, d))
    return _TRAINED[key]


def weather_scores(spark, d):
    return join_weather(scores(spark, d), fx.demand_weather(spark, d))


def features(rows, use_weather):
    """The rows with their feature stages applied."""
    for stage in ml.indexers(use_weather):
        rows = stage.fit(rows).transform(rows)
    return ml.assembler(use_weather).transform(ml.encoder(use_weather).fit(rows).transform(rows))


INDEX = """select {0}, cast(row_number() over (order by count(*) desc, {0}) - 1 as double) as {1} from {2} group by {0}"""
ZONE_INDEX = INDEX.format("pickup_zone", "zone_index", "scores")
CODED = """select s.*, cast(cast(weather_code as integer) as varchar) as weather_code
           from scores s join demand_weather using (weather_hour)"""
CODE_INDEX = INDEX.format("weather_code", "weather_code_index", f"({CODED})")


@query("m1_zone_index", sql(ZONE_INDEX, "scores"))
def m1(spark, d):
    rows = scores(spark, d)
    (indexer,) = ml.indexers()
    return indexer.fit(rows).transform(rows).select("pickup_zone", "zone_index").distinct()


@query("m1_weather_code_index", sql(CODE_INDEX, "scores", "demand_weather"))
def m1_codes(spark, d):
    rows = weather_scores(spark, d)
    indexer = ml.indexers(use_weather=True)[1]
    return indexer.fit(rows).transform(rows).select("weather_code", "weather_code_index").distinct()


@query(
    "m2_one_hot_zone",
    sql(
        f"""select pickup_zone, cast(zone_index as integer) as hot_position, 1.0::double as total,
                   cast(count(*) over () + 1 as integer) as width from ({ZONE_INDEX})""",
        "scores",
    ),
)
def m2(spark, d):
    vector = vector_to_array("zone_vector")
    encoded = features(scores(spark, d), False).select("pickup_zone", vector.alias("v")).distinct()
    return encoded.select(
        "pickup_zone",
        (F.array_position("v", 1.0) - 1).cast("int").alias("hot_position"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"),
        F.size("v").alias("width"),
    )


@query(
    "m3_calendar_features",
    sql(
        f"""select service_date, pickup_zone, cast(pickup_hour as double) as first, cast(pickup_dow as double) as second,
                   cast(zone_index as integer) + 3 as hot_position, cast(zones as integer) + 3 as width
            from scores join ({ZONE_INDEX}) using (pickup_zone), (select count(distinct pickup_zone) as zones from scores)""",
        "scores",
    ),
)
def m3(spark, d):
    rows = features(scores(spark, d), False).withColumn("f", vector_to_array("features"))
    zone = F.slice("f", 3, F.size("f"))
    return rows.select(
        "service_date",
        "pickup_zone",
        F.get("f", F.lit(0)).alias("first"),
        F.get("f", F.lit(1)).alias("second"),
        (F.array_position(zone, 1.0) + 2).cast("int").alias("hot_position"),
        F.size("f").alias("width"),
    )


@query(
    "m3_weather_features",
    sql(
        f"""select service_date, pickup_zone, pickup_hour, temperature_2m, precipitation, snowfall, wind_speed_10m,
                   relative_humidity_2m, cast(zone_index as integer) as zone_position,
                   cast(weather_code_index as integer) as code_position,
                   cast(9 + zones + codes as integer) as width
            from (select s.*, w.* exclude (weather_hour, weather_code),
                         cast(cast(weather_code as integer) as varchar) as weather_code
                  from scores s join demand_weather w using (weather_hour))
            join ({ZONE_INDEX}) using (pickup_zone) join ({CODE_INDEX}) using (weather_code),
            (select count(distinct pickup_zone) as zones from scores), (select count(*) as codes from ({CODE_INDEX}))""",
        "scores", "demand_weather",
    ),
)
def m3_weather(spark, d):
    rows = features(weather_scores(spark, d), True).withColumn("f", vector_to_array("features"))
    names = ("temperature_2m", "precipitation", "snowfall", "wind_speed_10m", "relative_humidity_2m")
    zone, code = vector_to_array("zone_vector"), vector_to_array("weather_vector")
    return rows.select(
        "service_date",
        "pickup_zone",
        F.get("f", F.lit(0)).cast("int").alias("pickup_hour"),
        *[F.get("f", F.lit(i + 2)).alias(name) for i, name in enumerate(names)],
        (F.array_position(zone, 1.0) - 1).cast("int").alias("zone_position"),
        (F.array_position(code, 1.0) - 1).cast("int").alias("code_position"),
        F.size("f").alias("width"),
    )


@query(
    "m4_m5_holdout_predictions",
    sql("select count(*) as rows, 0::bigint as not_finite, true as better_than_mean from test join demand_weather using (weather_hour)",
        "test", "demand_weather"),
)
def m5(spark, d):
    test = temporal_split(weather_scores(spark, d)).test
    split = temporal_split(weather_scores(spark, d))
    mean = split.train.agg(F.avg("hotspot_score")).first()[0]
    predicted = trained(spark, d).models["calendar"].transform(test)
    value = F.col("predicted_hotspot_score")
    return predicted.agg(
        F.count("*").alias("rows"),
        F.count_if(value.isNull() | F.isnan(value)).alias("not_finite"),
        (F.avg(F.abs(value - F.col("hotspot_score"))) < F.avg(F.abs(F.col("hotspot_score") - mean))).alias("better_than_mean"),
    )


@query(
    "m6_model_evaluation",
    sql("""select count(*) as rows, count(*) filter (where hotspot_score >= 50) as hot_rows, true as errors_in_order
           from test join demand_weather using (weather_hour)""", "test", "demand_weather"),
)
def m6(spark, d):
    measured = ml.evaluate(trained(spark, d).model, temporal_split(weather_scores(spark, d)).test)
    hot = F.col("true_positive") + F.col("false_negative")
    return measured.select("rows", hot.alias("hot_rows"), (F.col("mae") <= F.col("rmse")).alias("errors_in_order"))


REPORTED = [
    "train_start_date", "train_end_date", "test_start_date", "test_end_date", "training_days", "evaluation_days",
    "training_rows", "evaluation_rows", "eligible_rows", "weather_coverage_rows", "weather_coverage", "baseline_min_support",
    "baseline_sigma", "baseline_keys",
]


@query(
    "m8_metrics_report",
    sql(
        """select strftime(min(service_date) filter (where side = 'train'), '%Y-%m-%d') as train_start_date,
                  strftime(max(service_date) filter (where side = 'train'), '%Y-%m-%d') as train_end_date,
                  strftime(min(service_date) filter (where side = 'test'), '%Y-%m-%d') as test_start_date,
                  strftime(max(service_date) filter (where side = 'test'), '%Y-%m-%d') as test_end_date,
                  count(distinct service_date) filter (where side = 'train') as training_days,
                  count(distinct service_date) filter (where side = 'test') as evaluation_days,
                  count(*) filter (where side = 'train') as training_rows,
                  count(*) filter (where side = 'test') as evaluation_rows,
                  count(*) as eligible_rows, count(*) as weather_coverage_rows, 1.0::double as weather_coverage,
                  5::bigint as baseline_min_support, 3.0::double as baseline_sigma,
                  'pickup_zone,pickup_hour,pickup_dow' as baseline_keys
           from scores join split using (service_date)""",
        "scores", "split",
    ),
)
def m8(spark, d):
    return trained(spark, d).report.select(*REPORTED)


FORECAST_HOURS = """(select timestamp '2024-01-15 10:00:00' + to_hours(cast(i as integer)) as t from range(3) r(i))"""


@query(
    "m9_hourly_forecast",
    sql("select count(*) * 3 as rows, count(*) * 3 as ranked, 0::bigint as outside from (select distinct pickup_zone from scores)", "scores"),
)
def m9(spark, d):
    run = trained(spark, d)
    zones = scores(spark, d).select("pickup_zone").distinct()
    rows = forecast(run.model, NOW, zones, fx.weather(spark, d), run.fallback, run.baseline)
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_distinct("weather_hour", "rank").alias("ranked"),
        F.count_if(~F.col("hotspot_score").between(0, 100)).alias("outside"),
    )


class Formula:
    """Stands in for a model: a prediction that zone, hour and weather give, so that SQL can follow it."""

    def transform(self, df):
        zone = F.coalesce(F.col("pickup_zone").try_cast("double"), F.lit(0.0))
        return df.withColumn("predicted_hotspot_score", zone * 5 + F.col("pickup_hour") * 2 + F.col("temperature_2m") * 4 - 30)


@query(
    "m9_formula_forecast",
    sql(
        f"""select weather_hour, pickup_hour, pickup_dow, cast(row_number() over (
                       partition by weather_hour order by round(s, 2) desc, pickup_zone) as integer) as rank, pickup_zone,
                   round(s, 2) as hotspot_score, {level_sql("s", "vi")} as hotspot_level,
                   case when s > t then 'CRITICAL_ANOMALY' else 'NORMAL' end as alert_flag,
                   {LIMITS.format(sparse="0.0")}, cast(coalesce(n, 0) as integer) as historical_baseline_samples,
                   weather_missing, {label_sql("cast(weather_code as double)")} as weather_description
            from (select *, case when n >= 5 then least(100.0, round(mean + 3 * stddev, 9)) else 100.0 end as t,
                         least(greatest(cast(pickup_zone as double) * 5 + pickup_hour * 2 + temperature_2m * 4 - 30, 0.0), 100.0) as s
                  from (select z.pickup_zone, strftime(t, '%Y-%m-%dT%H') as weather_hour, cast(hour(t) as integer) as pickup_hour,
                               cast(dayofweek(t) as integer) as pickup_dow, n, mean, stddev, {FILLED},
                               case when {GAP} then 1.0 else 0.0 end::double as weather_missing
                        from (select distinct pickup_zone from scores) z, {FORECAST_HOURS}
                        left join weather w on w.weather_hour = strftime(t, '%Y-%m-%dT%H')
                        left join baseline b on b.pickup_zone = z.pickup_zone and b.pickup_hour = hour(t) and b.pickup_dow = dayofweek(t)))""",
        "scores", "weather", "baseline",
    ),
)
def m9_formula(spark, d):
    zones = scores(spark, d).select("pickup_zone").distinct()
    return forecast(Formula(), NOW, zones, stored_weather(spark, d), FALLBACK, stored_baseline(spark, d))


@query(
    "s15_model_saved_and_loaded",
    sql("select count(*) as rows, 0::bigint as different from test", "test"),
)
def s15(spark, d):
    run, path = trained(spark, d), owned(spark).path("model")
    ml.save_model(run.model, path)
    test = temporal_split(weather_scores(spark, d)).test
    again = run.model.transform(test).withColumnRenamed("predicted_hotspot_score", "before")
    kept = [c for c in again.columns if c in test.columns] + ["before"]
    loaded = ml.load_model(path).transform(again.select(*kept))
    changed = F.abs(F.col("before") - F.col("predicted_hotspot_score")) > 1e-9
    return loaded.agg(F.count("*").alias("rows"), F.count_if(changed).alias("different"))
