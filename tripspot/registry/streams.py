"""Streaming queries, run over the data at hand and read back from their store."""

from pyspark.sql import functions as F

from tripspot import fixtures as fx
from tripspot.registry.base import level_sql, owned, query, sql
from tripspot.registry.joins import FALLBACK, FILLED, GAP, LIMITS, scores, stored_baseline, stored_weather
from tripspot.registry.models import trained
from tripspot.streaming.fleet import latest_vehicle
from tripspot.streaming.ingest import parse_events
from tripspot.streaming.rollup import compact_rollups, newest_records, ranking_of, rollup, rollup_sink, series_of, summary_of
from tripspot.streaming.run import start_query
from tripspot.streaming.scoring import score_stream
from tripspot.streaming.sink import batch_counters, compact, latest_view, prediction_counters, retain, upsert_batch


def run_all(spark, df, name, counters=None, output_mode="append"):
    """Run a stream over the data at hand; returns the folder of its store."""
    path = owned(spark).path(name)
    sink = upsert_batch(path, counters)
    stream = start_query(df, sink, f"{path}/checkpoint", available_now=True, output_mode=output_mode)
    stream.awaitTermination()
    return path


INGESTED = """select p.*, cast(replace(p.event_time, 'T', ' ') as timestamp) as at_time
              from predictions p join events e on p.event_id = cast(e.event_id as varchar) where event_type <> 'error'"""


@query(
    "t1_stream_ingest",
    sql(
        f"""select event_id, event_time as pickup_datetime, pickup_zone, dropoff_zone, at_time as event_time, pickup_hour,
                   pickup_dow from ({INGESTED})""",
        "predictions",
    ),
)
def t1(spark, d):
    path = run_all(spark, parse_events(fx.messages(spark, d, streaming=True)), "ingest")
    return latest_view(spark, path).drop("batch_id")


def by_formula(df):
    """A prediction given by a formula: it leaves 0..100 on both sides."""
    return df.withColumn("predicted_hotspot_score", F.col("event_id").cast("long") * 37 % 1000 / 10.0 * 1.2 - 10)


SCORED = f"""
    select *, case when hotspot_score > t then 'CRITICAL_ANOMALY' else 'NORMAL' end as alert_flag
    from (select i.event_id, event_time, i.pickup_zone, dropoff_zone, i.pickup_hour, i.pickup_dow, {FILLED},
                 case when {GAP} then 1.0 else 0.0 end::double as weather_missing,
                 least(greatest(hotspot_score * 1.2 - 10, 0.0), 100.0) as hotspot_score,
                 case when {GAP} then 'historical_fallback' else 'Open-Meteo forecast' end as weather_source,
                 cast(coalesce(n, 0) as integer) as historical_baseline_samples,
                 case when n >= 5 then least(100.0, round(mean + 3 * stddev, 9)) else 100.0 end as t, n, mean, stddev
          from (select *, strftime(at_time, '%Y-%m-%dT%H') as weather_hour from ({INGESTED})) i
          left join weather using (weather_hour) left join baseline b using (pickup_zone, pickup_hour, pickup_dow))"""


@query(
    "t2_stream_scoring",
    sql(
        f"""select * exclude (t, n, mean, stddev) replace (round(hotspot_score, 6) as hotspot_score),
                   {level_sql("hotspot_score", "vi")} as hotspot_level, {LIMITS.format(sparse="100.0")}
            from ({SCORED})""",
        "predictions", "weather", "baseline",
    ),
)
def t2(spark, d):
    events = parse_events(fx.messages(spark, d, streaming=True))
    scored = score_stream(events, by_formula, stored_weather(spark, d), FALLBACK, stored_baseline(spark, d))
    path = run_all(spark, scored, "scores")
    return latest_view(spark, path).drop("batch_id").withColumn("hotspot_score", F.round("hotspot_score", 6))


@query(
    "t2_stream_scoring_with_model",
    sql(f"select count(*) as rows, count(distinct event_id) as ids, 0::bigint as outside, 0::bigint as wrong_flags from ({INGESTED})", "predictions"),
)
def t2_model(spark, d):
    run = trained(spark, d)
    events = parse_events(fx.messages(spark, d, streaming=True))
    predict = run.model.transform
    scored = score_stream(events, predict, stored_weather(spark, d), run.fallback, stored_baseline(spark, d))
    view = latest_view(spark, run_all(spark, scored, "model-scores"))
    flagged = F.col("alert_flag") == "CRITICAL_ANOMALY"
    return view.agg(
        F.count("*").alias("rows"),
        F.count_distinct("event_id").alias("ids"),
        F.count_if(~F.col("hotspot_score").between(0, 100)).alias("outside"),
        F.count_if(flagged & (F.col("hotspot_score") <= F.col("anomaly_threshold") - 0.01)).alias("wrong_flags"),
    )


@query(
    "a23_batch_counters",
    sql(
        f"""select count(*) as records, count(*) filter (where alert_flag = 'CRITICAL_ANOMALY') as alerts,
                   count(*) filter (where weather_missing > 0) as weather_missing_rows from ({SCORED})""",
        "predictions", "weather", "baseline",
    ),
)
def a23(spark, d):
    events = parse_events(fx.messages(spark, d, streaming=True))
    scored = score_stream(events, by_formula, stored_weather(spark, d), FALLBACK, stored_baseline(spark, d))
    path = run_all(spark, scored, "counted", prediction_counters())
    names = ("records", "alerts", "weather_missing_rows")
    return batch_counters(spark, path).agg(*[F.sum(name).alias(name) for name in names])


@query(
    "t4_triggered_batches",
    sql(f"select count(*) as records, 3::bigint as batches from ({INGESTED})", "predictions"),
)
def t4(spark, d):
    # Three files, one to a batch, by a processing-time trigger; the query is stopped when all are read.
    folder, path = owned(spark).path("messages"), owned(spark).path("triggered")
    fx.messages(spark, d).repartition(3).write.text(folder)
    source = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    stream = start_query(parse_events(source), upsert_batch(path), f"{path}/checkpoint", trigger="100 milliseconds")
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return latest_view(spark, path).agg(F.count("*").alias("records"), F.count_distinct("batch_id").alias("batches"))


@query(
    "t6_replayed_upsert",
    sql("select event_id, event_time, hotspot_score + 1 as hotspot_score, 1::bigint as batch_id from predictions", "predictions"),
)
def t6(spark, d):
    # Batch 0 is written twice, as after a failure; batch 1 replaces every record.
    path = owned(spark).path("upsert")
    write = upsert_batch(path)
    first = fx.predictions(spark, d).select("event_id", "event_time", "hotspot_score")
    write(first, 0)
    write(first, 0)
    write(first.withColumn("hotspot_score", F.col("hotspot_score") + 1), 1)
    return latest_view(spark, path)


ROUNDS = 3


def stored_rounds(spark, d):
    """A store of three batches; each record is in batches 0 .. i, the last of which raises its score by i."""
    path = owned(spark).path("rounds")
    write, rows = upsert_batch(path), fx.predictions(spark, d).select("event_id", "event_time", "hotspot_score")
    for i in range(ROUNDS):
        part = rows.filter(F.col("event_id").cast("long") % ROUNDS >= i)
        write(part.withColumn("hotspot_score", F.col("hotspot_score") + i), i)
        if i:
            compact(spark, path, i - 1)
    return path


ROUND = "cast(event_id as bigint) % 3"


@query(
    "t6_view_until",
    sql(
        f"""select event_id, event_time, hotspot_score + least({ROUND}, 1) as hotspot_score, least({ROUND}, 1) as batch_id
            from predictions""",
        "predictions",
    ),
)
def t6_until(spark, d):
    path = stored_rounds(spark, d)
    compact(spark, path, ROUNDS - 1)
    return latest_view(spark, path, until=1)


@query(
    "t6_compacted_view",
    sql(f"select event_id, event_time, hotspot_score + {ROUND} as hotspot_score, {ROUND} as batch_id from predictions", "predictions"),
)
def t6_compacted(spark, d):
    path = stored_rounds(spark, d)
    compact(spark, path)
    retain(spark, path, 1)
    return latest_view(spark, path)


@query(
    "t6_bucketed_view",
    sql(f"select event_id, event_time, hotspot_score + {ROUND} as hotspot_score, {ROUND} as batch_id from predictions", "predictions"),
)
def t6_bucketed(spark, d):
    # Snapshots up to batches 0 and 1, the second of which touches all slices; batch 2 is joined to its buckets.
    return latest_view(spark, stored_rounds(spark, d))


def rolled_up(spark, d):
    """A store with rollups: three batches, each of which replaces records of the one before with another score, zone
    and time; the second is written twice, and store and rollups are compacted on the way."""
    path = owned(spark).path("rollups")
    store, rows = rollup_sink(path), fx.predictions(spark, d).select("event_id", "event_time", "pickup_zone", "hotspot_score")
    number = F.col("event_id").cast("long")
    for i in range(ROUNDS):
        part = rows.filter(number % ROUNDS >= i).withColumns({
            "hotspot_score": F.col("hotspot_score") + i,
            "pickup_zone": F.when(number % 2 == 0, F.col("pickup_zone")).otherwise((F.col("pickup_zone").cast("int") + i).cast("string")),
            "event_time": F.when(number % 5 == 0, F.concat(F.lit("2023"), F.substring("event_time", 5, 20))).otherwise(F.col("event_time")),
        })
        for _ in range(2 if i == 1 else 1):
            store(part if i else part.withColumn("event_time", F.lit("2099-01-01T00:00:00")), i)
        if i:
            compact(spark, path, i - 1)
            compact_rollups(spark, path)
    return path


ROLLED = f"""(select event_id, r, hotspot_score + r as hotspot_score,
                    case when i % 2 = 0 then pickup_zone else cast(cast(pickup_zone as integer) + r as varchar) end as pickup_zone,
                    case when r = 0 then '2099-01-01T00:00:00' when i % 5 = 0 then '2023' || event_time[5:] else event_time end as event_time
             from (select *, {ROUND} as r, cast(event_id as bigint) as i from predictions))"""


@query(
    "a16_rollup_ranking",
    sql(
        f"""select pickup_zone, round(sum(cast(hotspot_score as decimal(30, 12)))::double / count(*), 9) as hotspot_score, count(*) as sample_count
            from {ROLLED} group by pickup_zone order by hotspot_score desc, pickup_zone limit 10""",
        "predictions",
    ),
)
def a16_rollup(spark, d):
    return ranking_of(rollup(spark, rolled_up(spark, d), "hours"))


@query(
    "a17_rollup_series",
    sql(
        f"""select event_time[1:13] as bucket, round(avg(hotspot_score), 9) as value from {ROLLED} group by bucket
            order by bucket desc limit 24""",
        "predictions",
    ),
)
def a17_rollup(spark, d):
    return series_of(rollup(spark, rolled_up(spark, d), "hours")).withColumn("value", F.round("value", 9))


@query(
    "a18_rollup_summary",
    sql(f"select count(*) as count, count(distinct pickup_zone) as zones, max(event_time) as latest from {ROLLED} where pickup_zone = '7'", "predictions"),
)
def a18_rollup(spark, d):
    return summary_of(spark, rolled_up(spark, d), "7")


@query(
    "d2_newest_records",
    sql(f"select event_id, event_time, pickup_zone, hotspot_score, r as batch_id from {ROLLED} order by event_time desc, event_id limit 30", "predictions"),
)
def d2_newest(spark, d):
    return newest_records(spark, rolled_up(spark, d), 30)


@query(
    "t8_stream_latest_vehicle",
    sql("select * from fleet", "fleet"),
)
def t8(spark, d):
    # Several files, one to a batch.
    folder = owned(spark).path("snapshots")
    fx.table(spark, d, "events").repartition(3, "event_id").write.parquet(folder)
    snapshots = spark.readStream.schema(fx.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    path = run_all(spark, latest_vehicle(fx.vehicles_of(snapshots)), "fleet", output_mode="update")
    return latest_view(spark, path, "vehicle_id", ("updated_at", "simulation_cycle")).drop("batch_id")


@query("t8_evicting_stream", sql("select * from fleet", "fleet"))
def t8_evicting(spark, d):
    # Files in the order of time, one to a batch; hours that the watermark has passed leave the state.
    folder = owned(spark).path("ordered")
    fx.table(spark, d, "events").repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(folder)
    snapshots = spark.readStream.schema(fx.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    path = run_all(spark, latest_vehicle(fx.vehicles_of(snapshots), late="40 days"), "evicting", output_mode="update")
    return latest_view(spark, path, "vehicle_id", ("updated_at", "simulation_cycle")).drop("batch_id")
