"""The jobs as commands: `python -m tripspot.jobs <job> ...`; the master is taken from the Spark configuration."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspot.functions.records import parse_event
from tripspot.operators.demand import raw_zone_hours, rows_per_year, zone_hour_counts
from tripspot.operators.fleet import changed_between, fleet_counters
from tripspot.operators.forecast import forecast, next_hours, zone_map
from tripspot.operators.ml import load_model
from tripspot.operators.rows import checked_broadcast
from tripspot.operators.serving import (
    dispatch, fleet_order, hotspot_summary, latest_predictions, overview, zone_list, zone_ranking,
)
from tripspot.operators.verify import crosscheck_zone_hour, profile, run_checks
from tripspot.plans.etl import etl_job
from tripspot.plans.incremental import incremental_etl
from tripspot.plans.reports import save_reports
from tripspot.plans.training import load_fallback, training_job
from tripspot.operators.weather import hourly_side, weather_outlook
from tripspot.session import Scratch, build_session
from tripspot.sources.kafka import kafka_events
from tripspot.sources.sinks import is_done, write_report, write_zone_hour_csv, write_zone_hour_tsv
from tripspot.sources.trips import read_trips_any, read_zone_hour_tsv
from tripspot.sources.weather import read_weather_json
from tripspot.sources.zones import read_zone_lookup, zones_from_geojson
from tripspot.streaming.fleet import VEHICLE_SCHEMA, keep_state_with_changelog, latest_vehicle
from tripspot.streaming.ingest import parse_events
from tripspot.streaming.run import start_query
from tripspot.streaming.scoring import refreshed, scoring_sink
from tripspot.streaming.sink import compact, finished_numbers, latest_view, prediction_counters, retain, upsert_batch


def messages(spark: SparkSession, args) -> DataFrame:
    """The message stream: a topic, or a folder of text files with one message per line."""
    if args.servers:
        return kafka_events(spark, args.servers, args.topic, args.starting, args.max_messages)
    reader = spark.readStream
    if args.max_files:
        reader = reader.option("maxFilesPerTrigger", args.max_files)
    return reader.text(args.folder)


def zone_hours(spark, args):
    """Count trips per zone and hour twice, by rows and by key/value records, and stop if the counts differ."""
    if not args.force and is_done(spark, f"{args.out}/counts"):
        return
    trips = raw_zone_hours(read_trips_any(spark, args.parquet, args.csv))
    write_zone_hour_tsv(trips, f"{args.out}/records")
    write_zone_hour_csv(zone_hour_counts(trips), f"{args.out}/counts")
    if not crosscheck_zone_hour(trips, read_zone_hour_tsv(spark, f"{args.out}/records")).isEmpty():
        raise AssertionError("the two counts differ")


def etl(spark, args):
    """Raw trips to curated trips, once; with --state, load by load: files that are new since the last call."""
    if args.state:
        print(incremental_etl(spark, args.parquet, read_zone_lookup(spark, args.lookup), args.out, args.state))
        return
    print(etl_job(spark, args.parquet, args.csv, args.lookup, args.out, args.force))


def reports(spark, args):
    save_reports(spark, args.curated, args.out)


def profile_job(spark, args):
    trips = spark.read.parquet(args.curated)
    summary = profile(trips, ["event_id", "pickup_datetime", "pickup_zone"], "pickup_datetime", ["pickup_zone"])
    write_report(summary.withColumn("schema", F.lit(trips.schema.json())), f"{args.out}/summary")
    write_report(rows_per_year(trips), f"{args.out}/years")


def train(spark, args):
    if args.force or not is_done(spark, f"{args.out}/metrics"):
        chosen = {option: getattr(args, option) for option in GBT_OPTIONS if getattr(args, option) is not None}
        weather = read_weather_json(spark, *args.weather)
        training_job(spark.read.parquet(args.curated), weather, args.out, minimum_coverage=args.coverage, **chosen)


def score_stream(spark, args):
    with Scratch(spark, "score-stream") as scratch:
        sink = scoring_sink(
            upsert_batch(args.out, prediction_counters()),
            load_model(f"{args.artifacts}/model").transform,
            refreshed(lambda: hourly_side(scratch.store(read_weather_json(spark, *args.weather), "weather")), args.weather_ttl),
            load_fallback(spark, args.artifacts),
            checked_broadcast(spark.read.parquet(f"{args.artifacts}/baseline")),
        )
        run(parse_events(messages(spark, args)), sink, args, "append")


def track_fleet(spark, args):
    snapshots = messages(spark, args).select(F.inline(F.array(parse_event("value", VEHICLE_SCHEMA))))
    if args.late:
        keep_state_with_changelog(spark)
    run(latest_vehicle(snapshots, args.late), upsert_batch(args.out), args, "update")


def run(df, sink, args, output_mode):
    query = start_query(df, sink, args.checkpoint, args.trigger, args.once, output_mode, args.job)
    query.awaitTermination()


def compact_job(spark, args):
    """Write the current records of a store as a snapshot and remove what older snapshots and batches repeat."""
    key, order = STORES[args.store]
    compact(spark, args.out, args.until, key, order)
    retain(spark, args.out, args.keep, args.age)


def forecast_job(spark, args):
    """Scores of the next hours for the zones of the map; without a map, for the zones that the baseline has seen."""
    seen = spark.read.parquet(f"{args.artifacts}/baseline").select("pickup_zone").distinct()
    zones = zones_from_geojson(spark, args.geojson, seen) if args.geojson else seen
    model, baseline = load_model(f"{args.artifacts}/model"), spark.read.parquet(f"{args.artifacts}/baseline")
    weather, fallback = read_weather_json(spark, *args.weather), load_fallback(spark, args.artifacts)
    now = datetime.fromisoformat(args.now)
    scores = forecast(model, now, zones, weather, fallback, baseline, args.hours)
    write_report(scores, args.out)
    if args.map:
        first = spark.read.schema(scores.schema).json(args.out)
        write_report(zone_map(zones, first, next_hours(now, args.hours)[0].strftime("%Y-%m-%dT%H")), args.map)
    if args.outlook:
        write_report(weather_outlook(now, weather, fallback), args.outlook)


def before_last(spark, path, now):
    """The vehicles before the last batch of their store, or as they are where there is no earlier batch."""
    batches = finished_numbers(spark, f"{path}/batches", "batch_id")
    try:
        return latest_view(spark, path, *STORES["vehicles"], until=batches[-1] - 1)
    except (FileNotFoundError, IndexError):
        return now


def dashboard(spark, args):
    """What the dashboard shows: overview, dispatch, fleet, its counters and the run's checks."""
    with Scratch(spark, "dashboard") as scratch:
        predictions = scratch.store(latest_view(spark, args.predictions), "predictions")
        vehicles = scratch.store(latest_view(spark, args.vehicles, *STORES["vehicles"]), "vehicles")
        earlier = scratch.store(before_last(spark, args.vehicles, vehicles), "earlier")
        results = overview(predictions, args.zone)
        results |= {
            "hotspots": hotspot_summary(predictions),
            "dispatch": dispatch(predictions, vehicles),
            "zones": zone_list(predictions),
            "fleet": fleet_order(vehicles),
            "fleet_counters": fleet_counters(vehicles),
            "checks": run_checks(predictions, zone_ranking(predictions), vehicles, changed_between(earlier, vehicles), args.vehicle_count),
            "latest": latest_predictions(predictions, args.limit),
        }
        for name, result in results.items():
            write_report(result, f"{args.out}/{name}")


# Key of each kind of store, and what makes one of its records newer than another.
STORES = {"predictions": ("event_id", ("batch_id", "event_time")), "vehicles": ("vehicle_id", ("updated_at", "simulation_cycle"))}
GBT_OPTIONS = {"maxIter": int, "maxDepth": int, "stepSize": float, "maxBins": int}
JOBS = {
    "zone-hours": (zone_hours, ["parquet", "csv", "out"]),
    "etl": (etl, ["parquet", "csv", "lookup", "out"]),
    "reports": (reports, ["curated", "out"]),
    "profile": (profile_job, ["curated", "out"]),
    "train": (train, ["curated", "out"]),
    "score-stream": (score_stream, ["artifacts", "checkpoint", "out"]),
    "track-fleet": (track_fleet, ["checkpoint", "out"]),
    "compact": (compact_job, ["out"]),
    "forecast": (forecast_job, ["artifacts", "now", "out"]),
    "dashboard": (dashboard, ["predictions", "vehicles", "out"]),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tripspot")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, (function, required) in JOBS.items():
        job = jobs.add_parser(name, help=function.__doc__)
        for option in required:
            job.add_argument(f"--{option}", required=True)
        job.add_argument("--force", action="store_true")
        if name in ("train", "score-stream", "forecast"):
            job.add_argument("--weather", nargs="+", required=True)
        if name in ("score-stream", "track-fleet"):
            job.add_argument("--servers")
            job.add_argument("--topic")
            job.add_argument("--folder")
            job.add_argument("--starting", default="latest" if name == "score-stream" else "earliest")
            job.add_argument("--trigger", default="2 seconds")
            job.add_argument("--once", action="store_true", help="stop after the data at hand")
            job.add_argument("--max-messages", type=int, help="messages of the topic in a batch at most")
            job.add_argument("--max-files", type=int, help="files of the folder in a batch at most")
        if name == "track-fleet":
            job.add_argument("--late", help="interval after which silent vehicles leave the state, and late snapshots are dropped")
        if name == "score-stream":
            job.add_argument("--weather-ttl", type=float, default=1800.0, help="seconds after which forecasts are read again")
        if name == "etl":
            job.add_argument("--state", help="folder for what loads have read and numbered")
        if name == "compact":
            job.add_argument("--store", choices=list(STORES), default="predictions")
            job.add_argument("--until", type=int, help="last batch of the snapshot; the last but one by default")
            job.add_argument("--keep", type=int, default=2, help="snapshots to keep")
            job.add_argument("--age", type=int, default=3600, help="seconds for which readers of older files are waited for")
        if name == "train":
            job.add_argument("--coverage", type=float, default=0.95)
            for option, kind in GBT_OPTIONS.items():
                job.add_argument(f"--{option}", type=kind)
        if name == "forecast":
            job.add_argument("--hours", type=int, default=3)
            job.add_argument("--geojson", help="zones of the map")
            job.add_argument("--map", help="folder for every zone with its class at the first hour")
            job.add_argument("--outlook", help="folder for the weather of the next hours")
        if name == "dashboard":
            job.add_argument("--zone")
            job.add_argument("--limit", type=int, default=20, help="latest predictions, 100 at most")
            job.add_argument("--vehicle-count", type=int, default=40, help="vehicles that the checks ask for")
    return top


def main(argv=None, spark=None):
    args = parser().parse_args(argv)
    JOBS[args.job][0](spark or build_session(f"tripspot-{args.job}"), args)


if __name__ == "__main__":
    main()
