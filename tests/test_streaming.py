"""Streaming jobs on files: bad messages, replays, restarts, late and repeated records, batch twins."""

import json
import re

import pytest
from pyspark.sql import functions as F

from tripspot import fixtures as fx
from tripspot.operators.fleet import latest_state
from tripspot.operators.verify import same_rows
from tripspot.plans.reports import formatted_plan
from tripspot.streaming.fleet import CHANGELOG_STATE, VEHICLE_SCHEMA, keep_state_with_changelog, latest_vehicle
from tripspot.streaming.ingest import parse_events
from tripspot.streaming.run import start_query
from tripspot.streaming.scoring import refreshed, score_stream
from tripspot.streaming.sink import batch_counters, compact, latest_view, prediction_counters, retain, upsert_batch


def event(i, time="2024-05-01T08:00:00", zone="4", **more):
    return json.dumps({"event_id": i, "pickup_datetime": time, "pickup_zone": zone, "dropoff_zone": "5", **more})


def lines(folder, name, texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def run(df, path, output_mode="append", counters=None):
    sink = upsert_batch(str(path), counters)
    query = start_query(df, sink, str(path / "checkpoint"), available_now=True, output_mode=output_mode)
    query.awaitTermination()
    return query


def text_stream(spark, folder, per_trigger=1):
    return spark.readStream.option("maxFilesPerTrigger", per_trigger).text(str(folder))


def test_bad_messages_are_dropped(spark, tmp_path):
    lines(tmp_path / "in", "a.txt", [event("1"), "{broken", "", event("2", "soon"), event(None), event("3", zone=None), event("4", extra=1)])
    run(parse_events(text_stream(spark, tmp_path / "in")), tmp_path / "out")
    rows = latest_view(spark, str(tmp_path / "out")).orderBy("event_id").collect()
    assert [(r.event_id, r.pickup_hour, r.pickup_dow) for r in rows] == [("1", 8, 3), ("4", 8, 3)]


def test_restart_continues_and_later_batches_win(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    lines(source, "a.txt", [event("1"), event("2")])
    run(parse_events(text_stream(spark, source)), out)
    lines(source, "b.txt", [event("2", "2024-05-01T09:00:00"), event("3")])
    run(parse_events(text_stream(spark, source)), out)
    run(parse_events(text_stream(spark, source)), out)
    rows = {r.event_id: (r.pickup_hour, r.batch_id) for r in latest_view(spark, str(out)).collect()}
    assert rows == {"1": (8, 0), "2": (9, 1), "3": (8, 1)}


def test_empty_batches_write_nothing(spark, tmp_path):
    lines(tmp_path / "in", "a.txt", ["{broken"])
    run(parse_events(text_stream(spark, tmp_path / "in")), tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        latest_view(spark, str(tmp_path / "out"))


def test_repeated_batch_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("1", "t1", 5.0), ("2", "t1", 6.0)], "event_id string, event_time string, s double")
    write = upsert_batch(str(tmp_path))
    write(rows, 0)
    before = latest_view(spark, str(tmp_path)).collect()
    write(rows, 0)
    assert sorted(latest_view(spark, str(tmp_path)).collect()) == sorted(before)


def test_repeats_inside_a_batch(spark, tmp_path):
    rows = spark.createDataFrame([("1", "t2", 5.0), ("1", "t3", 6.0), ("1", "t1", 7.0)], "event_id string, event_time string, s double")
    upsert_batch(str(tmp_path))(rows, 4)
    assert [tuple(r) for r in latest_view(spark, str(tmp_path)).collect()] == [("1", "t3", 6.0, 4)]


def test_compaction_keeps_the_view(spark, tmp_path):
    write, path = upsert_batch(str(tmp_path)), str(tmp_path)

    def batch(i):
        return spark.range(i, i + 5).select(F.col("id").cast("string").alias("event_id"), F.lit("t").alias("event_time"), F.lit(float(i)).alias("s"))

    for i in range(4):
        write(batch(i), i)
    before = latest_view(spark, path)
    compact(spark, path, until=2)
    after = latest_view(spark, path)
    assert same_rows(before, after) and after.count() == 8
    write(batch(1), 4)
    compact(spark, path, until=4)
    assert {r.event_id: r.s for r in latest_view(spark, path).collect()} == {
        "0": 0.0, "1": 1.0, "2": 1.0, "3": 1.0, "4": 1.0, "5": 1.0, "6": 3.0, "7": 3.0
    }


def test_view_as_of_a_batch(spark, tmp_path):
    write, path = upsert_batch(str(tmp_path)), str(tmp_path)
    for i in range(4):
        write(spark.createDataFrame([("a", "t", float(i)), (f"k{i}", "t", 0.0)], "event_id string, event_time string, s double"), i)
    compact(spark, path, until=2)
    assert {r.event_id: r.s for r in latest_view(spark, path, until=1).collect()} == {"a": 1.0, "k0": 0.0, "k1": 0.0}
    assert compact(spark, path, until=0) == 0
    assert {r.event_id: r.s for r in latest_view(spark, path, until=0).collect()} == {"a": 0.0, "k0": 0.0}
    assert compact(spark, path) == 2  # written already: nothing is overwritten
    view = latest_view(spark, path)
    before = sorted(map(tuple, view.collect()))
    retain(spark, path, 1)
    assert sorted(p.name for p in (tmp_path / "batches").iterdir() if p.is_dir()) == ["batch_id=3"]
    assert sorted(p.name for p in (tmp_path / "snapshots").iterdir() if p.is_dir()) == ["upto=2"]
    after = latest_view(spark, path)
    assert sorted(map(tuple, after.collect())) == before
    assert len(re.findall(r"^\(\d+\) Exchange", formatted_plan(latest_view(spark, path)), re.M)) <= 1


def keyed(spark, keys, at, s):
    rows = [(k, at, float(s)) for k in keys]
    return spark.createDataFrame(rows, "event_id string, event_time string, s double")


def test_a_snapshot_is_not_shuffled_again(spark, tmp_path):
    write, path = upsert_batch(str(tmp_path)), str(tmp_path)
    write(keyed(spark, [f"k{i}" for i in range(500)], "t1", 1), 0)
    compact(spark, path, until=0, buckets=5)
    write(keyed(spark, ["k7", "new"], "t2", 2), 1)
    plan = latest_view(spark, path)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("FileScan parquet spark_catalog")]
    assert "FullOuter" in above and "Exchange" not in above and "Bucketed: true" in plan and "SelectedBucketsCount: 5 out of 5" in plan
    view = {r.event_id: r.s for r in latest_view(spark, path).collect()}
    assert len(view) == 501 and view["k7"] == view["new"] == 2.0 and view["k8"] == 1.0


def test_only_touched_slices_are_written(spark, tmp_path):
    write, path = upsert_batch(str(tmp_path)), str(tmp_path)
    write(keyed(spark, [f"k{i}" for i in range(300)], "t1", 1), 0)
    compact(spark, path, until=0, buckets=3, slices=8)
    write(keyed(spark, ["k5"], "t2", 2), 1)
    write(keyed(spark, ["k6", "k5"], "t0", 3), 2)  # later batch, earlier time: the batch decides
    compact(spark, path, until=1)
    compact(spark, path, until=2)
    folders = {n: sorted(p.name for p in (tmp_path / f"snapshots/upto={n}").glob("slice=*")) for n in (0, 1, 2)}
    assert len(folders[0]) == 8 and len(folders[1]) == 1 and 1 <= len(folders[2]) <= 2
    views = [{r.event_id: r.s for r in latest_view(spark, path, until=n).collect()} for n in (0, 1, 2)]
    assert [(len(v), v["k5"], v["k6"]) for v in views] == [(300, 1.0, 1.0), (300, 2.0, 1.0), (300, 3.0, 3.0)]
    retain(spark, path, 1, age_s=3600)
    assert (tmp_path / "batches/batch_id=0").exists()  # a reader may still need what the newest snapshot replaces
    retain(spark, path, 1)
    kept = {r.event_id: r.s for r in latest_view(spark, path).collect()}
    assert kept == views[2] and not set(folders[2]) & {p.name for p in (tmp_path / "snapshots/upto=0").glob("slice=*")}


def test_late_records_lose_by_their_own_order(spark, tmp_path):
    write, path = upsert_batch(str(tmp_path)), str(tmp_path)
    write(keyed(spark, ["a", "b"], "t5", 1), 0)
    compact(spark, path, until=0, order=("event_time",))
    write(keyed(spark, ["a"], "t4", 2), 1)
    write(keyed(spark, ["b", "b"], "t6", 3), 2)
    view = latest_view(spark, path, order=("event_time",))
    assert {r.event_id: (r.event_time, r.s) for r in view.collect()} == {"a": ("t5", 1.0), "b": ("t6", 3.0)}
    with pytest.raises(ValueError, match="kept by event_id"):
        latest_view(spark, path, "event_time")


def test_unfinished_batches_are_not_read(spark, tmp_path):
    write, path = upsert_batch(str(tmp_path)), str(tmp_path)
    write(keyed(spark, ["a"], "t1", 1), 0)
    write(keyed(spark, ["a"], "t2", 2), 1)
    (tmp_path / "batches/batch_id=1/_SUCCESS").unlink()
    assert [r.s for r in latest_view(spark, path).collect()] == [1.0]


def test_an_unfinished_snapshot_is_not_read(spark, tmp_path):
    write, path = upsert_batch(str(tmp_path)), str(tmp_path)
    for i in range(3):
        write(spark.createDataFrame([("a", "t", float(i))], "event_id string, event_time string, s double"), i)
    compact(spark, path, until=1)
    (tmp_path / "snapshots/upto=1/_SUCCESS").unlink()
    assert [r.s for r in latest_view(spark, path).collect()] == [2.0]
    compact(spark, path, until=1)
    assert [r.s for r in latest_view(spark, path, until=1).collect()] == [1.0]


def test_an_empty_batch_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([], "event_id string, event_time string, alert_flag string, weather_missing double")
    upsert_batch(str(tmp_path), prediction_counters())(rows, 0)
    assert not list(tmp_path.glob("*/batch_id=*"))


def test_forecasts_are_read_again_after_their_time():
    now, loads = [0.0], []
    current = refreshed(lambda: loads.append(1) or len(loads), 30, lambda: now[0])
    assert [current(), current()] == [1, 1]
    now[0] = 29.0
    assert current() == 1
    now[0] = 30.0
    assert [current(), current()] == [2, 2]


def scored(spark, sf, events):
    weather = fx.weather(spark, sf)
    baseline = spark.createDataFrame([("4", 8, 3, 20.0, 5.0, 9)], "pickup_zone string, pickup_hour int, pickup_dow int, mean double, stddev double, count long")
    return score_stream(events, lambda df: df.withColumn("predicted_hotspot_score", F.length("event_id") * 30.0), weather, {"weather_code": 3}, baseline, "en")


def test_scores_flags_and_counters(spark, sf, tmp_path):
    lines(tmp_path / "in", "a.txt", [event("1"), event("22"), event("333", zone="9"), event("4444")])
    run(scored(spark, sf, parse_events(text_stream(spark, tmp_path / "in"))), tmp_path / "out", counters=prediction_counters())
    rows = {r.event_id: r for r in latest_view(spark, str(tmp_path / "out")).collect()}
    assert {i: (r.hotspot_score, r.hotspot_level, r.alert_flag) for i, r in rows.items()} == {
        "1": (30.0, "medium", "NORMAL"), "22": (60.0, "hot", "CRITICAL_ANOMALY"),
        "333": (90.0, "very hot", "NORMAL"), "4444": (100.0, "very hot", "CRITICAL_ANOMALY"),
    }
    assert rows["1"].event_time == "2024-05-01T08:00:00" and rows["1"].weather_source == "historical_fallback"
    assert [tuple(r) for r in batch_counters(spark, str(tmp_path / "out")).collect()] == [(4, 2, 4, 0)]


def test_stream_equals_batch(spark, sf, tmp_path):
    fx.messages(spark, sf).repartition(3).write.text(str(tmp_path / "in"))
    run(scored(spark, sf, parse_events(text_stream(spark, tmp_path / "in"))), tmp_path / "out")
    stream = latest_view(spark, str(tmp_path / "out"))
    assert stream.select("batch_id").distinct().count() == 3
    assert same_rows(stream.drop("batch_id"), scored(spark, sf, parse_events(fx.messages(spark, sf))))


def test_latest_vehicle_ignores_arrival_order(spark, tmp_path):
    def snapshot(vehicle, at, cycle, speed):
        return json.dumps({"vehicle_id": vehicle, "updated_at": at, "simulation_cycle": cycle, "speed_kmh": speed})

    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    stream = spark.readStream.schema(VEHICLE_SCHEMA).json(str(source))
    lines(source, "a.json", [snapshot("V-1", "t5", 5, 10.0), snapshot("V-2", "t1", 1, 1.0), snapshot("", "t9", 9, 9.0), snapshot(None, "t9", 9, 9.0)])
    run(latest_vehicle(stream), out, "update")
    lines(source, "b.json", [snapshot("V-1", "t4", 4, 99.0), snapshot("V-2", "t1", 2, 2.0)])
    run(latest_vehicle(stream), out, "update")
    view = latest_view(spark, str(out), "vehicle_id", ("updated_at", "simulation_cycle"))
    assert {r.vehicle_id: (r.updated_at, r.speed_kmh) for r in view.collect()} == {"V-1": ("t5", 10.0), "V-2": ("t1", 2.0)}


def test_fleet_stream_equals_batch(spark, sf, tmp_path):
    vehicles = fx.vehicles(spark, sf)
    vehicles.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(vehicles.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run(latest_vehicle(stream), tmp_path / "out", "update")
    view = latest_view(spark, str(tmp_path / "out"), "vehicle_id", ("updated_at", "simulation_cycle"))
    assert same_rows(view.drop("batch_id"), latest_state(vehicles))


def test_silent_vehicles_leave_the_state(spark, tmp_path):
    def snapshot(vehicle, at, cycle=1, speed=1.0):
        return json.dumps({"vehicle_id": vehicle, "updated_at": f"2024-05-01T{at}", "simulation_cycle": cycle, "speed_kmh": speed})

    source, out = tmp_path / "in", tmp_path / "out"
    batches = [
        [snapshot(f"V-{i}", "08:00:00") for i in range(50)],
        [snapshot("V-1", "11:50:00"), snapshot("V-2", "12:00:00"), "{broken", snapshot("V-9", "soon")],
        # Late within the limit: the vehicle's newest, and one that is not; beyond the limit: dropped, whatever it says.
        [snapshot("V-1", "11:58:00", speed=2.0), snapshot("V-2", "11:59:00", speed=9.0), snapshot("V-2", "12:05:00", 2), snapshot("V-3", "08:30:00", speed=9.0)],
        [snapshot("V-2", "14:30:00", 3)],
    ]
    rows, before = [], {name: spark.conf.get(name, None) for name in CHANGELOG_STATE}
    keep_state_with_changelog(spark)
    try:
        for i, batch in enumerate(batches):
            lines(source, f"{i}.json", batch)
            query = run(latest_vehicle(spark.readStream.schema(VEHICLE_SCHEMA).json(str(source)), "10 minutes"), out, "update")
            rows.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)
    assert rows[0] == 50 and rows[1] <= 3 and rows[-1] <= 2
    view = {r.vehicle_id: (r.updated_at[11:], r.speed_kmh) for r in latest_view(spark, str(out), "vehicle_id", ("updated_at", "simulation_cycle")).collect()}
    assert len(view) == 50 and view["V-1"] == ("11:58:00", 2.0) and view["V-2"] == ("14:30:00", 1.0) and view["V-3"] == ("08:00:00", 1.0)


def test_processing_time_trigger(spark, tmp_path):
    lines(tmp_path / "in", "a.txt", [event("1")])
    query = start_query(parse_events(text_stream(spark, tmp_path / "in")), upsert_batch(str(tmp_path / "out")), str(tmp_path / "c"), trigger="1 second", name="events")
    try:
        query.processAllAvailable()
        assert query.name == "events" and latest_view(spark, str(tmp_path / "out")).count() == 1
    finally:
        query.stop()
