"""The jobs one after the other, from raw files to the dashboard results."""

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripspot.functions.fixed import WEATHER_FIELDS
from tripspot.jobs import main
from tripspot.session import shared_dir
from tripspot.operators.verify import same_rows
from tripspot.streaming.sink import batch_counters, latest_view


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Ten days of trips in five zones, zone 1 the busiest, with weather for all hours."""
    root = tmp_path_factory.mktemp("lake")
    start, rows = F.lit("2024-03-01").cast("timestamp_ntz"), spark.range(12000)
    zone = F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 5 + 1).cast("int")
    trips = rows.select(
        (start + F.make_dt_interval(mins=(F.col("id") * 71 % 14400).cast("int"))).alias("tpep_pickup_datetime"),
        zone.alias("PULocationID"),
        (F.col("id") % 7 + 1).cast("int").alias("DOLocationID"),
    )
    trips.write.parquet(str(root / "raw"))
    lookup = ["LocationID,Borough,Zone,service_zone"] + [f"{i},B{i % 2},Zone {i},S" for i in range(1, 8)]
    (root / "zones.csv").write_text("\n".join(lookup))
    hours = [datetime(2024, 3, 1) + timedelta(hours=h) for h in range(24 * 11)]
    hourly = {"time": [h.strftime("%Y-%m-%dT%H:%M") for h in hours]}
    hourly |= {name: [float(i % 5) for i in range(len(hours))] for name in WEATHER_FIELDS}
    (root / "weather.json").write_text(json.dumps({"hourly": hourly}))
    return root


def read(spark, path):
    return spark.read.json(str(path)).collect()


def test_jobs(spark, lake):
    raw, curated, artifacts, weather = (str(lake / n) for n in ("raw", "curated", "artifacts", "weather.json"))
    source = ["--parquet", raw, "--csv", f"{raw}.csv"]
    main(["zone-hours", *source, "--out", str(lake / "counts")], spark)
    main(["etl", *source, "--lookup", str(lake / "zones.csv"), "--out", curated], spark)
    assert spark.read.parquet(curated).count() == 12000
    loads = ["--out", str(lake / "loads/curated"), "--state", str(lake / "loads/state")]
    for _ in range(2):
        main(["etl", *source, "--lookup", str(lake / "zones.csv"), *loads], spark)
    assert same_rows(spark.read.parquet(str(lake / "loads/curated")).drop("load_id"), spark.read.parquet(curated))
    main(["reports", "--curated", curated, "--out", str(lake / "reports")], spark)
    assert len(read(spark, lake / "reports/borough_hour_profile/rows")) == 48
    main(["profile", "--curated", curated, "--out", str(lake / "profile")], spark)
    assert read(spark, lake / "profile/summary")[0].row_count == 12000
    main(["train", "--curated", curated, "--weather", weather, "--out", artifacts, "--maxIter", "4", "--maxDepth", "3"], spark)
    report = read(spark, f"{artifacts}/metrics")[0]
    assert (report.training_days, report.evaluation_days) == (8, 2)

    inbox = lake / "trips"
    inbox.mkdir()
    events = [
        {"event_id": f"e{i}", "pickup_datetime": f"2024-03-11T0{i % 9}:10:00", "pickup_zone": str(i % 5 + 1), "dropoff_zone": "2"}
        for i in range(40)
    ]
    (inbox / "a.txt").write_text("\n".join(map(json.dumps, events)))
    common = ["--once", "--checkpoint"]
    main(["score-stream", "--folder", str(inbox), "--artifacts", artifacts, "--weather", weather, "--out", str(lake / "preds"), *common, str(lake / "c1")], spark)
    preds = latest_view(spark, str(lake / "preds"))
    assert preds.count() == 40 and preds.filter("weather_missing > 0").count() == 0
    assert batch_counters(spark, str(lake / "preds")).first().records == 40

    yard = lake / "cars"
    yard.mkdir()
    cars = [{"vehicle_id": f"V-{i}", "status": "available" if i % 2 else "occupied", "pickup_zone": "3", "speed_kmh": 10.0, "updated_at": f"t{i}", "simulation_cycle": i} for i in range(6)]
    (yard / "a.txt").write_text("\n".join(map(json.dumps, cars)))
    main(["track-fleet", "--folder", str(yard), "--out", str(lake / "fleet"), *common, str(lake / "c2")], spark)

    main(["forecast", "--artifacts", artifacts, "--weather", weather, "--now", "2024-03-10T22:30:00", "--hours", "2", "--out", str(lake / "forecast")], spark)
    forecasts = read(spark, lake / "forecast")
    assert len(forecasts) == 10 and {r.weather_hour for r in forecasts} == {"2024-03-10T23", "2024-03-11T00"}
    assert {r.pickup_zone for r in forecasts if r["rank"] == 1} == {"1"}

    # Unmapped zones come from the baseline; with a map every zone of it is there.
    features = [{"properties": {"LocationID": str(i)}} for i in (1, 2, 99)]
    (lake / "map.json").write_text(json.dumps({"features": features}))
    main(["forecast", "--artifacts", artifacts, "--weather", weather, "--now", "2024-03-10T22:30:00", "--hours", "1", "--geojson", str(lake / "map.json"), "--out", str(lake / "mapped"), "--outlook", str(lake / "outlook"), "--map", str(lake / "zone-map")], spark)
    classes = {r.pickup_zone: (r.forecast_known, r.map_class) for r in read(spark, lake / "zone-map")}
    assert set(classes) == {"1", "2", "99"} and all(known and kind in ("hot", "medium", "low") for known, kind in classes.values())
    assert {r.pickup_zone for r in read(spark, lake / "mapped")} == {"1", "2", "99"}
    assert len(read(spark, lake / "outlook")) == 4

    # A second batch, then compaction: the view stays.
    (inbox / "b.txt").write_text(json.dumps(events[0] | {"event_id": "late"}))
    main(["score-stream", "--folder", str(inbox), "--artifacts", artifacts, "--weather", weather, "--out", str(lake / "preds"), *common, str(lake / "c1")], spark)
    (inbox / "b.txt").unlink()
    before = sorted(r.event_id for r in latest_view(spark, str(lake / "preds")).collect())
    for _ in range(2):
        main(["compact", "--out", str(lake / "preds"), "--keep", "1"], spark)
    assert sorted(r.event_id for r in latest_view(spark, str(lake / "preds")).collect()) == before and len(before) == 41

    scratch = Path(shared_dir(spark))
    assert not [p for p in scratch.iterdir() if p.name.startswith(("score-stream", "dashboard"))]
    cars[1] |= {"latitude": 40.5, "updated_at": "t9"}
    (yard / "b.txt").write_text(json.dumps(cars[1]))
    main(["track-fleet", "--folder", str(yard), "--out", str(lake / "fleet"), *common, str(lake / "c2")], spark)
    main(["dashboard", "--predictions", str(lake / "preds"), "--vehicles", str(lake / "fleet"), "--out", str(lake / "board"), "--vehicle-count", "7"], spark)
    assert tuple(read(spark, lake / "board/fleet_counters")[0][c] for c in ("total", "available", "occupied", "moving")) == (6, 3, 3, 6)
    checks = {r.check: r.passed for r in read(spark, lake / "board/checks")}
    assert checks == {"prediction_records": True, "hotspot_explanations": True, "fleet_records": False, "fleet_moved": True}
    assert read(spark, lake / "board/summary")[0]["count"] == 41
    assert len(read(spark, lake / "board/predictions")) == 30
    pairs = read(spark, lake / "board/dispatch")
    assert {p.vehicle_id for p in pairs} == {"V-1", "V-3", "V-5"} and len({p.target_zone for p in pairs}) == 3


def test_finished_jobs_are_skipped(spark, lake, capsys):
    raw = str(lake / "raw")
    main(["etl", "--parquet", raw, "--csv", raw, "--lookup", str(lake / "zones.csv"), "--out", str(lake / "curated")], spark)
    assert capsys.readouterr().out.strip() == "None"
