"""Training job: artifacts, report and usefulness of the model."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripspot import fixtures as fx
from tripspot.operators.forecast import forecast
from tripspot.operators.ml import load_model
from tripspot.plans.training import training_job

QUICK = {"maxIter": 3, "maxDepth": 3}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    # The smallest tables have about one trip per zone and hour, too few to learn from.
    sf = "/root/testdata/sf0.01"
    if not Path(sf).is_dir():
        pytest.skip(f"no tables at {sf}")
    out = str(tmp_path_factory.mktemp("artifacts"))
    return training_job(fx.demand_trips(spark, sf), fx.demand_weather(spark, sf), out, **QUICK), out


def test_report(spark, run):
    result, out = run
    report = spark.read.json(f"{out}/metrics").first()
    assert (report.training_days, report.evaluation_days) == (96, 24)
    assert report.weather_coverage == 1.0 and report.selected in ("calendar", "weather")
    assert report.deployed_metrics == report[f"{report.selected}_metrics"]
    assert report.calendar_metrics.r2 > 0.3 and report.calendar_metrics.rmse >= report.calendar_metrics.mae


def test_saved_model_scores_unseen_zones(spark, run):
    result, out = run
    model = load_model(f"{out}/model")
    rows = spark.createDataFrame([("0", 3, 2), ("never seen", 3, 2)], "pickup_zone string, pickup_hour int, pickup_dow int")
    for name in ("temperature_2m", "precipitation", "snowfall", "wind_speed_10m", "relative_humidity_2m"):
        rows = rows.withColumn(name, F.lit(1.0))
    rows = rows.withColumn("weather_code", F.lit("77"))
    predicted = {r.pickup_zone: r.predicted_hotspot_score for r in model.transform(rows).collect()}
    assert len(predicted) == 2 and predicted["0"] > predicted["never seen"]


def test_forecast(spark, run):
    result, out = run
    zones = spark.createDataFrame([("0",), ("1",), ("x",)], "pickup_zone string")
    weather = spark.createDataFrame(
        [("2024-05-01T10", 1.0, 0.0, 0.0, 9.0, 50.0, 61.0)],
        "weather_hour string, temperature_2m double, precipitation double, snowfall double, wind_speed_10m double, "
        "relative_humidity_2m double, weather_code double",
    )
    baseline = spark.read.parquet(f"{out}/baseline")
    rows = forecast(result.model, datetime(2024, 5, 1, 9, 30), zones, weather, result.fallback, baseline, hours=2).collect()
    assert len(rows) == 6 and {r.weather_hour for r in rows} == {"2024-05-01T10", "2024-05-01T11"}
    assert {(r.weather_hour, r.weather_missing) for r in rows} == {("2024-05-01T10", 0.0), ("2024-05-01T11", 1.0)}
    for hour in ("2024-05-01T10", "2024-05-01T11"):
        ranked = sorted((r for r in rows if r.weather_hour == hour), key=lambda r: r["rank"])
        assert [r.hotspot_score for r in ranked] == sorted((r.hotspot_score for r in ranked), reverse=True)
    assert all(0 <= r.hotspot_score <= 100 for r in rows)
    unknown = [r for r in rows if r.pickup_zone == "x"]
    assert all((r.anomaly_threshold, r.historical_mean_score) == (100.0, 0.0) for r in unknown)
