"""Rules of single operators on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripspot.functions.calendar import hour_key, pickup_dow, pickup_hour
from tripspot.functions.labels import weather_label
from tripspot.functions.scoring import clamp_score, score_level
from tripspot.operators.baseline import flag_anomaly, with_threshold
from tripspot.operators.clean import clean_trips, normalize_trips, valid_zone_hour, with_event_time
from tripspot.operators.enrich import assert_same_count, assert_unique_key, enrich_zones
from tripspot.operators.evaluation import precision_recall, select_model
from tripspot.operators.fleet import changed_between
from tripspot.operators.forecast import forecast_grid, next_hours, top_zones_per_hour
from tripspot.operators.routes import route_progress
from tripspot.operators.score import daily_scores, temporal_split
from tripspot.operators.serving import latest_predictions, natural_order, rank_zip
from tripspot.operators.verify import diff_keyed, parse_kv_lines, same_rows
from tripspot.operators.weather import assert_coverage, explode_hourly, fill_weather, merge_latest, mode_of, weather_medians
from tripspot.streaming.replay import stamp_replay

WEATHER_ROW = "weather_hour string, temperature_2m double, precipitation double, snowfall double, " \
    "wind_speed_10m double, relative_humidity_2m double, weather_code double"


def test_hourly_rows_keep_nulls_and_absent_fields(spark):
    payload = spark.createDataFrame(
        [((["2024-03-01T05:00", "2024-03-01T06:00"], [7.5, None], [0.4]),), ((None, None, None),)],
        "hourly struct<time: array<string>, temperature_2m: array<double>, snowfall: array<double>>",
    )
    rows = explode_hourly(payload).orderBy("weather_hour").collect()
    assert [r.weather_hour for r in rows] == ["2024-03-01T05", "2024-03-01T06"]
    assert [r.temperature_2m for r in rows] == [7.5, None]
    assert [r.snowfall for r in rows] == [0.4, None]
    assert [r.weather_code for r in rows] == [None, None]


def test_missing_weather_is_filled_and_marked(spark):
    weather = spark.createDataFrame(
        [("2024-03-01T05", 3.0, 0.0, 0.0, 9.0, 70.0, 61.0), ("2024-03-01T06", 3.0, None, 0.0, 9.0, 70.0, 3.0)], WEATHER_ROW
    )
    hours = spark.createDataFrame([(f"2024-03-01T0{h}",) for h in (5, 6, 7)], "weather_hour string")
    rows = fill_weather(hours, weather, {"precipitation": 2, "weather_code": 71}).orderBy("weather_hour").collect()
    assert [r.weather_missing for r in rows] == [0.0, 1.0, 1.0]
    assert [r.weather_source for r in rows] == ["Open-Meteo forecast", "historical_fallback", "historical_fallback"]
    assert [r.precipitation for r in rows] == [0.0, 2.0, 2.0]
    assert [r.temperature_2m for r in rows] == [3.0, 3.0, 0.0]
    assert [r.weather_code for r in rows] == ["61", "3", "71"]


def test_limit_uses_three_sigma_support_and_cap(spark):
    keys = "pickup_zone string, pickup_hour int, pickup_dow int"
    baseline = spark.createDataFrame(
        [("a", 8, 1, 30.0, 5.0, 12), ("b", 8, 1, 30.0, 5.0, 4), ("c", 8, 1, 90.0, 20.0, 9)],
        keys + ", mean double, stddev double, count long",
    )
    rows = spark.createDataFrame([(z, 8, 1, s) for z, s in (("a", 45.0), ("a", 45.001), ("b", 100.0), ("c", 100.0), ("d", 99.0))], keys + ", hotspot_score double")
    out = {(r.pickup_zone, r.hotspot_score): r for r in flag_anomaly(rows, baseline).collect()}
    assert out["a", 45.0].alert_flag == "NORMAL" and out["a", 45.001].alert_flag == "CRITICAL_ANOMALY"
    assert (out["a", 45.0].anomaly_threshold, out["a", 45.0].historical_baseline_samples) == (45.0, 12)
    assert (out["b", 100.0].anomaly_threshold, out["b", 100.0].historical_baseline_samples) == (100.0, 4)
    assert out["c", 100.0].anomaly_threshold == 100.0 and out["c", 100.0].alert_flag == "NORMAL"
    assert (out["d", 99.0].historical_mean_score, out["d", 99.0].historical_stddev_score) == (100.0, 0.0)
    assert with_threshold(rows, baseline, sparse_mean=0.0).filter("pickup_zone = 'd'").first().historical_mean_score == 0.0


@pytest.mark.parametrize(
    "lang, expected",
    [("vi", ["Tuyết nhẹ", "Trời quang", "Điều kiện thời tiết khác", "Không có dữ liệu"]),
     ("en", ["slight snowfall", "clear sky", "other conditions", "no data"])],
)
def test_weather_labels(spark, lang, expected):
    codes = spark.createDataFrame([(0, 71.0), (1, 0.0), (2, 42.0), (3, None)], "i int, c double")
    assert [r[0] for r in codes.orderBy("i").select(weather_label("c", lang)).collect()] == expected


def test_levels_and_clamp(spark):
    rows = spark.createDataFrame([(0, 75.0), (1, 74.99), (2, 25.0), (3, -3.0), (4, None), (5, 140.0)], "i int, s double")
    out = rows.orderBy("i").select(score_level("s", "en"), clamp_score("s")).collect()
    assert [r[0] for r in out] == ["very hot", "hot", "medium", "low", "low", "very hot"]
    assert [r[1] for r in out] == [75.0, 74.99, 25.0, 0.0, 0.0, 100.0]


def test_wall_clock_survives_clock_changes(spark):
    # 02:30 does not exist in New York on this day; the wall-clock hour is kept.
    row = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' as ts").select(pickup_hour("ts"), pickup_dow("ts"), hour_key("ts")).first()
    assert tuple(row) == (2, 0, "2024-03-10T02")


def test_unreadable_times_become_null(spark):
    rows = spark.createDataFrame([("2024-02-30 10:00:00",), ("x",), (None,), ("2024-02-29T10:00:00",)], "pickup_datetime string")
    assert [r.event_time for r in with_event_time(rows).collect()] == [None, None, None, datetime(2024, 2, 29, 10)]
    formatted = spark.createDataFrame([("29.02.2024 10:15",), ("?",)], "pickup_datetime string")
    assert [r.event_time for r in with_event_time(formatted, fmt="dd.MM.yyyy HH:mm").collect()] == [datetime(2024, 2, 29, 10, 15), None]


def test_cleaning_keeps_empty_zones_and_drops_null_ones(spark):
    rows = spark.createDataFrame(
        [("1", "2024-01-01 00:00:00", " 4 ", None), ("2", "2024-01-01 00:00:00", None, "5"), ("3", "2024-01-01 00:00:00", "  ", "5"),
         ("1", "2023-12-31 23:00:00", "9", "5"), ("4", "bad", "4", "5")],
        "event_id string, pickup_datetime string, pickup_zone string, dropoff_zone string",
    )
    out = {r.event_id: (r.pickup_zone, r.pickup_hour, r.pickup_dow) for r in clean_trips(normalize_trips(rows)).collect()}
    assert out == {"1": ("9", 23, 0), "3": ("", 0, 1)}


def test_key_value_records(spark):
    lines = spark.createDataFrame([(v,) for v in ("4\t7\t1", "\t7\t1", "4\tx\t1", "4\t-7\t1", "4\t07\t2", "4\t7", "4\t7\t1\t9", "4\t7\t")], "value string")
    assert sorted(tuple(r) for r in valid_zone_hour(parse_kv_lines(lines)).collect()) == [("4", 7, 1), ("4", 7, 2)]


def test_scores_are_relative_to_the_busiest_zone(spark):
    trips = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 8)), ("a", datetime(2024, 1, 1, 8, 30)), ("a", datetime(2024, 1, 1, 8, 40)), ("b", datetime(2024, 1, 1, 8)), ("b", datetime(2021, 1, 1, 8))],
        "pickup_zone string, pickup_datetime timestamp_ntz",
    )
    out = {r.pickup_zone: (r.hotspot_score, r.weather_hour) for r in daily_scores(trips).collect()}
    assert out == {"a": (100.0, "2024-01-01T08"), "b": (33.33, "2024-01-01T08")}


def test_score_properties(spark, sf):
    from tripspot import fixtures as fx

    trips = fx.demand_trips(spark, sf)
    scores = daily_scores(trips)
    per_bucket = scores.groupBy("service_date", "pickup_hour").agg(F.max("hotspot_score").alias("top"), F.min("hotspot_score").alias("low"))
    assert per_bucket.filter("top <> 100.0 or low < 0").count() == 0
    assert scores.agg(F.sum("trip_count")).first()[0] == trips.count()


@pytest.mark.parametrize("days, train", [(2, 1), (3, 2), (4, 3), (5, 4), (10, 8), (11, 8)])
def test_temporal_split(spark, days, train):
    rows = spark.range(days * 3).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("service_date"))
    split = temporal_split(rows)
    assert (split.train_days, split.test_days) == (train, days - train)
    assert split.train.count() + split.test.count() == rows.count()
    assert split.train_end < split.test_start and split.test_end == date(2024, 1, days)


def test_temporal_split_needs_two_dates(spark):
    with pytest.raises(ValueError):
        temporal_split(spark.sql("select date'2024-01-01' as service_date"))


def test_enrichment_guards(spark):
    zones = spark.createDataFrame([(1, "B", "Z1", "s"), (1, "B", "Z2", "s")], "LocationID int, Borough string, Zone string, service_zone string")
    with pytest.raises(ValueError):
        assert_unique_key(zones, "LocationID")
    with pytest.raises(ValueError):
        assert_same_count(1, 2)
    trips = spark.createDataFrame([("e", "1", "8")], "event_id string, pickup_zone string, dropoff_zone string")
    row = enrich_zones(trips, zones.limit(1)).first()
    assert row.pickup_zone_name == "Z1" and row.dropoff_zone_name is None


def test_precision_without_hot_rows_is_null(spark):
    row = precision_recall(spark.createDataFrame([(1.0, 2.0)], "hotspot_score double, predicted_hotspot_score double")).first()
    assert (row.precision, row.recall, row.rows) == (None, None, 1)


@pytest.mark.parametrize("weather, expected", [((9.9, 5.1), "weather"), ((9.9, 5.11), "calendar"), ((10.0, 4.0), "calendar")])
def test_model_selection(spark, weather, expected):
    metrics = spark.createDataFrame([("calendar", 10.0, 5.0), ("weather", *weather)], "candidate string, rmse double, mae double")
    assert select_model(metrics).first().selected == expected


def test_mode_prefers_the_smallest_text(spark):
    codes = spark.createDataFrame([("3",), ("3",), ("10",), ("10",), ("2",)], "weather_code string")
    assert tuple(mode_of(codes, "weather_code").first()) == ("10", 2)


def test_approximate_medians_are_close(spark):
    rows = spark.range(10001).select(*[F.col("id").cast("double").alias(n) for n in ("temperature_2m", "precipitation", "snowfall", "wind_speed_10m", "relative_humidity_2m")])
    assert all(abs(v - 5000) <= 101 for v in weather_medians(rows).first())
    assert set(weather_medians(rows, exact=True).first()) == {5000.0}


def test_merge_latest(spark):
    old = spark.createDataFrame([("h1", 1.0), ("h2", 2.0)], "weather_hour string, t double")
    new = spark.createDataFrame([("h2", None), ("h0", 3.0)], "weather_hour string, t double")
    assert [tuple(r) for r in merge_latest([old, new]).collect()] == [("h0", 3.0), ("h1", 1.0), ("h2", None)]


def test_coverage_guard(spark):
    scores = spark.createDataFrame([("h1",), ("h1",), ("h2",)], "weather_hour string")
    weather = spark.createDataFrame([("h1", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], WEATHER_ROW)
    assert assert_coverage(scores, weather, 0.6)["covered_rows"] == 2
    with pytest.raises(RuntimeError):
        assert_coverage(scores, weather)


def test_forecast_hours_and_grid(spark):
    now = datetime(2024, 12, 31, 22, 59)
    assert len(next_hours(now, 0)) == 1 and len(next_hours(now, 99)) == 6
    zones = spark.createDataFrame([("1",), ("2",)], "pickup_zone string")
    rows = forecast_grid(next_hours(now, 2), zones).filter("pickup_zone = '1'").orderBy("forecast_time").collect()
    assert [(r.weather_hour, r.pickup_hour, r.pickup_dow) for r in rows] == [("2024-12-31T23", 23, 2), ("2025-01-01T00", 0, 3)]


def test_ranks_break_ties_by_zone(spark):
    rows = spark.createDataFrame([("h", "2", 5.0), ("h", "1", 5.0), ("h", "3", 9.0)], "weather_hour string, pickup_zone string, hotspot_score double")
    assert [r.pickup_zone for r in top_zones_per_hour(rows, 2).orderBy("rank").collect()] == ["3", "1"]


def test_natural_order(spark):
    rows = spark.createDataFrame([(v,) for v in ("10", "9", "x", "A", "100")], "z string")
    assert [r.z for r in natural_order(rows, "z").collect()] == ["9", "10", "100", "A", "x"]


@pytest.mark.parametrize("n", [None, 10])
def test_rank_zip_stops_at_the_shorter_side(spark, n):
    left = spark.createDataFrame([("v1", 1), ("v2", 3), ("v3", 2)], "v string, t int")
    right = spark.createDataFrame([("z1", 5.0), ("z2", 7.0)], "z string, s double")
    out = rank_zip(left, [F.desc("t")], right, [F.desc("s")], n)
    assert sorted((r.v, r.z) for r in out.collect()) == [("v2", "z2"), ("v3", "z1")]


def test_latest_predictions_limits(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("event_id"), F.lit("t").alias("event_time"), F.lit("1").alias("pickup_zone"))
    assert [latest_predictions(rows, n).count() for n in (0, 20, 500)] == [1, 20, 100]


def test_changed_between(spark):
    columns = "vehicle_id string, latitude double, longitude double, simulation_cycle int"
    before = spark.createDataFrame([("a", 1.0, 1.0, 1), ("b", 1.0, 1.0, 1), ("c", None, 1.0, 1), ("gone", 1.0, 1.0, 1)], columns)
    after = spark.createDataFrame([("a", 1.0, 1.0, 1), ("b", 1.0, 1.1, 1), ("c", None, 1.0, 1)], columns)
    assert {r.vehicle_id: r.changed for r in changed_between(before, after).collect()} == {"a": False, "b": True, "c": False, "gone": True}


def test_differences_see_nulls_and_repeats(spark):
    a = spark.createDataFrame([(None, 1), ("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 1), ("x", None), ("z", 2)], "k string, v int")
    assert sorted(tuple(r) for r in diff_keyed(a, b, ["k"], ["v"]).collect()) == [("x", 1, None), ("y", 2, None), ("z", None, 2)]
    assert same_rows(a, a.repartition(3)) and not same_rows(a, a.union(a)) and not same_rows(a, b)


def test_route_progress(spark):
    line = [(0.0, 0.0), (0.0, 0.01), (0.0, 0.03)]
    step = 6_371_000 * 3.141592653589793 / 180 * 0.01
    rows = [("a", line, 0, 100.0), ("b", line, 1, 0.0), ("c", line, 2, 0.0), ("d", None, 0, 0.0), ("e", line[:1], 0, 0.0)]
    df = spark.createDataFrame(rows, "vehicle_id string, route array<struct<lon: double, lat: double>>, segment_index int, segment_progress_m double")
    df = df.withColumns({"route_distance_m": F.lit(3 * step), "speed_kmh": F.lit(0.5), "longitude": F.lit(-0.01), "latitude": F.lit(0.01)})
    out = {r.vehicle_id: r for r in route_progress(df).collect()}
    assert out["a"].remaining_m == pytest.approx(3 * step - 100)
    assert out["b"].remaining_m == pytest.approx(2 * step) and out["b"].progress_pct == pytest.approx(100 / 3)
    assert out["a"].heading_degrees == pytest.approx(90) and out["b"].eta_minutes == pytest.approx(2 * step / 1000 * 60)
    assert (out["c"].remaining_m, out["c"].progress_pct) == (0.0, 100.0)
    assert [(out[v].remaining_m, out[v].progress_pct, out[v].heading_degrees) for v in "de"] == [(0.0, 0.0, 0.0)] * 2
    joined = route_progress(df.select("vehicle_id", "route"), df.drop("route")).filter("vehicle_id = 'b'").first()
    assert joined.remaining_m == pytest.approx(2 * step)


def test_replay_keeps_given_ids(spark):
    rows = spark.createDataFrame([("x", 4, 5, 2), (None, 6, 7, 1), ("", 8, 9, 3)], "event_id string, pickup_zone int, dropoff_zone int, o int")
    out = stamp_replay(rows, [F.asc("o")], "2024-01-01 23:59:30", 30).orderBy("pickup_datetime").collect()
    assert [r.pickup_datetime for r in out] == ["2024-01-01T23:59:30", "2024-01-02T00:00:00", "2024-01-02T00:00:30"]
    assert out[1].event_id == "x" and len(out[0].event_id) == len(out[2].event_id) == 40
