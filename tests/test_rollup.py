"""Rollups kept batch by batch equal full aggregates over the current records."""

import random

import pytest
from pyspark.sql import functions as F

from tripspot.operators import serving
from tripspot.plans.reports import formatted_plan
from tripspot.streaming.rollup import changes, compact_rollups, newest_records, overview_of, ranking_of, rollup, rollup_sink, series_of, summary_of
from tripspot.streaming import rollup as module
from tripspot.streaming.sink import compact, latest_view, retain

SCHEMA = "event_id string, event_time string, pickup_zone string, hotspot_score double"


def batch(rng, n):
    return [(f"e{rng.randrange(60)}", f"2024-05-{rng.randrange(1, 4):02}T{rng.randrange(24):02}:0{rng.randrange(3)}:00", str(rng.randrange(6)), rng.randrange(1000) / 10) for _ in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()))


def check(spark, path):
    view = latest_view(spark, path)
    hours = rollup(spark, path, "hours")
    assert rows(ranking_of(hours)) == rows(serving.zone_ranking(view))
    got, want = rows(series_of(hours)), rows(serving.hourly_series(view))
    assert [g[0] for g in got] == [w[0] for w in want] and got == [(w[0], pytest.approx(w[1], abs=1e-9)) for w in want]
    for zone in (None, "3"):
        assert rows(summary_of(spark, path, zone)) == rows(serving.summary(view, zone))
        names = ["event_id", "event_time", "pickup_zone", "hotspot_score"]
        assert newest_records(spark, path, 20, zone).select(names).collect() == serving.latest_predictions(view, 20, zone).select(names).collect()


def test_replays_replacements_and_compaction(spark, tmp_path):
    rng, path = random.Random(2), str(tmp_path)
    store = rollup_sink(path)
    for i, n in enumerate([40, 30, 0, 50, 5]):
        rows_ = spark.createDataFrame(batch(rng, n), SCHEMA)
        for _ in range(1 + i % 2):
            store(rows_, i)
        if i in (1, 3):
            compact(spark, path, buckets=4)
            compact_rollups(spark, path)
            retain(spark, path, 1)
        if i != 2:
            check(spark, path)
    assert {k: df.count() > 0 for k, df in overview_of(spark, path).items()} == dict.fromkeys(["summary", "ranking", "series", "predictions"], True)


def test_a_zone_that_lost_its_records_is_gone(spark, tmp_path):
    store = rollup_sink(str(tmp_path))
    store(spark.createDataFrame([("a", "2024-01-01T09:00:00", "1", 10.1), ("b", "2024-01-01T08:00:00", "2", 0.3)], SCHEMA), 0)
    store(spark.createDataFrame([("a", "2024-01-01T07:00:00", "2", 0.1)], SCHEMA), 1)
    assert [tuple(r) for r in ranking_of(rollup(spark, str(tmp_path), "hours")).collect()] == [("2", 0.2, 2)]
    assert [tuple(r) for r in summary_of(spark, str(tmp_path)).collect()] == [(2, 1, "2024-01-01T08:00:00")]
    assert [r.event_id for r in newest_records(spark, str(tmp_path), 1).collect()] == ["b"]


def test_an_update_shuffles_only_its_batch(spark, tmp_path):
    path, rng = str(tmp_path), random.Random(3)
    store = rollup_sink(path)
    store(spark.createDataFrame(batch(rng, 200), SCHEMA), 0)
    compact(spark, path, until=0, buckets=4)
    store(spark.createDataFrame(batch(rng, 3), SCHEMA), 1)
    plan = changes(spark, path, 1)._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("FileScan parquet spark_catalog")
    side = plan[:scan].splitlines()
    assert "Bucketed: true" in plan and "Exchange" not in "".join(side[-4:])
    hours = formatted_plan(rollup(spark, path, "hours"))
    assert "hotspot_score" not in hours


def test_the_changes_of_a_batch_are_worked_out_once(spark, tmp_path, monkeypatch):
    store, seen = rollup_sink(str(tmp_path)), spark.sparkContext.accumulator(0)

    def counted(sign):
        seen.add(1)
        return sign

    each = F.udf(counted, "int").asNondeterministic()
    monkeypatch.setattr(module, "changes", lambda *args: changes(*args).withColumn("sign", each("sign")))
    store(spark.createDataFrame([(str(i), f"2024-05-01T0{i}:00:00", "1", 0.1) for i in range(8)], SCHEMA).coalesce(1), 0)
    assert seen.value == 8
    store(spark.createDataFrame([("3", "2024-05-02T00:00:00", "2", 0.2), ("x", "2024-05-02T00:00:00", "2", 0.4)], SCHEMA).coalesce(1), 1)
    assert seen.value == 8 + 3  # a replaced record counts twice
    assert "lambda" not in formatted_plan(changes(spark, str(tmp_path), 1))
    assert not (tmp_path / "rollups/staged/batch_id=1").exists()
    check(spark, str(tmp_path))


def test_levels_with_nulls(spark, tmp_path):
    path, store = str(tmp_path), rollup_sink(str(tmp_path))
    store(spark.createDataFrame([("a", "2024-05-01T00:01:00", "1", 5.0), ("b", None, "1", None), ("c", "2024-05-01T00:00:00", None, 1.5), (None, None, "9", 9.0)], SCHEMA), 0)
    store(spark.createDataFrame([("a", "2024-05-01T00:01:00", "1", 5.0), ("b", "2024-05-01T00:02:00", "1", None), ("c", None, None, None)], SCHEMA), 1)
    last = spark.read.parquet(f"{path}/rollups/hours/batch_id=1").select("pickup_zone", "bucket", "n", F.col("total").cast("double"))
    # The record that was replaced by its like leaves a total of 0, not NULL, beside one without a score.
    assert {tuple(r) for r in last.collect()} == {("1", "2024-05-01T00", 1, 0.0), ("1", None, -1, None), (None, "2024-05-01T00", -1, -1.5), (None, None, 1, None)}
    hours = {tuple(r) for r in rollup(spark, path, "hours").select("pickup_zone", "bucket", "n", F.col("total").cast("double")).collect()}
    assert hours == {("1", "2024-05-01T00", 2, 5.0), (None, None, 1, None)}


def test_empty(spark, tmp_path):
    rollup_sink(str(tmp_path))(spark.createDataFrame([], SCHEMA), 0)
    with pytest.raises(FileNotFoundError):
        rollup(spark, str(tmp_path), "hours")
