"""Daily parts merged over any window equal aggregates over its rows."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from tripspot.operators.baseline import BASELINE_KEYS, historical_baseline
from tripspot.operators.mergeable import daily_counts, daily_moments, daily_sketches, keep_daily, merge_mode, merge_moments, merge_quantiles, rank_errors
from tripspot.operators.weather import mode_of


@pytest.fixture(scope="module")
def scores(spark):
    i = F.col("id")
    return spark.range(6000, numPartitions=6).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 7).cast("int")).alias("service_date"),
        F.when(i % 3 == 0, "hot").otherwise((i % 5).cast("string")).alias("pickup_zone"),
        (i % 2).cast("int").alias("pickup_hour"),
        F.lit(1).alias("pickup_dow"),
        # A tiny spread around a large value, in which squares would lose all digits.
        F.when(i % 50 != 7, (F.col("id") * 7919 % 1009) / 1000 + F.when(i % 5 == 4, 1e9).otherwise(50.0)).alias("hotspot_score"),
    ).cache()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_all_windows_of_days(scores):
    parts = daily_moments(scores).cache()
    for days in [c for n in (1, 2, 7) for c in itertools.combinations(range(1, 8), n)][::3]:
        inside = F.dayofmonth("service_date").isin(list(days))
        got = rows(merge_moments(parts.filter(inside)))
        given = scores.filter(inside & F.col("hotspot_score").isNotNull())
        want = rows(given.groupBy(*BASELINE_KEYS).agg(F.avg("hotspot_score"), F.stddev_pop("hotspot_score"), F.count("*")))
        assert [g[:3] + g[5:] for g in got] == [w[:3] + w[5:] for w in want]
        assert all(math.isclose(g[3], w[3], rel_tol=1e-12, abs_tol=1e-9) and math.isclose(g[4], w[4], rel_tol=1e-9, abs_tol=1e-6) for g, w in zip(got, want))
    assert any(0.2 < g[4] < 0.4 and g[3] > 1e8 for g in got)


def test_moved_window_and_repeated_days(spark, scores, tmp_path):
    path, day = str(tmp_path / "moments"), F.dayofmonth("service_date")
    small = scores.filter("hotspot_score < 1000")
    keep_daily(daily_moments(small.filter(day <= 4).withColumn("hotspot_score", F.when(day == 4, 0.0).otherwise(F.col("hotspot_score")))), path)
    keep_daily(daily_moments(small.filter(day >= 4)), path)  # day 4 anew, 5 to 7 in addition
    window = spark.read.parquet(path).filter("service_date >= '2024-01-03'")
    want = historical_baseline(small.filter("service_date >= '2024-01-03'"))
    assert rows(merge_moments(window)) == rows(want)


def test_sketches_and_modes(spark, tmp_path):
    i = F.col("id")
    data = spark.range(60_000, numPartitions=5).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 9).cast("int")).alias("service_date"),
        F.xxhash64("id").cast("double").alias("a"), (i % 3).cast("double").alias("b"),
        F.when(i % 2 == 0, i.cast("double") ** 3).alias("c"), F.lit(None).cast("double").alias("d"),
        (i % 4).cast("int").alias("weather_code"),
    )
    keep_daily(daily_sketches(data, "abcd"), str(tmp_path / "s"))
    found = merge_quantiles(spark.read.parquet(str(tmp_path / "s")), "abcd")
    errors = {r.field: r.rank_error for r in rank_errors(data, found, "abcd").collect()}
    assert set(errors) == {"a", "b", "c"} and max(errors.values()) <= 0.01 and errors["b"] == 0
    assert len(spark.read.parquet(str(tmp_path / "s")).first().a) < 20_000
    assert merge_mode(daily_counts(data)).collect() == mode_of(data, "weather_code").collect()
