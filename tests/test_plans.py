"""Shape of the physical plans: what is read, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from tripspot import fixtures as fx
from tripspot.operators.baseline import flag_anomaly, historical_baseline, with_threshold
from tripspot.operators.demand import borough_hour_profile, has_borough, top_zone_hour_dow, zone_hour_dow_counts
from tripspot.operators.enrich import enrich_zones
from tripspot.operators.forecast import top_zones_per_hour
from tripspot.operators.routes import route_progress
from tripspot.operators.rows import repeat_rows
from tripspot.operators.score import daily_scores
from tripspot.operators.serving import latest_predictions
from tripspot.operators.verify import same_rows
from tripspot.operators.weather import fill_weather
from tripspot.plans.partition_bench import bench_partitions
from tripspot.plans.reports import formatted_plan
from tripspot.registry.joins import stored_baseline, stored_weather
from tripspot.sources.sinks import write_curated


@pytest.fixture(scope="module")
def curated(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curated"))
    write_curated(fx.curated_trips(spark, sf), path)
    return spark.read.parquet(path)


def exchanges(plan):
    return len(re.findall(r"^\(\d+\) Exchange", plan, re.M))


def test_borough_filter_and_columns_reach_the_scan(curated):
    plan = formatted_plan(borough_hour_profile(curated))
    assert "PushedFilters: [IsNotNull(pickup_borough)]" in plan
    assert "struct<pickup_zone:string,pickup_hour:int,pickup_borough:string>" in plan
    assert formatted_plan(has_borough(curated)).count("Exchange") == 0


def test_date_filter_reaches_the_scan(curated):
    plan = formatted_plan(daily_scores(curated.drop("service_date"), "2024-01-10"))
    assert "GreaterThanOrEqual(pickup_datetime,2024-01-10T00:00)" in plan


def test_date_filter_prunes_partitions(curated):
    plan = formatted_plan(daily_scores(curated, "2024-01-10"))
    assert re.search(r"PartitionFilters: \[.*service_date.* >= 2024-01-10", plan)


def test_counts_combine_before_the_shuffle(curated):
    plan = formatted_plan(zone_hour_dow_counts(curated))
    assert exchanges(plan) == 1 and plan.index("partial_count") < plan.index("Functions [1]: [count(1)]")


def test_top_k_needs_no_full_sort(curated):
    for df in (top_zone_hour_dow(curated), latest_predictions(curated.withColumnRenamed("event_time", "t").withColumn("event_time", F.col("t").cast("string")))):
        plan = formatted_plan(df)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_scores_shuffle_twice(spark, sf):
    assert exchanges(formatted_plan(daily_scores(fx.demand_trips(spark, sf)))) == 2


def test_ranks_are_cut_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 6).cast("string").alias("weather_hour"), F.col("id").cast("string").alias("pickup_zone"), F.rand(1).alias("hotspot_score"))
    assert "WindowGroupLimit" in formatted_plan(top_zones_per_hour(rows, 5))


def test_zone_joins_are_broadcast_and_lose_no_rows_without_it(spark, sf):
    trips = fx.curated_trips(spark, sf).select("event_id", "pickup_zone", "dropoff_zone")
    zones = fx.zones(spark, sf)
    small = enrich_zones(trips, zones)
    assert formatted_plan(small).count("BroadcastHashJoin LeftOuter BuildRight") >= 2
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")
        shuffled = enrich_zones(trips, zones, measure=False)
        assert "SortMergeJoin" in formatted_plan(shuffled) and same_rows(small, shuffled)
    finally:
        spark.conf.set(limit, before)


def test_a_large_baseline_is_joined_by_shuffle(spark, sf):
    scores = daily_scores(fx.demand_trips(spark, sf))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    broadcast = with_threshold(scores, historical_baseline(scores))
    try:
        spark.conf.set(limit, "-1")
        assert "SortMergeJoin" in formatted_plan(with_threshold(scores, historical_baseline(scores)))
        assert same_rows(broadcast, with_threshold(scores, historical_baseline(scores)))
    finally:
        spark.conf.set(limit, before)


@pytest.mark.parametrize("side", ["weather", "baseline"])
def test_stored_sides_leave_the_rows_where_they_are(spark, sf, side):
    """No shuffle above the rows that are joined."""
    if side == "weather":
        trips = fx.predictions(spark, sf).withColumn("weather_hour", F.substring("event_time", 1, 13))
        plan = formatted_plan(fill_weather(trips, stored_weather(spark, sf), {}))
    else:
        plan = formatted_plan(with_threshold(fx.predictions(spark, sf), stored_baseline(spark, sf)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert not re.findall(r"^\(\d+\) Exchange", plan, re.M)


@pytest.mark.parametrize("value", [33.33, 58.33, 14.29])
def test_equal_scores_are_never_alerts(spark, value):
    """Sums of doubles depend on the partitioning in their last digits; the flag must not."""
    keys = [(str(n), n, 1, value) for n in range(5, 14) for _ in range(n)]
    rows = spark.createDataFrame(keys, "pickup_zone string, pickup_hour int, pickup_dow int, hotspot_score double")
    for parts in (1, 3, 8):
        spread = rows.repartition(parts)
        flags = flag_anomaly(spread, historical_baseline(spread)).select("alert_flag").distinct().collect()
        assert [r.alert_flag for r in flags] == ["NORMAL"]


def test_route_progress_stays_inside_the_row(spark, sf):
    plan = formatted_plan(route_progress(fx.routes(spark, sf)))
    assert "Exchange" not in plan and "Generate" not in plan


def test_repeated_rows_have_one_path(spark):
    rows = spark.range(5000).select((F.col("id") % 7 * (F.col("id") % 2)).alias("a"))
    out = repeat_rows(rows.groupBy("a").agg(F.count("*").alias("n")), "n", "i", chunk=400)
    assert out.count() == 5000 and out.distinct().count() == 5000
    assert "Union" not in formatted_plan(out)


def test_partition_settings_give_equal_rows(spark, sf):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    result = bench_partitions(fx.demand_trips(spark, sf).select("pickup_zone", "pickup_hour", "pickup_dow"), (2, 5), 2)
    assert result["outputs_identical"] and set(result["settings"]) == {"2", "5"}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(RuntimeError):
        bench_partitions(fx.demand_trips(spark, sf).filter("pickup_hour < 0"))
