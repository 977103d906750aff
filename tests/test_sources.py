"""Readers, writers and the ETL job."""

import json
import re

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripspot import fixtures as fx
from tripspot.functions.calendar import iso_seconds
from tripspot.operators.clean import clean_trips, normalize_trips
from tripspot.operators.demand import raw_zone_hours, zone_hour_counts
from tripspot.operators.verify import crosscheck_zone_hour, same_rows
from tripspot.plans.etl import etl_job, run_etl
from tripspot.plans.reports import formatted_plan, register_views, run_sql, save_reports
from tripspot.sources.kafka import kafka_options, to_kafka_value
from tripspot.sources.sinks import is_done, write_clustered, write_curated, write_zone_hour_csv, write_zone_hour_tsv
from tripspot.sources.trips import bounded_source, read_trips, read_trips_any, read_trips_csv, read_zone_hour_tsv
from tripspot.sources.weather import read_weather_json
from tripspot.sources.zones import read_zone_lookup, zones_from_geojson

LOOKUP = "LocationID,Borough,Zone,service_zone\n1,North,Zone One,Yellow\n2,South,Zone Two,Green\n"


@pytest.fixture
def csv_trips(tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text(
        "event_id,VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,PULocationID,DOLocationID\n"
        "t0,1,2024-05-01T07:10:00,2024-05-01T07:20:00,1,2\n"
        "t1,2,never,2024-05-01T08:20:00,2,1\n"
        "t2,2,2024-05-01T08:10:00,2024-05-01T08:20:00,9,1\n"
    )
    return str(path)


def test_csv_types_are_declared(spark, csv_trips):
    df = read_trips_csv(spark, csv_trips)
    assert dict(df.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz" and dict(df.dtypes)["PULocationID"] == "int"
    assert [r.event_id for r in clean_trips(normalize_trips(df)).orderBy("event_id").collect()] == ["t0", "t2"]


def test_normalised_csv_layout(spark, tmp_path):
    (tmp_path / "n.csv").write_text("event_id,pickup_datetime,pickup_zone,dropoff_zone\nx,2024-05-01 07:10:00, 4 ,5\n")
    row = clean_trips(normalize_trips(read_trips_csv(spark, str(tmp_path / "n.csv")))).first()
    assert (row.event_id, row.pickup_zone, row.pickup_hour) == ("x", "4", 7)


def test_fallback_only_for_a_missing_source(spark, csv_trips, tmp_path):
    assert read_trips_any(spark, str(tmp_path / "absent"), csv_trips).count() == 3
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("this is not a table")
    with pytest.raises(Exception) as error:
        read_trips_any(spark, str(tmp_path / "broken"), csv_trips).count()
    assert not isinstance(error.value, AnalysisException) or error.value.getCondition() != "PATH_NOT_FOUND"


def test_scan_reads_only_named_columns(spark, sf):
    plan = formatted_plan(read_trips(spark, f"{sf}/events.parquet", columns=["event_id", "ts"]))
    assert "struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_bounded_source(spark):
    rows = spark.createDataFrame([(1, 5), (None, 5), (2, None), (3, 5)], "PULocationID int, DOLocationID int")
    assert bounded_source(rows).count() == 2
    assert [r.PULocationID for r in bounded_source(rows, 1, order=[F.desc("PULocationID")]).collect()] == [3]


def test_tsv_round_trip_and_crosscheck(spark, sf, tmp_path):
    trips = clean_trips(normalize_trips(fx.raw_trips(spark, sf)))
    path = str(tmp_path / "kv")
    write_zone_hour_tsv(trips, path)
    records = read_zone_hour_tsv(spark, path)
    assert records.count() == trips.count()
    assert crosscheck_zone_hour(trips, records).isEmpty()
    assert not crosscheck_zone_hour(trips.limit(10), records).isEmpty()


def test_sorted_csv(spark, tmp_path):
    counts = spark.createDataFrame([("b", 1, 5), ("a", 9, 1), ("a", 2, 3)], "pickup_zone string, pickup_hour int, trip_count long")
    write_zone_hour_csv(counts, str(tmp_path / "out"))
    lines = [line for part in sorted((tmp_path / "out").glob("part-*")) for line in part.read_text().split()]
    assert [line for line in lines if not line.startswith("pickup")] == ["a,2,3", "a,9,1", "b,1,5"]


def test_guard_needs_the_success_marker(spark, tmp_path):
    path = tmp_path / "out"
    rows = spark.range(3).withColumn("event_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    path.mkdir()
    assert not is_done(spark, str(path)) and not is_done(spark, str(tmp_path / "never"))
    assert write_curated(rows, str(path), mode="ignore")
    assert is_done(spark, str(path)) and not write_curated(rows.limit(1), str(path), mode="ignore")
    assert spark.read.parquet(str(path)).count() == 3
    assert write_curated(rows.limit(1), str(path), mode="ignore", force=True)
    assert spark.read.parquet(str(path)).count() == 1


def test_curated_dates_are_pruned(spark, sf, tmp_path):
    path = str(tmp_path / "curated")
    write_curated(fx.curated_trips(spark, sf), path)
    plan = formatted_plan(spark.read.parquet(path).filter("service_date >= date'2024-01-20'"))
    assert "PartitionFilters: [isnotnull(service_date" in plan


def test_etl_job(spark, csv_trips, tmp_path):
    (tmp_path / "zones.csv").write_text(LOOKUP)
    job = (spark, str(tmp_path / "absent"), csv_trips, str(tmp_path / "zones.csv"), str(tmp_path / "out"))
    figures = etl_job(*job)
    assert figures.pop("raw_rows") - figures.pop("dropped_rows") == 2
    assert figures == {"before_enrichment": 2, "after_enrichment": 2, "unmatched_pickup": 1, "unmatched_dropoff": 0}
    assert etl_job(*job) is None
    assert etl_job(*job, force=True)["after_enrichment"] == 2
    assert {r.pickup_zone_name for r in spark.read.parquet(job[-1]).collect()} == {"Zone One", None}


def test_etl_refuses_repeated_zones(spark, csv_trips, tmp_path):
    (tmp_path / "zones.csv").write_text(LOOKUP + "2,South,Again,Green\n")
    with pytest.raises(ValueError):
        run_etl(spark, read_trips_csv(spark, csv_trips), read_zone_lookup(spark, str(tmp_path / "zones.csv")), str(tmp_path / "o"))


def test_weather_documents_later_wins(spark, tmp_path):
    def document(name, hours, temperature):
        text = json.dumps({"hourly": {"time": hours, "temperature_2m": temperature, "weather_code": [3] * len(hours)}}, indent=1)
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    first = document("2023.json", ["2023-12-31T22:00", "2023-12-31T23:00"], [1.0, 2.0])
    second = document("2024.json", ["2023-12-31T23:00", "2024-01-01T00:00"], [5.0, None])
    rows = read_weather_json(spark, first, second).collect()
    assert [(r.weather_hour, r.temperature_2m) for r in rows] == [("2023-12-31T22", 1.0), ("2023-12-31T23", 5.0), ("2024-01-01T00", None)]
    assert all(r.snowfall is None and r.weather_code == 3.0 for r in rows)


def test_lookup_columns_go_by_their_header(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("Zone,LocationID,service_zone,Borough\nAirport,1,EWR,Queens\n")
    assert read_zone_lookup(spark, str(tmp_path / "zones.csv")).first().asDict() == {
        "LocationID": 1, "Borough": "Queens", "Zone": "Airport", "service_zone": "EWR"
    }


def test_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "trips").mkdir()
    (tmp_path / "trips/a.csv").write_text("tpep_pickup_datetime,PULocationID,DOLocationID\n2024-01-01 00:00:00,1,2\n")
    (tmp_path / "trips/b.csv").write_text("tpep_pickup_datetime,DOLocationID,PULocationID\n2024-01-01 00:00:00,2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_trips_csv(spark, str(tmp_path / "trips")).collect()


def test_raw_zone_hours_count_repeated_rows(spark):
    rows = [("e", "2024-01-01 07:00:00", 1), ("e", "2024-01-01 07:00:00", 1), ("f", None, 1), ("g", "2024-01-01 08:00:00", None)]
    raw = spark.createDataFrame(rows, "event_id string, tpep_pickup_datetime string, PULocationID int")
    counted = zone_hour_counts(raw_zone_hours(raw))
    assert [tuple(r) for r in counted.collect()] == [("1", 7, 2)]
    assert len(re.findall(r"^\(\d+\) Exchange", formatted_plan(zone_hour_counts(raw_zone_hours(raw))), re.M)) <= 1


def test_geojson_zones(spark, tmp_path):
    features = [{"type": "Feature", "properties": {"LocationID": i}} for i in (10, 9, 10, 100)]
    (tmp_path / "z.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=2))
    assert [r.pickup_zone for r in zones_from_geojson(spark, str(tmp_path / "z.geojson")).collect()] == ["9", "10", "100"]
    seen = spark.createDataFrame([("7",), ("x",), ("7",)], "pickup_zone string")
    assert [r.pickup_zone for r in zones_from_geojson(spark, str(tmp_path / "none"), seen).collect()] == ["7", "x"]
    with pytest.raises(AnalysisException):
        zones_from_geojson(spark, str(tmp_path / "none"))


def test_kafka_records(spark):
    rows = spark.createDataFrame([("a", None, 1.5)], "k string, z string, v double")
    out = to_kafka_value(rows, key="k").first()
    assert out.key == "a" and json.loads(out.value) == {"k": "a", "z": None, "v": 1.5}
    options = kafka_options("host:1", "trips", max_per_trigger=5)
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "5"


def test_reports_and_plans(spark, sf, tmp_path):
    trips = fx.curated_trips(spark, sf)
    save_reports(spark, trips, str(tmp_path / "reports"))
    stored = spark.read.json(str(tmp_path / "reports" / "top_zone_hour_dow" / "rows"))
    assert stored.count() == 20
    plan = spark.read.json(str(tmp_path / "reports" / "borough_hour_profile" / "plan")).first()
    assert "AdaptiveSparkPlan" in plan["plan"] and "curated_trips" in plan["sql"]
    register_views(spark, trips)
    from tripspot.operators.demand import borough_hour_profile

    assert same_rows(run_sql(spark, "borough_hour_profile"), borough_hour_profile(trips))


def test_clustered_records_are_skipped_by_zone_and_day(spark, tmp_path):
    i = F.col("id")
    start = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(i * 7919 % 43_200).cast("int"))
    zone = F.when(i % 3 == 0, "7").when(i % 1000 == 1, "airport").otherwise((i % 264).cast("string"))
    rows = spark.range(120_000, numPartitions=6).select(zone.alias("pickup_zone"), iso_seconds(start).alias("event_time"), i)
    write_clustered(rows, str(tmp_path / "c"), rows_per_file=1000)
    files = list((tmp_path / "c").glob("*.parquet"))
    touched = total = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(2)}
            inside = lambda c, low, high: stats[c].min <= high and stats[c].max >= low
            total += 1
            touched += inside("pickup_zone", "150", "150") and inside("event_time", "2024-01-09", "2024-01-09T99")
    assert total >= 120 and touched <= 0.1 * total  # a table in another order touches a fifth to all of them
    stored = spark.read.parquet(str(tmp_path / "c"))
    assert same_rows(stored, rows)
    plan = formatted_plan(stored.filter((F.col("pickup_zone") == "150") & F.col("event_time").between("2024-01-09", "2024-01-09T99")))
    assert "EqualTo(pickup_zone,150)" in plan and "GreaterThanOrEqual(event_time,2024-01-09)" in plan


def test_clustering_bears_nulls_and_nothing(spark, tmp_path):
    odd = spark.createDataFrame([(None, None), ("x", "soon"), ("3", "2024-01-01T00:00:00")], "pickup_zone string, event_time string")
    write_clustered(odd, str(tmp_path / "odd"))
    assert same_rows(spark.read.parquet(str(tmp_path / "odd")), odd)
    write_clustered(odd.limit(0), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
