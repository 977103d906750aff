"""Loads of new files only: whatever the split, rows and ids are those of one load."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripspot.operators.clean import with_event_id
from tripspot.plans import incremental
from tripspot.plans.incremental import incremental_etl, listed, with_ids_after

RAW = "tpep_pickup_datetime timestamp_ntz, PULocationID int, DOLocationID int"


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([(i, f"B{i % 2}", f"Zone {i}", "S") for i in range(6)], "LocationID int, Borough string, Zone string, service_zone string")


def trips(spark, rows, given):
    names = ["event_id string, "] if given else []
    df = spark.createDataFrame([r if given else r[1:] for r in rows], "".join([*names, "t string, p int, d int"]))
    time = F.col("t").cast("timestamp_ntz").alias("tpep_pickup_datetime")
    return df.select(*(["event_id"] if given else []), time, F.col("p").alias("PULocationID"), F.col("d").alias("DOLocationID"))


def some_rows(seed, n=400):
    rng = random.Random(seed)
    hot = ("hot", "2024-03-02 10:00:00", 1, 2)
    rows = [(f"e{rng.randrange(n // 2)}", f"2024-03-0{rng.randrange(1, 7)} {rng.randrange(3):02}:00:0{rng.randrange(2)}", rng.choice([None, 1, 2, 9]), rng.randrange(3)) for _ in range(n)]
    return rows + [hot] * 150


def result(spark, folder):
    rows = spark.read.parquet(f"{folder}/out").drop(incremental.LOAD).collect()
    return sorted(tuple(str(r[c]) for c in sorted(r.asDict())) for r in rows)


def load_all(spark, tmp_path, zones, name, parts, given, every=None):
    folder = tmp_path / name
    figures = []
    for i, part in enumerate(parts):
        trips(spark, part, given).coalesce(2).write.parquet(f"{folder}/in/{i}")
        figures.append(incremental_etl(spark, f"{folder}/in", zones, f"{folder}/out", f"{folder}/state"))
    return figures


@pytest.mark.parametrize("given", [True, False])
def test_loads_give_the_rows_of_one_load(spark, tmp_path, zones, given, monkeypatch):
    monkeypatch.setattr(incremental, "COMPACT_EVERY", 2)
    rows, rng = some_rows(4), random.Random(5)
    load_all(spark, tmp_path, zones, "one", [rows], given)
    cut = [rng.randrange(4) for _ in rows]
    parts = [[r for r, c in zip(rows, cut) if c == i] for i in range(4)]
    figures = load_all(spark, tmp_path, zones, "four", parts, given)
    whole = result(spark, tmp_path / "one")
    assert result(spark, tmp_path / "four") == whole and len(whole) > 100
    assert [f["load"] for f in figures] == [0, 1, 2, 3] and given == any(f["replaced_rows"] for f in figures)
    folder = tmp_path / "four"
    before = {p: p.stat().st_mtime_ns for p in folder.rglob("*")}
    assert incremental_etl(spark, f"{folder}/in", zones, f"{folder}/out", f"{folder}/state") is None
    assert {p: p.stat().st_mtime_ns for p in folder.rglob("*")} == before


def test_a_load_rewrites_its_dates_only(spark, tmp_path, zones):
    days = [[(f"{d}-{i}", f"2024-03-0{d} 01:00:00", 1, 2) for i in range(20)] for d in (1, 2, 3)]
    load_all(spark, tmp_path, zones, "x", [days[0] + days[1]], True)
    names = lambda d: {p.name for p in Path(tmp_path / f"x/out/service_date=2024-03-0{d}").glob("*.parquet")}
    before = {d: names(d) for d in (1, 2)}
    trips(spark, [("late", "2024-03-02 05:00:00", 2, 2), *days[2]], True).write.parquet(str(tmp_path / "x/in/1"))
    figures = incremental_etl(spark, f"{tmp_path}/x/in", zones, f"{tmp_path}/x/out", f"{tmp_path}/x/state")
    assert figures["dates"] == 2 and figures["added_rows"] == 21
    assert names(1) == before[1] and not names(2) & before[2] and names(3)


def test_a_trip_that_moves_to_an_earlier_date_leaves_its_old_one(spark, tmp_path, zones):
    load_all(spark, tmp_path, zones, "m", [[("a", "2024-03-05 01:00:00", 1, 2)], [("a", "2024-03-04 01:00:00", 1, 2), ("b", "2024-03-04 01:00:00", 1, 2)]], True)
    rows = spark.read.parquet(f"{tmp_path}/m/out").collect()
    assert sorted((r.event_id, str(r.service_date)) for r in rows) == [("a", "2024-03-04"), ("b", "2024-03-04")]


def test_a_load_that_failed_can_be_repeated(spark, tmp_path, zones, monkeypatch):
    rows = some_rows(6)
    load_all(spark, tmp_path, zones, "one", [rows], False)
    load_all(spark, tmp_path, zones, "two", [rows[:200]], False)
    trips(spark, rows[200:], False).write.parquet(f"{tmp_path}/two/in/1")
    real = incremental.assert_same_count
    monkeypatch.setattr(incremental, "assert_same_count", lambda *_: 1 / 0)  # after the curated rows were written
    with pytest.raises(ZeroDivisionError):
        incremental_etl(spark, f"{tmp_path}/two/in", zones, f"{tmp_path}/two/out", f"{tmp_path}/two/state")
    monkeypatch.setattr(incremental, "assert_same_count", real)
    incremental_etl(spark, f"{tmp_path}/two/in", zones, f"{tmp_path}/two/out", f"{tmp_path}/two/state")
    assert result(spark, tmp_path / "two") == result(spark, tmp_path / "one")


def test_changed_files_stop_the_job(spark, tmp_path, zones):
    load_all(spark, tmp_path, zones, "c", [some_rows(1, 20)], True)
    path = next(Path(tmp_path / "c/in/0").glob("*.parquet"))
    assert listed(spark, f"{tmp_path}/c/in").count() == 2
    path.write_bytes(path.read_bytes() + b" ")
    with pytest.raises(ValueError, match="files changed"):
        incremental_etl(spark, f"{tmp_path}/c/in", zones, f"{tmp_path}/c/out", f"{tmp_path}/c/state")


def test_numbers_go_on_from_the_ledger(spark):
    rows = spark.createDataFrame([("a", 1)] * 3 + [("b", None)], "k string, v int")
    known = with_ids_after(rows, ["k"], None)[1]
    again, totals = with_ids_after(rows, ["k"], known)
    both = sorted(r.event_id for r in with_event_id(rows.union(rows), ["k"]).collect())
    first = [r.event_id for r in with_ids_after(rows, ["k"], None)[0].collect()]
    assert sorted(first + [r.event_id for r in again.collect()]) == both and len(set(both)) == 8
    assert sorted(r.copies for r in totals.collect()) == [2, 6]
