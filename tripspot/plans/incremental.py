"""The ETL load by load. A load reads new files only and rewrites the dates they touch only."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspot.operators.clean import NULL_MARK, RAW_TIME, clean_trips, normalize_trips, project_trips
from tripspot.operators.enrich import assert_same_count, assert_unique_key, enrich_zones
from tripspot.operators.rows import checked_broadcast, repeat_rows
from tripspot.session import Scratch, remove
from tripspot.sources.sinks import by_service_date
from tripspot.sources.trips import RAW_KEYS, read_trips_files
from tripspot.streaming.sink import compact, dealt_like_store, finished_numbers, latest_view, upsert_batch

FIRST = ("pickup_datetime", "pickup_zone", "dropoff_zone")  # the order that P7 keeps the first of
LOAD = "load_id"
COMPACT_EVERY = 8  # loads after which the ledger is written as one snapshot


def listed(spark: SparkSession, source: str) -> DataFrame:
    """Path, length and modification time of the files below a folder; their contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "[!_.]*")
    return reader.load(source).select("path", "length", "modificationTime")


def new_files(spark: SparkSession, source: str, state: str) -> DataFrame:
    """Files that no finished load has read. One that has changed since stops the job: its old rows are curated."""
    files = listed(spark, source)
    loads = finished_numbers(spark, f"{state}/manifest", "load")
    if not loads:
        return files
    done = spark.read.parquet(*[f"{state}/manifest/load={n}" for n in loads])
    fresh = files.join(done, ["path", "length", "modificationTime"], "left_anti")
    changed = fresh.join(done, "path", "left_semi").limit(5).collect()
    if changed:
        raise ValueError(f"files changed after they were loaded, run the whole ETL: {[r.path for r in changed]}")
    return fresh


def known_records(spark: SparkSession, state: str, key: str, load: int) -> DataFrame | None:
    """The ledger before a load, kept by key in buckets: occurrences of equal rows (P2), or the trip of each id."""
    try:
        return latest_view(spark, f"{state}/ledger", key, ("batch_id",), until=load - 1).drop("batch_id")
    except FileNotFoundError:
        return None


def with_ids_after(df: DataFrame, keys, known: DataFrame | None, dealt=lambda rows, key: rows) -> tuple[DataFrame, DataFrame]:
    """P2 across loads: the rows with their ids, and the new totals of their ledger entries.

    Equal rows are numbered on from the copies that earlier loads have seen, so the ids of all loads together are those
    that one load of all rows makes, however the rows are split.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in (*keys, *[c for c in df.columns if c not in keys])]
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies")).withColumn("row_key", F.sha2(F.concat_ws("|", *texts), 256))
    if known is None:
        counted = counted.withColumn("_seen", F.lit(0).cast("long"))
    else:
        seen = known.select("row_key", F.col("copies").alias("_seen"))
        counted = dealt(counted, "row_key")
        counted = counted.join(seen, "row_key", "left").fillna(0, ["_seen"])
    numbered = repeat_rows(counted, "_copies", "_ordinal").withColumn("_ordinal", F.col("_ordinal") + F.col("_seen"))
    made = numbered.withColumn("event_id", F.sha2(F.concat_ws("|", *texts, "_ordinal"), 256)).select("event_id", *df.columns)
    return made, counted.select("row_key", (F.col("_copies") + F.col("_seen")).alias("copies"))


def first_trips(trips: DataFrame, known: DataFrame | None, dealt=lambda rows, key: rows) -> DataFrame:
    """P7 across loads: de-duplicated trips of a load that are the first of their id so far, with the date of the curated
    trip that each replaces (`replaced`, null for none)."""
    if known is None:
        return trips.withColumn("replaced", F.lit(None).cast("date"))
    old = known.select("event_id", F.struct(*FIRST).alias("_old"), F.col("service_date").alias("replaced"))
    joined = dealt(trips, "event_id").join(old, "event_id", "left")
    return joined.filter(F.col("_old").isNull() | (F.struct(*FIRST) < F.col("_old"))).drop("_old")


def load_files(spark: SparkSession, files: list[str], zones: DataFrame, out: str, state: str, load: int, scratch: Scratch) -> dict:
    """Curate the trips of some files as load number `load` and bring them into the curated table.

    Ledger entries go to a folder of the load, curated rows bear its number: a load that is repeated after a failure
    overwrites the first and leaves out the rows of the second, wherever it was stopped. Its folder in the manifest,
    written last, makes it final. Only folders of touched dates are read and written.
    """
    assert_unique_key(zones, "LocationID")
    raw = read_trips_files(spark, files)
    dealt = functools.partial(dealt_like_store, spark, f"{state}/ledger")
    made_ids = RAW_TIME in raw.columns and "event_id" not in raw.columns
    if made_ids:
        rows, entries = with_ids_after(raw.select(*RAW_KEYS), RAW_KEYS, known_records(spark, state, "row_key", load), dealt)
        key, fresh = "row_key", clean_trips(project_trips(rows), unique_ids=True).withColumn("replaced", F.lit(None).cast("date"))
    else:
        fresh = first_trips(clean_trips(normalize_trips(raw)), known_records(spark, state, "event_id", load), dealt)
        key, entries = "event_id", None
    fresh = scratch.store(fresh.withColumn("service_date", F.to_date("event_time")), "fresh")
    entries = entries if made_ids else fresh.select("event_id", *FIRST, "service_date")
    upsert_batch(f"{state}/ledger")(entries, load)
    if load and load % COMPACT_EVERY == 0:
        compact(spark, f"{state}/ledger", load - 1, key, ("batch_id",))

    replaced = fresh.filter("replaced is not null").select("event_id", F.col("replaced").alias("service_date"))
    dates = fresh.select("service_date").union(replaced.select("service_date")).distinct()
    touched = [r[0] for r in dates.collect()]  # dates only
    rows = enrich_zones(fresh.drop("replaced"), zones).withColumn(LOAD, F.lit(load).cast("long"))
    if load and touched:
        before = spark.read.parquet(out)
        old = before.filter(F.col("service_date").isin(touched) & (F.col(LOAD) < load))
        old = old.join(checked_broadcast(scratch.store(replaced.select("event_id"), "replaced")), "event_id", "left_anti")
        rows = rows.unionByName(old.select(*rows.columns))
    if touched:
        # A date whose only trips moved to another date has no rows left to overwrite its folder with.
        left = {r[0] for r in rows.select("service_date").distinct().collect()} if replaced.head(1) else set(touched)
        writer = by_service_date(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("service_date").parquet(out)
        for date in set(touched) - left:
            remove(spark, f"{out}/service_date={date}")
    added = fresh.count()
    assert_same_count(added, spark.read.parquet(out).filter(F.col(LOAD) == load).count() if touched else 0)
    return {"load": load, "files": len(files), "dates": len(touched), "added_rows": added, "replaced_rows": replaced.count()}


def incremental_etl(spark: SparkSession, source: str, zones: DataFrame, out: str, state: str) -> dict | None:
    """Curate the files below `source` that are new since the last load; does nothing if there are none.

    After any sequence of loads the curated rows and ids are those of one load of all files (and a column with the
    number of the load): equal rows without an id are numbered on, of repeated ids the earliest trip stays. What a load
    costs follows its files and the dates they touch, and one look into the ledger, whose entries lie in buckets of
    their key and are not shuffled again.
    """
    files = new_files(spark, source, state)
    with Scratch(spark, "load") as scratch:
        files = scratch.store(files, "files")
        paths = [r.path for r in files.select("path").collect()]  # names of new files only
        if not paths:
            return None
        load = max(finished_numbers(spark, f"{state}/manifest", "load"), default=-1) + 1
        figures = load_files(spark, paths, zones, out, state, load, scratch)
        files.write.mode("overwrite").parquet(f"{state}/manifest/load={load}")
    return figures
