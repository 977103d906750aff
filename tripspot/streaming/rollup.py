"""Rollups of the keyed store that are kept up to date batch by batch.

A batch adds signed sums: its new records count once, the records they replace are taken back. So the rollup of all
batches is that of the current records, and reports read no records. Every record has a score, a zone and a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripspot.functions.fixed import SCORE_PLACES
from tripspot.operators.fleet import latest_state
from tripspot.session import remove
from tripspot.streaming.sink import batch_records, dealt_like_store, finished_numbers, latest_view, snapshot_table, upsert_batch

KEY, ORDER = "event_id", ("batch_id", "event_time")
# What a rollup is kept by: zone and hour for means, zone and time for the newest time of a record that still counts.
LEVELS = {"hours": ("pickup_zone", "bucket"), "times": ("pickup_zone", "event_time")}
TOTAL = f"decimal(38, {SCORE_PLACES})"


def changes(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What a batch changes: each record that becomes current with `sign` 1, and the one that it replaces with -1.

    The view before the batch is joined to the batch's keys bucket by bucket, so only the batch is shuffled. It depends
    on earlier batches alone: a repeated batch gives the same changes.
    """
    rows = batch_records(spark, path, batch_id - 1, batch_id)
    if rows is None:
        return None
    new = dealt_like_store(spark, path, latest_state(rows.filter(F.col(KEY).isNotNull()), KEY, ORDER), KEY)
    columns = ("pickup_zone", "event_time", "hotspot_score", "batch_id")
    try:
        old = latest_view(spark, path, KEY, ORDER, until=batch_id - 1)
    except FileNotFoundError:
        return new.select(F.lit(1).alias("sign"), *columns)
    sides = [df.select(KEY, *[F.col(c).alias(f"{side}_{c}") for c in columns]) for side, df in (("new", new), ("old", old))]
    joined = sides[0].join(sides[1].withColumn("replaced", F.lit(True)), KEY, "left")
    # Only signs are listed: lists of the rows themselves cost more than the join.
    signs = F.when(F.col("replaced"), F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))
    signed = joined.withColumn("sign", F.explode(signs))
    return signed.select("sign", *[F.when(F.col("sign") == 1, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in columns])


def update_rollups(spark: SparkSession, path: str, batch_id: int) -> None:
    """Write the signed sums of a batch, one folder per level; an earlier attempt's are replaced. Scores are summed as
    decimals, so that what was added can be taken back without a rest.

    The changes are worked out once: their sums by zone and time, which every level is made from, are written first, and
    removed when the levels are there.
    """
    rows, staged = changes(spark, path, batch_id), f"{path}/rollups/staged/batch_id={batch_id}"
    if rows is not None:
        score = F.col("hotspot_score").cast(f"decimal(30, {SCORE_PLACES})") * F.col("sign")
        sums = rows.groupBy("pickup_zone", "event_time").agg(F.sum("sign").alias("n"), F.sum(score).cast(TOTAL).alias("total"))
        sums.write.mode("overwrite").parquet(staged)
        sums = spark.read.schema(sums.schema).parquet(staged).withColumn("bucket", F.substring("event_time", 1, 13))
    for level, by in LEVELS.items():
        folder = f"{path}/rollups/{level}/batch_id={batch_id}"
        if rows is None:
            remove(spark, folder)
            continue
        own = sums.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").cast(TOTAL).alias("total"))
        own.filter("n <> 0 or total <> 0").sort(*reversed(by)).write.mode("overwrite").parquet(folder)
    remove(spark, staged)


def rollup_sink(path: str, counters=None):
    """A foreachBatch function: the keyed store's, then the rollups of the batch."""
    write = upsert_batch(path, counters)

    def store(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        update_rollups(batch.sparkSession, path, batch_id)

    return store


def rollup_until(spark: SparkSession, path: str, level: str, until=None) -> DataFrame:
    """The signed sums of the newest rollup snapshot and of the batches after it, up to batch `until`."""
    root, by = f"{path}/rollups/{level}", LEVELS[level]
    upto = max(finished_numbers(spark, root, "upto"), default=-1)
    numbers = finished_numbers(spark, root, "batch_id")
    folders = [f"{root}/batch_id={n}" for n in numbers if n > upto and (until is None or n <= until)]
    folders += [f"{root}/upto={upto}"] if upto >= 0 else []
    if not folders:
        raise FileNotFoundError(f"no rollups at {path}")
    parts = spark.read.schema(f"{by[0]} string, {by[1]} string, n long, total {TOTAL}").parquet(*folders)
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").cast(TOTAL).alias("total")).filter("n <> 0 or total <> 0")


def rollup(spark: SparkSession, path: str, level: str) -> DataFrame:
    """The sums of all current records."""
    return rollup_until(spark, path, level).filter("n > 0")


def compact_rollups(spark: SparkSession, path: str) -> None:
    """Write the sums up to the last batch but one (the last may be repeated) as one snapshot per level and remove the
    batches it holds."""
    for level in LEVELS:
        root = f"{path}/rollups/{level}"
        batches = finished_numbers(spark, root, "batch_id")
        done = finished_numbers(spark, root, "upto")
        if len(batches) < 2:
            continue
        until, newest = batches[-2], batches[-1]
        own = rollup_until(spark, path, level, until)
        own.sort(*reversed(LEVELS[level])).write.mode("overwrite").parquet(f"{root}/upto={until}")
        for n in batches:
            if n < newest:
                remove(spark, f"{root}/batch_id={n}")
        for n in done:
            remove(spark, f"{root}/upto={n}")


def _mean(places=None):
    mean = F.sum("total").cast("double") / F.sum("n")
    return F.round(mean, places) if places else mean


def ranking_of(hours: DataFrame, n=10) -> DataFrame:
    """A16 from the hours rollup."""
    means = hours.groupBy("pickup_zone").agg(_mean(9).alias("hotspot_score"), F.sum("n").alias("sample_count"))
    return means.orderBy(F.desc("hotspot_score"), F.asc("pickup_zone")).limit(n)


def series_of(hours: DataFrame, n=24) -> DataFrame:
    """A17 from the hours rollup."""
    return hours.groupBy("bucket").agg(_mean().alias("value")).orderBy(F.desc("bucket")).limit(n).orderBy("bucket")


def summary_of(spark: SparkSession, path: str, zone=None) -> DataFrame:
    """A18 from rollups: records, distinct zones, and the newest time, which is looked for in the newest hour only."""
    hours, times = (rollup(spark, path, level) for level in ("hours", "times"))
    if zone:
        hours, times = (df.filter(F.col("pickup_zone") == zone) for df in (hours, times))
    newest = hours.agg(F.max("bucket")).first()[0]
    latest = times.filter(F.col("event_time") >= F.lit(newest)).agg(F.max("event_time").alias("latest"))
    zones = hours.groupBy("pickup_zone").agg(F.sum("n").alias("n"))
    counts = zones.agg(F.sum("n").alias("count"), F.count("pickup_zone").alias("zones"), F.lit(None).cast("string").alias("latest"))
    rows = counts.unionByName(latest.select(F.lit(0).cast("long").alias("count"), F.lit(0).cast("long").alias("zones"), "latest"))
    return rows.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"), F.sum("zones").alias("zones"), F.max("latest").alias("latest"))


def newest_records(spark: SparkSession, path: str, n=30, zone=None) -> DataFrame:
    """The newest current records. The times rollup says from which time on there are `n`; only records since then
    are read from the snapshot, by a filter that reaches its scan, and the batches after it."""
    times = rollup(spark, path, "times")
    times = times.filter(F.col("pickup_zone") == zone) if zone else times
    newest = times.groupBy("event_time").agg(F.sum("n").alias("n")).orderBy(F.desc("event_time")).limit(n).collect()
    since = F.col("event_time") >= (newest[-1]["event_time"] if newest else "")
    upto = max(finished_numbers(spark, f"{path}/snapshots", "upto"), default=-1)
    snapshot, recent = snapshot_table(spark, path, KEY, upto), batch_records(spark, path, upto)
    recent = None if recent is None else latest_state(recent.filter(F.col(KEY).isNotNull()), KEY, ORDER)
    if snapshot is None or recent is None:
        rows = (recent if snapshot is None else snapshot).filter(since)
    else:  # a later batch replaces a record of the snapshot whatever its time is
        kept = snapshot.filter(since).join(recent.select(KEY), KEY, "left_anti")
        rows = kept.unionByName(recent.select(*snapshot.columns).filter(since))
    rows = rows.filter(F.col("pickup_zone") == zone) if zone else rows
    return rows.orderBy(F.desc("event_time"), F.asc(KEY)).limit(n)


def overview_of(spark: SparkSession, path: str, zone=None) -> dict:
    """D2 from rollups: the results of `serving.overview` without reading the stored records, but for the newest ones."""
    hours = rollup(spark, path, "hours")
    hours = hours.filter(F.col("pickup_zone") == zone) if zone else hours
    return {
        "summary": summary_of(spark, path, zone),
        "ranking": ranking_of(hours, 10).select("pickup_zone", "hotspot_score"),
        "series": series_of(hours, 24),
        "predictions": newest_records(spark, path, 30, zone),
    }
