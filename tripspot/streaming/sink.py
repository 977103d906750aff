"""Replay-safe keyed store on plain Parquet."""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tripspot.operators.fleet import latest_state
from tripspot.session import remove

MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def _read(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.option("basePath", root).parquet(root)
    except AnalysisException as error:
        if error.getCondition() not in MISSING:
            raise
        return None


def prediction_counters() -> list:
    """Figures of a batch of predictions."""
    return [
        F.count("*").alias("records"),
        F.count_if(F.col("alert_flag") == "CRITICAL_ANOMALY").alias("alerts"),
        F.count_if(F.col("weather_missing") > 0).alias("weather_missing_rows"),
    ]


def upsert_batch(path: str, counters=None):
    """A foreachBatch function. A batch goes to its own folder and replaces what an earlier attempt of the same
    batch left there, so a repeated batch changes nothing. Empty batches leave nothing.

    `counters` are aggregates observed during that one write and kept per batch (A23). The rows are never looked at
    before they are written: that would run the source, the joins and any state update twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"batch_id={batch_id}"
        observation = Observation(folder)
        rows = batch.observe(observation, F.count("*").alias("_rows"), *(counters or []))
        rows.write.mode("overwrite").parquet(f"{path}/batches/{folder}")
        figures = observation.get
        if not figures.pop("_rows"):
            remove(spark, f"{path}/batches/{folder}")
        elif figures:
            schema = ", ".join(f"{name} long" for name in figures)
            row = spark.createDataFrame([tuple(figures.values())], schema).coalesce(1)
            row.write.mode("overwrite").parquet(f"{path}/counters/{folder}")

    return write


def batch_counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters of all batches."""
    return spark.read.parquet(f"{path}/counters").withColumn("batch_id", F.col("batch_id").cast("long"))


def finished_numbers(spark: SparkSession, root: str, name: str, finished=True) -> list[int]:
    """The numbers of the folders `name=<number>` below a root, in order: of the finished ones, or of all."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = [status.getPath().getName() for status in system.listStatus(target) if status.isDirectory()]
    return sorted(
        int(n.partition("=")[2])
        for n in names
        if n.startswith(f"{name}=") and (not finished or system.exists(path(f"{root}/{n}/_SUCCESS")))
    )


def _finished_at(spark: SparkSession, folder: str) -> float:
    """When a folder was finished, in seconds."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    system = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getFileStatus(marker).getModificationTime() / 1000


def _slices(spark: SparkSession, path: str, until: int) -> dict[int, int]:
    """The newest finished snapshot up to `until` that holds each slice."""
    out = {}
    for number in finished_numbers(spark, f"{path}/snapshots", "upto"):
        if number <= until:
            out |= dict.fromkeys(finished_numbers(spark, f"{path}/snapshots/upto={number}", "slice", finished=False), number)
    return out


def _layout(spark: SparkSession, path: str, key: str, buckets=None, slices=None) -> tuple[int, int]:
    """Buckets and slices of a store: fixed by its first snapshot, kept beside it."""
    stored = _read(spark, f"{path}/layout")
    if stored is None:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        row = spark.createDataFrame([(key, buckets, slices)], "key string, buckets int, slices int").coalesce(1)
        row.write.mode("overwrite").parquet(f"{path}/layout")
        return buckets, slices
    row = stored.first()
    if row["key"] != key:
        raise ValueError(f"the store at {path} is kept by {row['key']}, not by {key}")
    return row["buckets"], row["slices"]


def dealt_like_store(spark: SparkSession, path: str, rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by their key as the snapshots of a store are, so that a join with its view leaves these where they
    lie. Without a snapshot the rows stay as they are."""
    return rows.repartition(_layout(spark, path, key)[0], key) if finished_numbers(spark, f"{path}/snapshots", "upto") else rows


def _table_name(path: str) -> str:
    return f"keyed_store_{hashlib.md5(path.encode()).hexdigest()}"


def snapshot_table(spark: SparkSession, path: str, key: str, until: int, only=None) -> DataFrame | None:
    """The snapshot as a table that Spark knows to be bucketed by its key, or None where there is none.

    It is an external table over the folders of its slices, under a name made from them: what a name stands for never
    changes, and dropping it removes no files. `only` leaves out all other slices.
    """
    folders = {k: n for k, n in sorted(_slices(spark, path, until).items()) if only is None or k in only}
    if not folders:
        return None
    buckets, _ = _layout(spark, path, key)
    places = {k: f"{path}/snapshots/upto={n}/slice={k}" for k, n in folders.items()}
    name = _table_name("\n".join([path, *places.values()]))
    if not spark.catalog.tableExists(name):
        fields = spark.read.parquet(next(reversed(places.values()))).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        location = f"{path}/snapshots".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}, slice INT) USING parquet PARTITIONED BY (slice) "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        parts = " ".join(f"PARTITION (slice={k}) LOCATION '{place}'".replace("\\", "\\\\") for k, place in places.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    return spark.table(name).drop("slice")


def batch_records(spark: SparkSession, path: str, after: int, until=None) -> DataFrame | None:
    """The records of the finished batches after `after`; folders of other batches are not listed."""
    numbers = [n for n in finished_numbers(spark, f"{path}/batches", "batch_id") if n > after and (until is None or n <= until)]
    if not numbers:
        return None
    rows = spark.read.option("basePath", f"{path}/batches").parquet(*[f"{path}/batches/batch_id={n}" for n in numbers])
    return rows.withColumn("batch_id", F.col("batch_id").cast("long"))


def _merged(snapshot: DataFrame, recent: DataFrame, key: str, order, buckets: int) -> DataFrame:
    """One record per key of two tables that hold one each: that with the greater order values.

    A full join by the key: the snapshot is read as it lies in its buckets, only the recent records, one per key, are
    dealt out to as many. Both sides have a key once, so no key is hot.
    """
    recent = recent.select(*snapshot.columns).repartition(buckets, key)
    rest = [c for c in snapshot.columns if c != key]
    packed = F.struct(F.struct(*order).alias("at"), F.struct(*rest).alias("row"))
    joined = snapshot.select(key, packed.alias("old")).join(recent.select(key, packed.alias("new")), key, "full")
    newer = F.col("old").isNull() | (F.col("new.at") >= F.col("old.at"))
    return joined.select(key, F.when(F.col("new").isNotNull() & newer, F.col("new.row")).otherwise(F.col("old.row")).alias("row")).select(
        *[F.col(c) if c == key else F.col(f"row.{c}") for c in snapshot.columns]
    )


def latest_view(spark: SparkSession, path: str, key="event_id", order=("batch_id", "event_time"), until=None) -> DataFrame:
    """The current record of each key, or that after batch `until`: the one with the greatest order values.

    The newest fitting snapshot holds one record per key in buckets and is not shuffled again: the records of later
    batches are reduced to one per key and joined to it bucket by bucket. Without later batches it is passed on as it
    is. Records need a key.
    """
    finished = [n for n in finished_numbers(spark, f"{path}/snapshots", "upto") if until is None or n <= until]
    upto = finished[-1] if finished else -1
    snapshot, recent = snapshot_table(spark, path, key, upto), batch_records(spark, path, upto, until)
    if snapshot is None and recent is None:
        raise FileNotFoundError(f"nothing stored at {path}")
    if recent is None:
        return snapshot
    newest = latest_state(recent.filter(F.col(key).isNotNull()), key, order)
    return newest if snapshot is None else _merged(snapshot, newest, key, order, _layout(spark, path, key)[0])


def compact(
    spark: SparkSession, path: str, until=None, key="event_id", order=("batch_id", "event_time"), buckets=None, slices=16
):
    """Write the view up to a batch as a snapshot, so that readers need not open one folder per batch for ever; returns
    the last batch that a snapshot covers.

    `until` defaults to the last batch but one: the last may still be repeated. A finished snapshot is never written
    again, an unfinished one is not read, so the call can be repeated at any time.

    A snapshot is bucketed by its key (`buckets`, by default the shuffle partitions of the first call) and cut into
    `slices` by another hash of it. Only slices that later batches touch are read, merged and written; the others stay
    where they are and are read from there.
    """
    if until is None:
        until = max([-1, *finished_numbers(spark, f"{path}/batches", "batch_id")[:-1]])
    done = finished_numbers(spark, f"{path}/snapshots", "upto")
    if until < 0 or until in done:
        return max(done, default=None)
    before = max([n for n in done if n < until], default=-1)
    recent = batch_records(spark, path, before, until)
    if recent is None:
        return max(done, default=None)
    buckets, slices = _layout(spark, path, key, buckets, slices)
    part = F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")
    recent = recent.filter(F.col(key).isNotNull())
    touched = {r[0] for r in recent.select(part).distinct().collect()}  # at most `slices` numbers
    snapshot, newest = snapshot_table(spark, path, key, before, touched), latest_state(recent, key, order)
    rows = newest.repartition(buckets, key) if snapshot is None else _merged(snapshot, newest, key, order, buckets)
    name, folder = _table_name(f"{path}/{until}/{uuid.uuid4().hex}"), f"{path}/snapshots/upto={until}"
    remove(spark, folder)
    writer = rows.withColumn("slice", part).write.mode("overwrite").option("path", folder)
    writer.partitionBy("slice").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    return until


def retain(spark: SparkSession, path: str, snapshots=2, age_s=0) -> None:
    """Keep the newest `snapshots` snapshots and the batches after the oldest of them; remove what they replace, slice by
    slice. Views as of an earlier batch are gone after that. Counters of batches are small and stay.

    Nothing goes before the oldest snapshot to keep has been finished for `age_s` seconds: a reader that began earlier
    may still read what it replaces.
    """
    done = finished_numbers(spark, f"{path}/snapshots", "upto")
    if len(done) < snapshots:
        return
    oldest = done[-snapshots]
    if time.time() - _finished_at(spark, f"{path}/snapshots/upto={oldest}") < age_s:
        return
    needed = _slices(spark, path, oldest)
    for number in done[:-snapshots]:
        held = finished_numbers(spark, f"{path}/snapshots/upto={number}", "slice", finished=False)
        kept = [k for k in held if needed[k] == number]
        for k in held if kept else []:
            if k not in kept:
                remove(spark, f"{path}/snapshots/upto={number}/slice={k}")
        if not kept:
            remove(spark, f"{path}/snapshots/upto={number}")
    for number in finished_numbers(spark, f"{path}/batches", "batch_id"):
        if number <= oldest:
            remove(spark, f"{path}/batches/batch_id={number}")
