"""Spark session and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_ZONE = "America/New_York"

# Runtime re-planning does the work that is otherwise guessed before the job starts: it merges small shuffle
# partitions, splits skewed join partitions and turns a join into a broadcast when the measured side is small.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app="tripspot", master=None, time_zone=LOCAL_ZONE, conf=None) -> SparkSession:
    """Session with adaptive execution on; everything else is left to the cluster's own settings."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", time_zone)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir. A temporary folder is used in local mode only."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tripspot-"))
        current = context.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Tables below the shared folder that one job owns: written, read back, and removed by their owner.

    A table is written once and read many times, so a lost executor costs a read and not the work before it. `drop`
    removes what later steps no longer read, `close` (or leaving the `with` block) everything.
    """

    def __init__(self, spark: SparkSession, name="job"):
        self.spark, self.root, self.tables = spark, scratch_path(spark, name), {}

    def path(self, name: str) -> str:
        """A fresh folder of this job."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def store(self, df, name: str):
        """Write a table and read it back with the schema it was written with."""
        path = self.path(name)
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.tables[id(stored)] = (path, stored)
        return stored

    def drop(self, *tables) -> None:
        """Remove stored tables that nothing reads any more."""
        for table in tables:
            remove(self.spark, self.tables.pop(id(table))[0])

    def keep_only(self, *tables) -> None:
        """Remove every stored table but those given, which a result still reads."""
        kept = {id(table) for table in tables}
        self.drop(*[table for key, (_, table) in list(self.tables.items()) if key not in kept])

    def close(self) -> None:
        """Remove all that is left."""
        self.tables.clear()
        remove(self.spark, self.root)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder by the file system it belongs to."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
