"""Building blocks for rows: repetition, global positions, bounded selections and size-checked broadcast."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tripspot.session import Scratch, scratch_path

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
BINS = 1_000
SLACK = 100_000


def is_small(df: DataFrame, max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES) -> bool:
    """Measure a table: one distributed aggregate, so it is safe on a table that turns out to be large."""
    size = df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def checked_broadcast(df: DataFrame, max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring the side; beyond the bound the join stays a shuffle join.

    Use it for stored dimension tables. Sides computed by the same job are left to adaptive execution, which measures
    them for free.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def repeat_rows(df: DataFrame, times: str, ordinal: str, chunk=100_000) -> DataFrame:
    """Each row `times` times, numbered 1..times. A row is first cut into chunks of its repetitions, which are spread
    over the cluster, so one row that is repeated very often does not become one long task."""
    first = F.col("_chunk") * chunk + 1
    # A given number of partitions is kept as it is; otherwise the few small rows would be merged into one task
    # before they are expanded.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.filter(F.col(times) > 0)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / chunk))))
        .repartition(tasks, *[c for c in df.columns if c != times], "_chunk")
        .withColumn(ordinal, F.explode(F.sequence(first, F.least(F.col(times), first + (chunk - 1)))))
        .drop("_chunk")
    )


def global_index(df: DataFrame, order, name: str, scratch: Scratch | None = None) -> DataFrame:
    """Position 0, 1, 2, ... of each row in the given total order, without a single-task window.

    One range-partitioned sort (equal leading keys are split by the later ones), written to the shared folder so
    that partition borders stay fixed; then the offset of each partition is added. Only the partition sizes, one row
    per partition, are brought together. The written rows are removed with `scratch`, if the caller has one.
    """
    spark = df.sparkSession
    path = scratch.path("index") if scratch else scratch_path(spark, "index")
    df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    # monotonically_increasing_id keeps the partition number above bit 33 and the row number below it.
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_part", part)
        .withColumn("_row", row)
        .join(F.broadcast(offsets), "_part")  # one row per sort partition
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .select(*df.columns, name)
    )


def sort_key(name: str) -> Column:
    """`name` ascending, `-name` descending, nulls as Spark has them (smallest)."""
    return F.desc(name[1:]) if name.startswith("-") else F.asc(name)


def _numbers(df: DataFrame, name: str) -> list[Column] | None:
    """A column as whole numbers that order as its values do. Of several the later ones decide between values that are
    equal in the earlier ones; None stands last where values with equal numbers may still differ."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return [column.cast("long")]
    if isinstance(kind, T.DateType):
        return [F.unix_date(column).cast("long")]
    if isinstance(kind, T.TimestampType):
        return [F.unix_micros(column)]
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.unix_date(F.to_date(column)).cast("long") * 86_400 + F.hour(column) * 3_600 + F.minute(column) * 60
        return [seconds * 1_000_000 + (F.extract(F.lit("SECONDS"), column) * 1_000_000).cast("long")]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        scaled = F.greatest(F.lit(-9e18), F.least(F.lit(9e18), column.cast("double") * 1_048_576))
        return [F.floor(F.when(F.isnan(column), F.lit(9.1e18)).otherwise(scaled)).cast("long"), None]
    if isinstance(kind, T.StringType):
        part = lambda i: F.hex(F.substring(column.cast("binary"), 7 * i + 1, 7))
        return [*[F.conv(F.rpad(part(i), 14, "0"), 16, 10).cast("long") for i in range(4)], None]
    return None


def _levels(df: DataFrame, keys) -> list[Column | None]:
    """All sort keys as whole numbers, ascending; None where no further number can tell rows apart."""
    out = []
    for key in keys:
        name, down = key.lstrip("-"), key.startswith("-")
        numbers = _numbers(df, name)
        if numbers is None:
            return [*out, None]
        if df.schema[name].nullable:
            out.append((F.col(name).isNull() if down else F.col(name).isNotNull()).cast("long"))
        for number in numbers:
            if number is None:
                return [*out, None]
            number = F.coalesce(number, F.lit(0))
            out.append(F.bitwise_not(number) if down else number)
    return out


def _crossing(rows: DataFrame, low: int, high: int, need: int):
    """Of the histogram of the column `at` between two values: the bin that row number `need` falls into, as its rows,
    least and greatest value, and the rows before it. At most BINS + 2 rows reach the driver."""
    width = (high - low) // BINS + 1
    bins = rows.filter(F.col("at").between(low, high)).groupBy(F.expr(f"at div {width}")).agg(
        F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    before = 0
    for row in sorted(bins.collect(), key=lambda r: r["low"]):
        if before + row["n"] >= need:
            return row["n"], row["low"], row["high"], before
        before += row["n"]
    raise RuntimeError("the table changed while it was read")


def bounded_rows(df: DataFrame, keys, n: int, slack=SLACK) -> DataFrame:
    """The rows that may be among the first `n` by the given keys (`name` or `-name`): these n and at most `slack` more,
    as far as the keys tell rows apart.

    The border is found by histograms of the leading key, refined where row n lies, then of the next key among rows
    equal in the first: a few aggregates that read the key columns only and send a thousand rows to the driver. What
    lies beyond the border is filtered where it is read, by a comparison that reaches the scan, and neither sorted nor
    written. A key with a third of all rows is decided by the later keys.
    """
    if n <= 0:
        return df.limit(0)
    equal, sure, border = [], [], None
    for level, at in enumerate(_levels(df, keys)):
        if at is None:
            break
        here = reduce(and_, equal, F.lit(True))
        rows = df.filter(here).select(at.alias("at")) if equal else df.select(at.alias("at"))
        count, low, high = rows.agg(F.count("*"), F.min("at"), F.max("at")).first()
        if count <= n + slack:
            break
        size, need = count, n
        while size > need + slack and low < high:
            size, low, high, before = _crossing(rows, low, high, need)
            need -= before
        border = here & (at <= high)
        if size <= need + slack:
            break
        sure.append(here & (at < low))
        equal.append(at == low)
        n, border = need, None
    if border is None and not equal:
        return df
    last = border if border is not None else reduce(and_, equal)
    kept = df.filter(reduce(or_, [*sure, last]))
    return _pushed(df, keys[0], kept)


def _pushed(df: DataFrame, key: str, kept: DataFrame) -> DataFrame:
    """The same rows, by a plain comparison of the leading key as well, which a scan can use to skip row groups."""
    name, down = key.lstrip("-"), key.startswith("-")
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return kept
    edge, nulls = kept.agg((F.min(name) if down else F.max(name)).alias("edge"), F.count_if(column.isNull()).alias("nulls")).select(
        # Times as text or as a number: a time in Python has a zone of its own.
        F.unix_micros("edge") if isinstance(kind, T.TimestampType) else F.col("edge").cast("string"), "nulls"
    ).first()
    if edge is None:
        return kept
    value = F.timestamp_micros(F.lit(edge)) if isinstance(kind, T.TimestampType) else F.lit(edge).cast(kind)
    plain = column >= value if down else column <= value
    return kept.filter(plain | column.isNull() if nulls else plain)


def top_rows(df: DataFrame, order, n: int, scratch: Scratch | None = None, slack=SLACK) -> DataFrame:
    """The first n rows in the given order.

    With keys by name (`name`, `-name`) all rows beyond a measured border are left out first (`bounded_rows`). What is
    left is range-sorted once; partitions below the border are kept whole, the border partition is cut and the others
    are left out, all by the counts of rows before each partition. No task sees more than its own partition.
    """
    if all(isinstance(key, str) for key in order):
        df, order = bounded_rows(df, order, n, slack), [sort_key(key) for key in order]
    return global_index(df, order, "_place", scratch).filter(F.col("_place") < n).select(*df.columns)


def sample_rows(df: DataFrame, n=100_000, seed=42) -> DataFrame:
    """N rows of the table in no particular order, or all rows if there are fewer.

    A thin random sample (n plus ten standard deviations) is drawn where the rows are, so the single task that
    applies the exact limit receives about n rows and not n rows per partition.
    """
    total = df.count()
    wanted = n + 10 * math.sqrt(n) + 10
    return (df if wanted >= total else df.sample(fraction=wanted / total, seed=seed)).limit(n)
