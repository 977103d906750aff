"""Hourly weather."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from tripspot.functions.calendar import hour_key, wall_clock
from tripspot.functions.fixed import (
    NUMERIC_WEATHER_FIELDS,
    WEATHER_FALLBACK_SOURCE,
    WEATHER_FIELDS,
    WEATHER_LIVE_SOURCE,
)
from tripspot.functions.labels import weather_label
from tripspot.operators.rows import checked_broadcast


def explode_hourly(df: DataFrame, hourly="hourly", keep=(), position=None) -> DataFrame:
    """a struct of parallel arrays to one row per element. Fields that are absent, NULL or short give NULL.

    `position` names a column for the place in the arrays: an hour may occur twice (the clock goes back in autumn), and
    then `merge_latest` takes the later element.
    """
    present = set(df.schema[hourly].dataType.fieldNames())
    empty = F.array().cast("array<double>")
    arrays = df.select(
        *keep,
        F.coalesce(F.col(f"{hourly}.time"), F.array().cast("array<string>")).alias("time"),
        *[
            F.coalesce(F.col(f"{hourly}.{name}").cast("array<double>"), empty).alias(name)
            if name in present
            else empty.alias(name)
            for name in WEATHER_FIELDS
        ],
    )
    rows = arrays.select(*keep, F.posexplode(F.arrays_zip("time", *WEATHER_FIELDS)).alias("_position", "at"))
    return rows.filter(F.col("at.time").isNotNull()).select(
        *keep,
        F.substring("at.time", 1, 13).alias("weather_hour"),
        *[F.col(f"at.{name}") for name in WEATHER_FIELDS],
        *([F.col("_position").alias(position)] if position else []),
    )


def merge_latest(dfs, key="weather_hour", position=None) -> DataFrame:
    """Union of sources with the same columns; for a key in several sources the last source wins, within a source
    the greatest `position`, a column that the result no longer has."""
    ranked = [df.withColumn("_rank", F.lit(rank)) for rank, df in enumerate(dfs)]
    columns = [c for c in dfs[0].columns if c not in (key, position)]
    order = F.struct("_rank", *([position] if position else []))
    latest = reduce(DataFrame.unionByName, ranked).groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_row"))
    return latest.select(key, "_row.*").select(*[c for c in dfs[0].columns if c != position]).orderBy(key)


def hourly_side(weather: DataFrame) -> DataFrame:
    """A stored weather table as the small side of a join: one row per hour, so that no row is joined twice, and
    broadcast if its measured size allows, so that the other side is not shuffled."""
    rows, hours = weather.agg(F.count("*"), F.count_distinct("weather_hour")).first()
    return checked_broadcast(weather if rows == hours else merge_latest([weather]))


def code_text(col="weather_code"):
    """Weather code as the whole-number text the models are trained on."""
    return F.col(col).cast("int").cast("string")


def join_weather(scores: DataFrame, weather: DataFrame) -> DataFrame:
    """Training rows that have all weather fields."""
    return (
        scores.join(weather, "weather_hour", "inner")
        .dropna(subset=list(WEATHER_FIELDS))
        .withColumn("weather_missing", F.lit(0.0))
        .withColumn("weather_code", code_text())
    )


def fill_weather(df: DataFrame, weather: DataFrame, fallback=None, live_source=WEATHER_LIVE_SOURCE) -> DataFrame:
    """Weather of the hour, gaps filled from the training values; rows with any gap are marked.

    Works on batches and, with a static weather table, on streams. `weather` has one row per hour; `hourly_side` makes
    a stored table such a side, and one that leaves the rows of `df` where they are.
    """
    fallback = fallback or {}
    joined = df.join(weather.select("weather_hour", *WEATHER_FIELDS), "weather_hour", "left")
    missing = reduce(or_, [F.col(name).isNull() for name in WEATHER_FIELDS])
    filled = {name: F.coalesce(F.col(name), F.lit(float(fallback.get(name, 0.0)))) for name in WEATHER_FIELDS}
    return (
        joined.withColumn("_gap", missing)
        .withColumns(filled)
        .withColumn("weather_missing", F.when(F.col("_gap"), 1.0).otherwise(0.0))
        .withColumn("weather_source", F.when(F.col("_gap"), WEATHER_FALLBACK_SOURCE).otherwise(live_source))
        .withColumn("weather_code", code_text())
        .drop("_gap")
    )


def weather_medians(train: DataFrame, err=0.01, exact=False) -> DataFrame:
    """A10: medians of the numeric fields in one row. The approximate form is a mergeable sketch of fixed size; the
    exact form keeps the distinct values of a field, which suits measured fields with few decimals only."""
    if exact:
        return train.agg(*[F.percentile(name, 0.5).alias(name) for name in NUMERIC_WEATHER_FIELDS])
    accuracy = int(round(1 / err))
    return train.agg(*[F.percentile_approx(name, 0.5, accuracy).alias(name) for name in NUMERIC_WEATHER_FIELDS])


def mode_of(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value; of equally frequent ones the smallest as text."""
    counted = df.groupBy(F.col(col).cast("string").alias(col)).agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), F.asc(col)).limit(1)


def fallback_values(train: DataFrame, err=0.01, exact=False) -> dict:
    """The six values J3 falls back to. Only these numbers reach the driver."""
    medians = weather_medians(train, err, exact).first()
    mode = mode_of(train, "weather_code").first()
    values = {name: float(medians[name]) for name in NUMERIC_WEATHER_FIELDS if medians[name] is not None}
    if mode is not None and mode["weather_code"] is not None:
        values["weather_code"] = float(mode["weather_code"])
    return values


def coverage(scores: DataFrame, weather: DataFrame) -> DataFrame:
    """Share of score rows that have all weather fields, in one pass over the scores."""
    complete = weather.dropna(subset=list(WEATHER_FIELDS)).select("weather_hour", F.lit(1).alias("_covered"))
    counts = scores.join(complete, "weather_hour", "left").agg(
        F.count("*").alias("eligible_rows"), F.count("_covered").alias("covered_rows")
    )
    return counts.withColumn("coverage", F.col("covered_rows") / F.greatest(F.col("eligible_rows"), F.lit(1)))


def assert_coverage(scores: DataFrame, weather: DataFrame, minimum=0.95):
    """A15 as a guard; returns the measured row."""
    row = coverage(scores, weather).first()
    if row["coverage"] < minimum:
        raise RuntimeError(f"weather covers only {row['coverage']:.1%} of the rows, at least {minimum:.0%} needed")
    return row


def local_hours(spark, first, count: int) -> DataFrame:
    """`count` whole hours from the hour of `first` (a wall-clock datetime) on."""
    start = wall_clock(first.replace(minute=0, second=0, microsecond=0))
    return spark.range(count).select(
        F.col("id").cast("int").alias("offset"),
        (start + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("hour_start"),
    )


def weather_outlook(now, weather: DataFrame, fallback=None, periods=4, lang="vi") -> DataFrame:
    """The current hour and the next ones with filled weather, description and clock label.

    The hours are known when the plan is made, so the weather table is filtered by constants at the scan.
    """
    hours = local_hours(weather.sparkSession, now, periods).withColumn("weather_hour", hour_key("hour_start"))
    first = now.replace(minute=0, second=0, microsecond=0, tzinfo=None)
    keys = [(first + timedelta(hours=i)).strftime("%Y-%m-%dT%H") for i in range(periods)]
    filled = fill_weather(hours, weather.filter(F.col("weather_hour").isin(keys)), fallback)
    clock = F.concat(F.lpad(F.hour("hour_start").cast("string"), 2, "0"), F.lit(":00"))
    current = {"vi": "Hiện tại · ", "en": "now · "}[lang]
    return (
        filled.withColumn("description", weather_label("weather_code", lang))
        .withColumn("label", F.when(F.col("offset") == 0, F.concat(F.lit(current), clock)).otherwise(clock))
        .orderBy("offset")
    )
