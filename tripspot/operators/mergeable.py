"""A9-A11 from daily parts that are kept and merged: moments, quantile sketches and value counts.

A part is one row per key and date. The training window moves by adding the parts of new dates; older trips are not
read again. Parts of a date that is computed anew replace its old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.functions.fixed import NUMERIC_WEATHER_FIELDS
from tripspot.operators.baseline import BASELINE_KEYS, PLACES

DATE = "service_date"
SKETCH_K = 800  # rank error of a quantile sketch about 0.4 %, at some 10 KB


def keep_daily(parts: DataFrame, path: str) -> None:
    """Write daily parts; the dates among them replace what was kept of these dates, others stay as they are."""
    rows = parts.hint("rebalance", DATE)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path)


def daily_moments(scores: DataFrame, score="hotspot_score", keys=BASELINE_KEYS) -> DataFrame:
    """Per key and date: number, mean, and sum of squared distances from the mean."""
    return scores.groupBy(*keys, DATE).agg(
        F.count(score).alias("n"),
        F.avg(score).alias("mean"),
        (F.var_pop(score) * F.count(score)).alias("m2"),
    )


def merge_moments(parts: DataFrame, keys=BASELINE_KEYS) -> DataFrame:
    """Mean, population deviation and number per key over all given dates, to 9 places, as `historical_baseline` has them.

    Parts are added one by one in the order of their dates, each by the distance of its mean from the mean so far:
    nothing large is subtracted from something large. A key has one part per date, so its list is as long as the
    window has dates.
    """
    add = lambda s, p: F.struct(
        (s["n"] + p["n"]).alias("n"),
        (s["mean"] + (p["mean"] - s["mean"]) * p["n"] / (s["n"] + p["n"])).alias("mean"),
        (s["m2"] + p["m2"] + (p["mean"] - s["mean"]) * (p["mean"] - s["mean"]) * s["n"] * p["n"] / (s["n"] + p["n"])).alias("m2"),
    )
    given = parts.filter("n > 0").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(DATE, "n", "mean", "m2"))).alias("parts"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    total = F.aggregate("parts", zero, add)
    return given.withColumn("total", total).select(
        *keys,
        F.round("total.mean", PLACES).alias("mean"),
        F.round(F.sqrt(F.greatest(F.lit(0.0), F.col("total.m2")) / F.col("total.n")), PLACES).alias("stddev"),
        F.col("total.n").alias("count"),
    )


def daily_sketches(rows: DataFrame, fields=NUMERIC_WEATHER_FIELDS, k=SKETCH_K) -> DataFrame:
    """Per date one quantile sketch of fixed size for each field; nulls are left out."""
    return rows.groupBy(DATE).agg(*[F.kll_sketch_agg_double(F.col(f).cast("double"), F.lit(k)).alias(f) for f in fields])


def merge_quantiles(sketches: DataFrame, fields=NUMERIC_WEATHER_FIELDS, at=0.5) -> DataFrame:
    """The quantile of each field over all given dates in one row, from merged sketches; null without a value."""
    merged = sketches.agg(*[F.kll_merge_agg_double(f).alias(f) for f in fields])
    some = lambda f: F.coalesce(F.kll_sketch_get_n_double(f), F.lit(0)) > 0
    return merged.select(*[F.when(some(f), F.kll_sketch_get_quantile_double(f, F.lit(at))).alias(f) for f in fields])


def daily_counts(rows: DataFrame, col="weather_code") -> DataFrame:
    """Per date the number of rows of each value. The values are codes, so these exact counts are as small as a sketch."""
    return rows.groupBy(DATE, F.col(col).cast("string").alias(col)).agg(F.count("*").alias("n"))


def merge_mode(counts: DataFrame, col="weather_code") -> DataFrame:
    """A11 over all given dates: the most frequent value, of equally frequent ones the smallest as text."""
    return counts.groupBy(col).agg(F.sum("n").alias("count")).orderBy(F.desc("count"), F.asc(col)).limit(1)


def rank_errors(rows: DataFrame, found: DataFrame, fields=NUMERIC_WEATHER_FIELDS, at=0.5) -> DataFrame:
    """(field, rank_error): how far the rank of each found value is from the wanted one, measured on all rows. Equal
    values have a range of ranks; a wanted rank inside it is no error."""
    value = found.first()  # one number a field
    some = [f for f in fields if value[f] is not None]
    below = [F.avg((F.col(f) < value[f]).cast("double")).alias(f"{f}_low") for f in some]
    upto = [F.avg((F.col(f) <= value[f]).cast("double")).alias(f"{f}_high") for f in some]
    ranks = rows.agg(*below, *upto)
    error = lambda f: F.greatest(F.lit(0.0), F.col(f"{f}_low") - at, at - F.col(f"{f}_high"))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), error(f).alias("rank_error")) for f in some])
    return ranks.select(F.inline(pairs))
