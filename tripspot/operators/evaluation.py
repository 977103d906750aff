"""Measures of predicted against actual scores, each a single aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LABEL, PREDICTION = "hotspot_score", "predicted_hotspot_score"


def _confusion(label, prediction, threshold) -> dict:
    hot, called = F.col(label) >= threshold, F.col(prediction) >= threshold
    cold, quiet = F.col(label) < threshold, F.col(prediction) < threshold
    return {
        "true_positive": F.count_if(hot & called),
        "false_positive": F.count_if(cold & called),
        "false_negative": F.count_if(hot & quiet),
    }


def _errors(label, prediction) -> dict:
    error = F.col(label) - F.col(prediction)
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": F.lit(1.0) - F.try_divide(F.avg(error * error), F.var_pop(label)),
    }


def _named(measures: dict) -> list:
    return [measure.alias(name) for name, measure in measures.items()]


def confusion(df: DataFrame, threshold=50.0, label=LABEL, prediction=PREDICTION) -> DataFrame:
    """Counts at the score from which a zone is called hot."""
    return df.agg(*_named(_confusion(label, prediction, threshold)))


def regression_metrics(df: DataFrame, label=LABEL, prediction=PREDICTION) -> DataFrame:
    """MAE, RMSE and R2."""
    return df.agg(*_named(_errors(label, prediction)))


def with_rates(counts: DataFrame) -> DataFrame:
    """A14 on confusion counts: precision and recall, NULL for an empty denominator."""
    tp = F.col("true_positive")
    return counts.withColumns(
        {
            "precision": F.try_divide(tp, tp + F.col("false_positive")),
            "recall": F.try_divide(tp, tp + F.col("false_negative")),
        }
    )


def precision_recall(df: DataFrame, threshold=50.0, label=LABEL, prediction=PREDICTION) -> DataFrame:
    """A14."""
    return with_rates(df.agg(*_named(_confusion(label, prediction, threshold)), F.count("*").alias("rows")))


def holdout_metrics(df: DataFrame, threshold=50.0, label=LABEL, prediction=PREDICTION, by=()) -> DataFrame:
    """M6: A12, A13 and A14 together in one pass, optionally per candidate."""
    measures = {**_errors(label, prediction), **_confusion(label, prediction, threshold), "rows": F.count("*")}
    return with_rates(df.groupBy(*by).agg(*_named(measures)))


def select_model(metrics: DataFrame, tolerance=1.02, calendar="calendar", weather="weather") -> DataFrame:
    """M7: the weather candidate is used only if its RMSE is lower and its MAE at most 2 % worse."""

    def of(candidate, metric):
        return F.max(F.when(F.col("candidate") == candidate, F.col(metric))).alias(f"{candidate}_{metric}")

    sides = metrics.agg(*[of(c, m) for c in (calendar, weather) for m in ("rmse", "mae")])
    better = (F.col(f"{weather}_rmse") < F.col(f"{calendar}_rmse")) & (
        F.col(f"{weather}_mae") <= F.col(f"{calendar}_mae") * tolerance
    )
    return sides.withColumn("weather_selected", F.coalesce(better, F.lit(False))).withColumn(
        "selected", F.when(F.col("weather_selected"), weather).otherwise(calendar)
    )
