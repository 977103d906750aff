"""M5-M8: train both candidates, select one, save model, baseline and metrics."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tripspot.functions.fixed import WEATHER_ARCHIVE_SOURCE, WEATHER_FIELDS
from tripspot.operators.baseline import BASELINE_KEYS, historical_baseline
from tripspot.operators.evaluation import holdout_metrics, select_model
from tripspot.operators.ml import build_pipeline, save_model
from tripspot.operators.score import Split, daily_scores, temporal_split
from tripspot.operators.weather import assert_coverage, fallback_values, hourly_side, join_weather
from tripspot.session import LOCAL_ZONE, Scratch
from tripspot.sources.sinks import write_report

METRIC_COLUMNS = (
    "mae", "rmse", "r2", "precision", "recall", "true_positive", "false_positive", "false_negative", "rows",
)


class Training(NamedTuple):
    """Results of a training run."""

    model: PipelineModel
    models: dict
    metrics: DataFrame
    selection: Row
    baseline: DataFrame
    fallback: dict
    report: DataFrame


class Rules(NamedTuple):
    """What a training run was asked to do; its report is worded from these values."""

    train_share: float = 0.8
    hot_score: float = 50.0
    mae_tolerance: float = 1.02
    sigma: float = 3.0
    min_support: int = 5
    weather_place: str = ""


def metrics_report(split: Split, metrics: DataFrame, selection, covered, fallback, rules=Rules(), rows=None) -> DataFrame:
    """M8: one row with the dates, row counts, rules, fallback values, the metrics of both candidates and those of
    the selected one. `selection` is the row M7 gives, `covered` the row A15 gives, `rows` the numbers of training and
    test rows."""
    share, slack = round(100 * rules.train_share), round(100 * (rules.mae_tolerance - 1))
    constants = {
        "model_family": "GBTRegressor",
        "weather_features": ",".join(WEATHER_FIELDS),
        "evaluation_method": f"split by date: first {share}% of the days with weather for training, last {100 - share}% for the test",
        "train_start_date": str(split.train_start),
        "train_end_date": str(split.train_end),
        "test_start_date": str(split.test_start),
        "test_end_date": str(split.test_end),
        "training_days": split.train_days,
        "evaluation_days": split.test_days,
        "eligible_rows": covered["eligible_rows"],
        "weather_coverage_rows": covered["covered_rows"],
        "weather_coverage": covered["coverage"],
        "training_rows": (rows or {}).get("train"),
        "evaluation_rows": (rows or {}).get("test"),
        "hotspot_classification_threshold": rules.hot_score,
        "weather_source": WEATHER_ARCHIVE_SOURCE,
        "weather_timezone": LOCAL_ZONE,
        "weather_location": rules.weather_place or None,
        "label_definition": "hotspot_score of a zone and hour of a date",
        "score_formula": "100 * trips / trips of the busiest zone of the same date, hour and weekday",
        "baseline_keys": ",".join(BASELINE_KEYS),
        "baseline_min_support": rules.min_support,
        "baseline_sigma": rules.sigma,
        "selection_rule": f"weather candidate if its RMSE is lower and its MAE at most {slack}% higher than the calendar one's",
        "weather_selected": selection["weather_selected"],
        "selected": selection["selected"],
        "anomaly_rule": f"above mean plus {rules.sigma:g} population deviations, 100 at most, from {rules.min_support} training scores on",
        **{f"fallback_{name}": value for name, value in fallback.items()},
    }

    def figures(candidate):
        return F.max_by(F.struct(*METRIC_COLUMNS), F.col("candidate") == candidate)

    return metrics.agg(
        figures("calendar").alias("calendar_metrics"),
        figures("weather").alias("weather_metrics"),
        figures(selection["selected"]).alias("deployed_metrics"),
    ).select(*[F.lit(value).cast("string" if value is None else _kind(value)).alias(name) for name, value in constants.items()], "*")


def _kind(value) -> str:
    return {bool: "boolean", int: "long", float: "double"}.get(type(value), "string")


def fit_candidates(train_rows: DataFrame, **gbt) -> dict:
    """M5: both candidates, fitted at the same time: boosting is a chain of short jobs that leave executors idle."""
    pipelines = {"calendar": build_pipeline(False, **gbt), "weather": build_pipeline(True, **gbt)}
    with ThreadPoolExecutor(len(pipelines)) as pool:
        fits = {
            name: pool.submit(inheritable_thread_target(train_rows.sparkSession)(pipeline.fit), train_rows)
            for name, pipeline in pipelines.items()
        }
        return {name: fit.result() for name, fit in fits.items()}


def train(
    trips: DataFrame, weather: DataFrame, minimum_coverage=0.95, scores: DataFrame | None = None, scratch: Scratch | None = None, **gbt
) -> Training:
    """The training run on curated trips (or on ready scores). Only dates, six fallback values and one-row metrics
    reach the driver.

    Training reads its rows many times, from tables in `scratch`: they outlive lost executors, and their partitions
    follow their size, while a cached plan would keep one per shuffle partition. The results read them, too.
    """
    scratch = scratch or Scratch(trips.sparkSession, "train")
    scores = scratch.store((daily_scores(trips) if scores is None else scores).hint("rebalance"), "scores")
    weather = hourly_side(scratch.store(weather, "weather"))
    covered = assert_coverage(scores, weather, minimum_coverage)
    enriched = scratch.store(join_weather(scores, weather).hint("rebalance"), "training")
    split = temporal_split(enriched)
    models = fit_candidates(split.train, **gbt)
    tested = [
        model.transform(split.test).select(
            F.lit(name).alias("candidate"), "hotspot_score", "predicted_hotspot_score"
        )
        for name, model in models.items()
    ]
    spark = enriched.sparkSession
    measured = holdout_metrics(tested[0].unionByName(tested[1]), by=["candidate"]).collect()  # two rows
    metrics = spark.createDataFrame(
        measured, "candidate string, mae double, rmse double, r2 double, true_positive long, false_positive long, "
        "false_negative long, rows long, precision double, recall double",
    )
    selection = select_model(metrics).first()
    fallback = fallback_values(split.train)
    baseline = historical_baseline(split.train)
    counted = {name: part.count() for name, part in (("train", split.train), ("test", split.test))}
    report = metrics_report(split, metrics, selection, covered, fallback, rows=counted)
    chosen = models[selection["selected"]]
    return Training(chosen, models, metrics, selection, baseline, fallback, report)


def training_job(trips: DataFrame, weather: DataFrame, out: str, **options) -> Training:
    """Train and save everything below `out`; the tables in between are removed."""
    spark = trips.sparkSession
    with Scratch(spark, "train") as scratch:
        result = train(trips, weather, scratch=scratch, **options)
        save_model(result.model, f"{out}/model")
        write_report(result.baseline, f"{out}/baseline", fmt="parquet")
        write_report(result.report, f"{out}/metrics")
    return result._replace(baseline=spark.read.parquet(f"{out}/baseline"), report=spark.read.json(f"{out}/metrics"))


def load_fallback(spark: SparkSession, out: str) -> dict:
    """The fallback values a training job saved below `out`."""
    row = spark.read.json(f"{out}/metrics").first().asDict()
    return {name: float(row[f"fallback_{name}"]) for name in WEATHER_FIELDS if row.get(f"fallback_{name}") is not None}
