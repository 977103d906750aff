"""M1-M6: Spark ML pipeline of the two forecast candidates."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame

from tripspot.functions.fixed import NUMERIC_WEATHER_FIELDS
from tripspot.operators.evaluation import LABEL, PREDICTION, holdout_metrics

# Training parameters of the published model.
GBT_DEFAULTS = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "maxBins": 64, "seed": 42}
CATEGORIES = {"pickup_zone": ("zone_index", "zone_vector"), "weather_code": ("weather_code_index", "weather_vector")}


def _categories(use_weather):
    return [c for c in CATEGORIES if use_weather or c != "weather_code"]


def indexers(use_weather=False) -> list:
    """M1: category to index by frequency; unseen values get their own index."""
    return [
        StringIndexer(inputCol=c, outputCol=CATEGORIES[c][0], handleInvalid="keep") for c in _categories(use_weather)
    ]


def encoder(use_weather=False) -> OneHotEncoder:
    """M2: one-hot vectors of the indices."""
    index, vector = zip(*[CATEGORIES[c] for c in _categories(use_weather)])
    return OneHotEncoder(inputCols=list(index), outputCols=list(vector), handleInvalid="keep")


def assembler(use_weather=False) -> VectorAssembler:
    """M3: calendar features, or calendar and weather features."""
    numeric = ["pickup_hour", "pickup_dow", *(NUMERIC_WEATHER_FIELDS if use_weather else ())]
    vectors = [CATEGORIES[c][1] for c in _categories(use_weather)]
    return VectorAssembler(inputCols=numeric + vectors, outputCol="features", handleInvalid="keep")


def gbt(**params) -> GBTRegressor:
    """M4: gradient-boosted trees."""
    return GBTRegressor(
        featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION, **{**GBT_DEFAULTS, **params}
    )


def build_pipeline(use_weather=False, **params) -> Pipeline:
    """M5."""
    return Pipeline(stages=[*indexers(use_weather), encoder(use_weather), assembler(use_weather), gbt(**params)])


def evaluate(model, holdout: DataFrame, threshold=50.0) -> DataFrame:
    """M6: one row of holdout metrics from one pass over the predictions."""
    return holdout_metrics(model.transform(holdout), threshold)


def save_model(model: PipelineModel, path: str) -> None:
    """S15."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """S15."""
    return PipelineModel.load(path)
