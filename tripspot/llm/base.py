"""Registration of the corpus queries."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tripspot.session import Scratch

QUERIES: dict = {}
ORACLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession, name: str) -> Scratch:
    """A job's scratch tables; Python workers are told where this package lies."""
    paths = spark.sparkContext.environment.setdefault("PYTHONPATH", "")
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))
    return Scratch(spark, name)


def query(name: str, oracle: str | None = None):
    """Register a query under its name, with the SQL that gives the same rows if there is any."""

    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add
