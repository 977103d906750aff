"""Trip tables and key/value files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tripspot.operators.rows import top_rows
from tripspot.operators.verify import parse_kv_lines

# Declared types of the known CSV columns; other columns stay text.
CSV_TYPES = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "PULocationID": "int",
    "DOLocationID": "int",
    "pickup_datetime": "timestamp_ntz",
}
RAW_KEYS = ["tpep_pickup_datetime", "PULocationID", "DOLocationID"]
MISSING_SOURCE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_trips(spark: SparkSession, *paths, columns=None) -> DataFrame:
    """Parquet trips from folders or files, only the given columns."""
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV trips with a header. Types are declared by column name, so the data is not read twice to guess them."""
    return read_csv_by_header(spark, path, CSV_TYPES)


def read_csv_by_header(spark: SparkSession, path, types: dict) -> DataFrame:
    """CSV files with the columns that their header names, typed by name. All files must have the same header: one that
    differs stops the job when it is read, instead of giving values of another column."""
    names = spark.read.option("header", True).csv(path).columns
    schema = ", ".join(f"`{name}` {types.get(name, 'string')}" for name in names)
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def read_trips_any(spark: SparkSession, parquet: str, csv: str) -> DataFrame:
    """S3: the Parquet source, or the CSV source where there is no Parquet. Other errors are not hidden."""
    try:
        return read_trips(spark, parquet)
    except AnalysisException as error:
        if error.getCondition() not in MISSING_SOURCE:
            raise
        return read_trips_csv(spark, csv)


def read_trips_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """Trips of the given files, all Parquet or all CSV with a header."""
    if all(f.endswith(".csv") for f in files):
        return read_csv_by_header(spark, files, CSV_TYPES)
    return read_trips(spark, *files)


def bounded_source(df: DataFrame, n=0, required=("PULocationID", "DOLocationID"), order=(), **how) -> DataFrame:
    """Rows with all required fields, the first n of them in the given order; n = 0 keeps all. With an order by names
    (`name`, `-name`) rows beyond a measured border are not sorted."""
    rows = df.dropna(subset=list(required))
    if not n:
        return rows
    return top_rows(rows, order, n, **how) if order else rows.limit(n)


def read_zone_hour_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated zone, hour, n. Lines are split here because a CSV reader would accept a fourth field."""
    return parse_kv_lines(spark.read.text(path))
