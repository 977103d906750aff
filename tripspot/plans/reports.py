"""SQL reports on the curated trips and their plans."""

from __future__ import annotations

from contextlib import redirect_stdout
from io import StringIO

from pyspark.sql import DataFrame, SparkSession

from tripspot.sources.sinks import write_report
from tripspot.sources.trips import read_trips

REPORTS = {
    "top_zone_hour_dow": """
        select pickup_zone, pickup_zone_name, pickup_borough, pickup_hour, pickup_dow, count(*) as trip_count
        from curated_trips
        group by all
        order by trip_count desc, pickup_zone, pickup_hour, pickup_dow
        limit 20
    """,
    "borough_hour_profile": """
        with per_zone as (
            select pickup_borough, pickup_hour, pickup_zone, count(*) as trips
            from curated_trips
            where pickup_borough is not null
            group by all
        )
        select pickup_borough, pickup_hour, sum(trips) as trip_count, count(pickup_zone) as active_pickup_zones
        from per_zone
        group by pickup_borough, pickup_hour
        order by pickup_borough, pickup_hour
    """,
}


def register_views(spark: SparkSession, curated) -> None:
    """The view the reports read, from a path or a DataFrame."""
    trips = read_trips(spark, curated) if isinstance(curated, str) else curated
    trips.createOrReplaceTempView("curated_trips")


def run_sql(spark: SparkSession, name: str) -> DataFrame:
    """A report by name."""
    return spark.sql(REPORTS[name])


def formatted_plan(df: DataFrame) -> str:
    """V3: the formatted physical plan as text."""
    text = StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def save_reports(spark: SparkSession, curated, out: str) -> None:
    """Each report's rows and its plan below `out`."""
    register_views(spark, curated)
    for name in REPORTS:
        result = run_sql(spark, name)
        write_report(result, f"{out}/{name}/rows")
        plan = spark.createDataFrame([(name, REPORTS[name].strip(), formatted_plan(result))], "query string, sql string, plan string")
        write_report(plan, f"{out}/{name}/plan")
