"""V2: the same grouped count under several shuffle partition settings."""

from __future__ import annotations

import statistics
import time

from pyspark.sql import DataFrame

from tripspot.operators.demand import zone_hour_dow_counts
from tripspot.operators.verify import same_rows


def bench_partitions(sample: DataFrame, settings=(4, 16), repetitions=3) -> dict:
    """One warm-up, then the median time per setting on the cached sample; all settings must give equal rows."""
    spark, key = sample.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    sample = sample.cache()
    rows = sample.count()
    if rows == 0:
        raise RuntimeError("the sample is empty")
    results, outputs = {}, []
    try:
        spark.conf.set(key, str(settings[0]))
        zone_hour_dow_counts(sample).collect()
        for partitions in settings:
            spark.conf.set(key, str(partitions))
            seconds = []
            for _ in range(repetitions):
                started = time.perf_counter()
                groups = len(zone_hour_dow_counts(sample).collect())
                seconds.append(time.perf_counter() - started)
            outputs.append(zone_hour_dow_counts(sample))
            results[str(partitions)] = {
                "repetitions_seconds": seconds, "median_seconds": statistics.median(seconds), "group_rows": groups,
            }
        identical = all(same_rows(outputs[0], other) for other in outputs[1:])
    finally:
        spark.conf.set(key, before)
        sample.unpersist()
    if not identical:
        raise AssertionError("the settings gave different rows")
    return {"input_rows": rows, "settings": results, "outputs_identical": identical}
