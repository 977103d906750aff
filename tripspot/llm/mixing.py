"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripspot.llm.prefix import prefix_sums
from tripspot.operators.rows import checked_broadcast
from tripspot.session import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, number, target).

    Sources by code point, null last, take the weights in turn and share `share` times all sizes; a target stops at
    `most` times its source's size and the excess is shared anew by weight until none is above. That is filling to a
    common level: with sources ordered by cap over weight, each is capped whose cap is below what the rest of the
    total gives it. The windows run over one row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    named = sizes.withColumn("number", F.row_number().over(by_name).cast("long"))
    place = F.col("number") % len(weights)  # 1 for the first weight, 0 for the last
    weight = F.coalesce(*[F.when(place == (i + 1) % len(weights), F.lit(w)) for i, w in enumerate(weights)])
    level = (
        named.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("total", F.sum("source_size").over(everything) * share)
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(after))
        .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    )
    # The level of the first source below its cap is the level of all that are.
    at = F.min_by(F.when(~F.col("capped"), F.col("level")), F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "number")))
    return level.withColumn("common", at.over(everything)).select(
        "source",
        "source_size",
        "number",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("common") * F.col("weight")).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    scratch: Scratch,
    id_col="doc_id",
    text_col="text",
    source_col="source",
    seed=17,
    carry: tuple[str, ...] = (),
    **law,
) -> DataFrame:
    """One row per row of `docs`: id, source, size, source_size, target, copies, taken, and the columns to carry.

    Size is the number of words. A document's expected copies are its source's target over its source's size. Within
    a source, in the order of size and id, expected copies are prefix-summed from one random offset, and a document
    is emitted once for each whole number that its sum crosses: `copies`, the expected number rounded down or up.
    Ordered by size, each run of neighbours gives its share, so a source misses its target by about its largest
    document at most. The offset depends on the seed and the source's name only: reruns agree.

    A null source is a source, a null text has no words; a source without words has target 0 and no copies. Repeated
    rows are rows of their own. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(source_col).alias("_source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("amount"),
        F.monotonically_increasing_id().alias("_at"),
        *[F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)],
    )
    rows = scratch.store(rows, "sizes")
    sizes = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("amount").alias("source_size"))
    targets = scratch.store(source_targets(sizes, **law), "targets")
    numbered = targets.select(F.col("source").alias("_source_"), F.col("number").alias("group"))
    named = rows.join(checked_broadcast(numbered), F.col("_source").eqNullSafe(F.col("_source_"))).drop("_source_", "_source")
    placed = prefix_sums(named, ["amount", "_id", "_at"], scratch)
    scratch.drop(rows)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("null")))
    offset = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / 2.0**32
    rates = targets.withColumnRenamed("number", "group").withColumn("offset", offset).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    upto = lambda k: F.floor(k * F.col("rate") + F.col("offset"))
    return (
        placed.join(checked_broadcast(rates), "group")
        .withColumn("copies", (upto(F.col("position") + 1) - upto(F.col("position"))).cast("long"))
        .select(
            F.col("_id").alias(id_col),
            F.col("source").alias(source_col),
            F.col("amount").alias("size"),
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("amount")).alias("taken"),
            *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)],
        )
    )
