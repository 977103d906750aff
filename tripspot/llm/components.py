"""Connected components of links between ids, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.session import Scratch


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every id in `links` (u, v): the smallest id that it is linked with over any number of steps.

    Large-star and small-star rounds alternate until nothing changes: each round links neighbours to the smallest one,
    so the number of rounds grows with the logarithm of the longest chain. Every round is written to the shared
    folder. Neighbours' minima combine before the shuffle, and the join that follows can split a hot id.
    """
    edges = scratch.store(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = _state(edges)
    while before[0]:
        both = _both(edges)
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        middle = scratch.store(large, "large-star")
        # Every pair has u > v: the neighbours of u that are not larger.
        least = middle.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            middle.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        after_edges = scratch.store(small, "small-star")
        scratch.drop(middle, edges)
        edges, after = after_edges, _state(after_edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(roots)
