"""Differences of two large tables by trees of fingerprints, read closely only where they differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tripspot.operators.rows import checked_broadcast
from tripspot.operators.verify import diff_keyed, row_differences
from tripspot.session import Scratch

DIGIT = 6  # bits of a bucket number by which a level of the tree branches
LEAF_DIGITS = 2  # levels below the root of the first tree: 4,096 leaves
PART = 0xFFFFFFFF
MARKS = ("m0", "m1", "m2", "m3")


def _hashes(columns, seed: int) -> Column:
    """A 64-bit hash of some columns in which null differs from every value, and from null in another column."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def _bucket(by, digits: int) -> Column:
    return _hashes(by, 1).bitwiseAND(F.lit((1 << DIGIT * digits) - 1))


def fingerprints(df: DataFrame, by, digits=LEAF_DIGITS) -> DataFrame:
    """One row per bucket of the hash of `by`: rows, and a 128-bit fingerprint of them that does not depend on their order
    and counts repeats: sums of the four halves of two hashes, modulo 2^32. A task sends one row a bucket."""
    first, second = _hashes(df.columns, 2), _hashes(df.columns, 3)
    halves = [h for x in (first, second) for h in (x.bitwiseAND(F.lit(PART)), F.shiftrightunsigned(x, 32))]
    marks = [F.pmod(F.sum(half), F.lit(PART + 1)).alias(name) for name, half in zip(MARKS, halves)]
    return df.groupBy(_bucket(by, digits).alias("bucket")).agg(F.count("*").alias("n"), *marks)


def merged(level: DataFrame) -> DataFrame:
    """The next higher level: each node's fingerprint from those of its children."""
    marks = [F.pmod(F.sum(m), F.lit(PART + 1)).alias(m) for m in MARKS]
    return level.groupBy(F.shiftright("bucket", DIGIT).alias("bucket")).agg(F.sum("n").alias("n"), *marks)


def _unequal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes of one level that differ, with the rows below them on both sides."""
    both = a.withColumn("_n", F.col("n")).unionByName(b.withColumn("_n", F.col("n")).withColumns({c: -F.col(c) for c in ("n", *MARKS)}))
    sums = both.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", *MARKS)], F.sum("_n").alias("rows"))
    return sums.filter(reduce(lambda x, y: x | y, [F.col(c) != 0 for c in ("n", *MARKS)])).select("bucket", "rows")


def differing_buckets(a: DataFrame, b: DataFrame) -> list:
    """Leaves of two trees that differ, found from the root down: a level is compared below differing nodes only.

    `a` and `b` are stored leaves. At most 64 nodes are new for each differing one; equal trees are compared by one row.
    """
    levels = [(a, b)]
    for _ in range(LEAF_DIGITS):
        levels.append(tuple(merged(side) for side in levels[-1]))
    nodes = None
    for x, y in reversed(levels):
        if nodes is not None:
            parent = F.shiftright("bucket", DIGIT).isin([r["bucket"] for r in nodes])
            x, y = x.filter(parent), y.filter(parent)
        nodes = _unequal(x, y).collect()  # at most 4,096 nodes
        if not nodes:
            return []
    return nodes


def differing_rows(a: DataFrame, b: DataFrame, scratch: Scratch, by=None, enough=1_000_000) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in the buckets (of the hash of `by`, all columns by default) that differ.

    One pass over each table makes its tree. While more than `enough` rows lie in differing leaves and these are less
    than half of what was compared, those rows alone are dealt to 64 times finer leaves by further bits of the hash.
    Equal tables move one row per bucket and task, and nothing else.
    """
    by, b = list(by or a.columns), b.select(*a.columns)
    digits, found = LEAF_DIGITS, None
    compared = None
    while True:
        sides = [scratch.store(fingerprints(df, by, digits), "fingerprints") for df in (a, b)]
        if found is None:
            nodes = differing_buckets(*sides)
            if not nodes:
                return a.limit(0), b.limit(0)
            found = a.sparkSession.createDataFrame([(r["bucket"], r["rows"]) for r in nodes], "bucket long, rows long")
        else:
            found = scratch.store(_unequal(*sides), "found")
        rows = found.agg(F.sum("rows")).first()[0] or 0
        wanted = checked_broadcast(found.select("bucket"))
        a, b = (df.join(wanted, _bucket(by, digits) == wanted["bucket"], "left_semi") for df in (a, b))
        if rows <= enough or (compared is not None and 2 * rows > compared) or DIGIT * (digits + 1) > 60:
            return a, b
        compared, digits = rows, digits + 1


def tree_differences(a: DataFrame, b: DataFrame, scratch: Scratch, enough=1_000_000) -> DataFrame:
    """The rows of `row_differences` (surplus over the other table), with only rows of differing buckets shuffled."""
    return row_differences(*differing_rows(a, b, scratch, enough=enough))


def tree_diff_keyed(a: DataFrame, b: DataFrame, keys, vals, scratch: Scratch, enough=1_000_000) -> DataFrame:
    """The rows of `diff_keyed`, with only keys of differing buckets joined."""
    columns = [*keys, *vals]
    return diff_keyed(*differing_rows(a.select(*columns), b.select(*columns), scratch, keys, enough), keys, vals)
