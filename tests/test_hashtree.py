"""Differences by trees of fingerprints against a plain comparison of all rows."""

import random
from collections import Counter

import pytest

from tripspot.operators import hashtree
from tripspot.operators.hashtree import differing_buckets, differing_rows, fingerprints, tree_diff_keyed, tree_differences
from tripspot.plans.reports import formatted_plan
from tripspot.session import Scratch

SCHEMA = "k long, s string, x double"


@pytest.fixture
def scratch(spark):
    with Scratch(spark, "tree") as scratch:
        yield scratch


def tables(spark, seed, n=3000):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 1, 2, i]), rng.choice([None, "", "a", f"s{i % 7}"]), rng.choice([None, 0.5, float(i)])) for i in range(n)]
    rows += [(9, "hot", 1.0)] * 1000  # a third of all rows are equal
    other = [r for r in rows if rng.random() > 0.004] + [r for r in rows if rng.random() < 0.004] + [(None, None, 1.0), (1, None, None)]
    rng.shuffle(other)
    return rows, other, spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(other, SCHEMA).repartition(5)


@pytest.mark.parametrize("enough", [5, 10_000])
def test_surplus_of_both_sides(spark, scratch, enough):
    rows, other, a, b = tables(spark, 3)
    want = Counter(rows)
    want.subtract(other)
    got = {tuple(r)[:3]: r.surplus for r in tree_differences(a, b, scratch, enough).collect()}
    assert got == {k: n for k, n in want.items() if n} and len(got) > 5


def test_only_differing_buckets_are_read_closely(spark, scratch):
    rows, _, a, _ = tables(spark, 4)
    near = spark.createDataFrame([*rows[:-1], (9, "hot", 2.0)], SCHEMA)
    left, right = differing_rows(a, near, scratch, enough=5)
    # Rows that share all buckets with a changed one: the hot row's equals, the two versions, and hardly another.
    assert 1000 <= left.count() <= 1010 and 1000 <= right.count() <= 1010
    assert {tuple(r) for r in tree_differences(a, near, scratch).collect()} == {(9, "hot", 1.0, 1), (9, "hot", 2.0, -1)}


def test_equal_tables_are_compared_by_their_trees_alone(spark, scratch):
    _, _, a, _ = tables(spark, 5)
    leaves = [scratch.store(fingerprints(df, a.columns), "leaves") for df in (a, a.repartition(7))]
    assert differing_buckets(*leaves) == [] and leaves[0].count() <= 4096
    root = hashtree.merged(hashtree.merged(leaves[0])).collect()
    assert len(root) == 1 and root[0].n == 4000
    plan = formatted_plan(fingerprints(a, a.columns))
    assert plan.index("partial_sum") < plan.index("Exchange hash") if "Exchange hash" in plan else "partial_sum" in plan
    assert tree_differences(a, a.repartition(2), scratch).collect() == []


def test_keyed(spark, scratch):
    a = spark.range(2000).selectExpr("cast(id as string) as k", "id % 10 as v")
    b = spark.range(1, 2001).selectExpr("cast(id as string) as k", "case when id = 77 then null else id % 10 end as v")
    got = sorted(tuple(r) for r in tree_diff_keyed(a, b, ["k"], ["v"], scratch, enough=3).collect())
    assert got == [("0", 0, None), ("2000", None, 0), ("77", 7, None)]


def test_empty_tables(spark, scratch):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, None, None)] * 2, SCHEMA)
    assert tree_differences(none, none, scratch).collect() == []
    assert [tuple(r) for r in tree_differences(none, one, scratch).collect()] == [(1, None, None, -2)]
