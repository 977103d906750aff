"""Exact top-k, shards and mixes against brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from odd import odd_rows
from tripspot.llm.mixing import mix_sources, source_targets
from tripspot.llm.prefix import prefix_sums
from tripspot.llm.sharding import contiguous_shards
from tripspot.llm.vectors import build, top_products

VECTORS = "vec_id long, embedding array<float>, id long, vector string"


def nearest(rows, queries, k):
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(i, []).append([int(np.floor(1024 * float(np.float32(x)))) for x in v])
    out = []
    for q in queries:
        for query in whole.get(q, [])[:1]:
            scored = [(-sum(a * b for a, b in zip(query, v)), i) for i, vs in whole.items() if i != q for v in vs if len(v) == len(query)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{"shard_rows": 64}, {"block": 3, "sample_rows": 5}, {}])
def test_top_k(spark, scratch, sizes):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(5)]) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS).repartition(4)
    got = top_products(table, table.filter("vec_id % 100 = 0"), scratch, k=10, **sizes).collect()
    assert sorted(map(tuple, got)) == nearest(rows, range(0, 1100, 100), 10)


def test_odd_vectors(spark, scratch):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [-1e5, 1e6]), (9, [0.0, 0.0])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS).repartition(3)
    got = top_products(table, table, scratch, k=3).collect()
    assert sorted(map(tuple, got)) == nearest(rows, range(10), 3)
    assert top_products(table, table.limit(0), scratch).collect() == []
    assert top_products(table.limit(0), table.limit(0), scratch).collect() == []


def test_large_products_stay_exact(spark, scratch):
    rows = [(0, [2.0**19 + 1, 3.0]), (1, [2.0**19 + 1, 5.0]), (2, [2.0**19 + 1, 7.0]), (3, [2.0**19, 2.0**19])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    got = top_products(table, table.filter("vec_id = 0"), scratch, k=3).collect()
    assert sorted(map(tuple, got)) == nearest(rows, [0], 3)


def test_boxes_are_tight():
    rows = np.random.default_rng(0).integers(-9, 9, (500, 4))
    tree = build(np.arange(500), rows, 32)
    for node, (b, e) in enumerate(zip(tree.begin, tree.end)):
        assert (tree.rows[b:e].min(axis=0) == tree.low[node]).all() and (tree.rows[b:e].max(axis=0) == tree.high[node]).all()
        assert tree.left[node] >= 0 or e - b <= 32
    assert sorted(tree.ids) == list(range(500))


def test_prefix_sums(spark, scratch):
    rng = random.Random(1)
    rows = [(rng.choice([0, 0, 0, 1, 2]), i, rng.randrange(9)) for i in range(3000)]
    table = spark.createDataFrame(rows, "group long, k long, amount long").repartition(7)
    got = {r.k: (r.position, r.before) for r in prefix_sums(table, ["k"], scratch).collect()}
    state = defaultdict(lambda: [0, 0])
    for g, k, a in sorted(rows):
        assert got[k] == tuple(state[g])
        state[g][0] += 1
        state[g][1] += a


def test_shards(spark, scratch, documents):
    rows = odd_rows() + [(100 + i, "x" * (i * 37 % 101)) for i in range(300)]
    got = contiguous_shards(documents(rows), scratch, shards=4, carry=("text", "part")).collect()
    assert len(got) == len(rows)
    assert all(r["size"] == len((r.text or "").encode()) + 8 and r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in got)
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in shards.values())
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert ids == sorted(ids)
    totals = [sum(r["size"] for r in part) for part in shards.values()]
    assert max(totals) - min(totals) <= 2 * max(r["size"] for r in got)
    assert contiguous_shards(documents([]), scratch).collect() == []
    assert sorted(r.slot for r in contiguous_shards(documents([(1, "a")] * 3), scratch, shards=8).collect()) == [0, 0, 0]


def shared_out(sizes, weights=(3, 1, 2)):
    """Targets by sharing excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets(spark):
    rng = random.Random(9)
    for _ in range(4):
        sizes = {s: rng.choice([0, 5, 50, 400, 9000]) for s in ["a", "b", "B", "é", "🙂", "z", None]}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in source_targets(rows).collect()}
        assert got == pytest.approx(shared_out(sizes))


def test_mix(spark, scratch, documents):
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randrange(1, 40)), "en", rng.choice(["a", "a", "a", "b", "c", None]), 1) for i in range(3000)]
    first = mix_sources(documents(rows), scratch).collect()
    again = mix_sources(documents(rows[::-1]).repartition(5), scratch).collect()
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str)
    sizes = defaultdict(int)
    taken = defaultdict(int)
    for r in first:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
    expected = shared_out(sizes)
    assert {r.source: r.target for r in first} == pytest.approx(expected)
    assert all(abs(taken[s] - expected[s]) <= 80 for s in sizes)


def test_odd_mixes(spark, scratch, documents):
    rows = odd_rows()
    got = mix_sources(documents(rows), scratch, carry=("text", "offset")).collect()
    assert len(got) == len(rows) and all(r["size"] == len((r.text or "").encode().split()) for r in got)
    assert all(r.copies == 0 for r in mix_sources(documents([(1, None), (2, "")]), scratch).collect())
    assert mix_sources(documents([]), scratch).collect() == []
