"""Greedy string tiling against brute force; benchmark passages in documents."""

import random

import pytest

from odd import odd_rows
from tripspot.llm.decontaminate import contaminated_pairs, greedy_tiles


def brute_tiles(text, pattern, shortest):
    """Mark the longest match of free tokens again and again."""
    free_t, free_p, tiles = [True] * len(text), [True] * len(pattern), []
    while True:
        best = (0, 0, 0)
        for p in range(len(text)):
            for q in range(len(pattern)):
                n = 0
                while (p + n < len(text) and q + n < len(pattern) and free_t[p + n] and free_p[q + n]
                       and text[p + n] == pattern[q + n]):
                    n += 1
                best = max(best, (n, -p, -q))
        if best[0] < shortest:
            return tiles
        n, p, q = best[0], -best[1], -best[2]
        free_t[p : p + n] = free_p[q : q + n] = [False] * n
        tiles.append((p, q, n))


def test_tiles_like_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        text = [rng.randrange(6) for _ in range(rng.randrange(60))]
        pattern = [rng.randrange(6) for _ in range(rng.randrange(30))]
        if rng.random() < 0.5 and len(text) > 10:
            pattern = text[5:] + pattern + text[:5]
        ours, theirs = greedy_tiles(text, pattern, 3), brute_tiles(text, pattern, 3)
        assert sorted(n for *_, n in ours) == sorted(n for *_, n in theirs)
        assert all(text[p : p + n] == pattern[q : q + n] for p, q, n in ours)


def test_long_matches_restart_the_search():
    text = list(range(500))
    assert greedy_tiles(text, text, 4) == [(0, 0, 500)]


def passage(item, n=50):
    return [f"q{item}é{i}" for i in range(n)]


@pytest.fixture
def benchmark(spark):
    rows = [(i, " ".join(passage(i))) for i in range(4)] + [(0, " ".join(passage(0))), (7, None), (None, "x y z w v u"), (8, "a b"), (9, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_passages_are_found(spark, scratch, documents, benchmark):
    filler = [f"f{i}" for i in range(300)]
    p = passage(1)
    rows = [
        (1, " ".join(filler + passage(0) + filler)),  # whole
        (2, " ".join(filler[:9] + p[30:] + filler[:3] + p[:30] + filler[:9]).upper()),  # reordered, other case
        (3, " ".join(filler + p[:24])),  # less than half
        (4, " ".join(x for i in range(0, 50, 5) for x in p[i : i + 3] + ["z"])),  # pieces too short
        (5, " ".join(passage(2) * 30 + filler + passage(3))),  # two items, one many times
        (6, " ".join(filler)),
    ]
    got = {(r.doc_id, r.item_id): r for r in contaminated_pairs(documents(rows), benchmark, scratch).collect()}
    assert set(got) == {(1, 0), (2, 1), (5, 2), (5, 3)}
    assert all(r.coverage == 1.0 and r.matched_words == 50 for r in got.values())
    assert got[2, 1].tiles == 2 and got[2, 1].longest == 30


def test_odd_rows(spark, scratch, documents, benchmark):
    rows = odd_rows() + [(None, " ".join(passage(2)), None, None, None), (11, " ".join(passage(3))), (11, " ".join(passage(3)))]
    got = [(r.doc_id, r.item_id) for r in contaminated_pairs(documents(rows), benchmark, scratch).collect()]
    assert sorted(got, key=str) == [(11, 3), (11, 3), (None, 2)]


def test_empty(spark, scratch, documents, benchmark):
    assert contaminated_pairs(documents([]), benchmark, scratch).collect() == []
    assert contaminated_pairs(documents(odd_rows()), benchmark.limit(0), scratch).collect() == []
