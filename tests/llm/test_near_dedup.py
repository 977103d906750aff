"""Near duplicates against brute force, and the odd cases."""

import random

import numpy as np
import pyarrow as pa
import pytest

from odd import odd_rows
from tripspot.llm.components import components
from tripspot.llm.near_dedup import near_duplicates, signatures
from tripspot.llm.words import blocks, count_words, distinct_sorted, shingles, split_words


def shingle_set(text, width):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < width else (tuple(w[i : i + width]) for i in range(len(w) - width + 1)))


def brute(rows, width, percent=80):
    """Smallest reachable id per id, by comparing all pairs."""
    sets = [(i, shingle_set(t, width)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                up[high] = low
    return {i: root(i) for i in up}


def test_words_are_those_of_bytes_split():
    texts = ["", None, " a\tB\x0bc\u0085d ", "x" * 3_000_000 + " y", "é É ", "a b"]
    array = pa.array(texts, pa.string())
    assert list(count_words(array)) == [len((t or "").encode().split()) for t in texts]
    seen = {}
    for first, data, offsets in blocks(array):
        words = split_words(data, offsets)
        for r, h, s, e in zip(words.row, words.hash, words.start, words.end):
            assert seen.setdefault(bytes(data[s:e]).lower(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_signatures_agree_as_often_as_sets():
    rng = np.random.default_rng(0)
    for size in (4, 40, 4000):
        pool = rng.integers(0, 1 << 63, size, dtype=np.int64).astype(np.uint64) * np.uint64(2)
        a, b = pool[: int(size * 0.9)], pool[int(size * 0.1) :]
        agreed = []
        for _ in range(60 if size < 4000 else 8):
            turned = rng.integers(0, 1 << 63, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            values = [np.sort(x * turned) for x in (a, b)]
            row = np.repeat([0, 1], [len(v) for v in values])
            s = signatures(row, np.concatenate(values), 2, 128)
            agreed.append((s[0] == s[1]).mean())
        true = len(set(a) & set(b)) / len(set(a) | set(b))
        assert abs(np.mean(agreed) - true) < 0.07


@pytest.mark.parametrize("width", [4, 5])
def test_against_brute_force(spark, scratch, documents, width):
    rng = random.Random(5)
    rows = []
    for base in range(12):
        text = [f"b{base}x{rng.randrange(400)}" for _ in range(rng.choice([3, 6, 30, 90]))]
        for copy in range(12):
            edited = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                edited[rng.randrange(len(edited))] = f"e{rng.randrange(10**6)}"
            rows.append((base * 100 + copy, " ".join(edited)))
    rng.shuffle(rows)
    got = {r.doc_id: r for r in near_duplicates(documents(rows), scratch, width=width).collect()}
    expected = brute(rows, width)
    assert {i: r.component_id for i, r in got.items()} == expected
    assert {i: r.kept for i, r in got.items()} == {i: i == c for i, c in expected.items()}
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingle_set(t, width)) for i, t in rows}


def test_ids_of_several_sets_against_brute_force(spark, scratch, documents):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcd")
    near = lambda text: text + " edited"
    rows = [(5, a), (7, a), (7, b), (8, near(b)), (7, ""), (7, None)]  # 7 ties the sets of 5 and of itself
    rows += [(20, c), (22, c), (21, d), (22, d), (23, near(d)), (24, ""), (None, a), (None, "")]  # 22 is smallest of none
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(documents(rows), scratch, width=4).collect()}
    expected = brute(rows, 4)
    assert expected[8] == 5 and expected[23] == 20
    assert got == {(i, c, i == c) for i, c in expected.items()} | {(None, None, True)}


def test_no_link_is_lost_when_the_star_fails(spark, scratch, documents):
    """Texts along a chain: each like its neighbours only, so most are not like the smallest id in their buckets."""
    words = [f"w{i}" for i in range(400)]
    rows = [(1000 - k, " ".join(words[k * 8 : k * 8 + 200])) for k in range(20)]
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(rows), scratch, width=4).collect()}
    assert got == brute(rows, 4) and set(got.values()) == {981}


def test_odd_rows(spark, scratch, documents):
    rows = odd_rows()
    got = near_duplicates(documents(rows), scratch, width=4).collect()
    assert len(got) == len(rows)
    expected = brute([r[:2] for r in rows], 4)
    assert all(r.component_id == expected[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert {r.n_shingles for r in got if r.doc_id in (3, 4, 5)} == {0}


def test_empty(spark, scratch, documents):
    assert near_duplicates(documents([]), scratch).collect() == []


def test_components_of_a_long_chain(spark, scratch):
    ids = list(range(60))
    random.Random(1).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:])) + [(100, 101), (7, 7)], "u long, v long")
    got = {r.id: r.component for r in components(links, scratch).collect()}
    assert got == {i: 0 for i in range(60)} | {100: 100, 101: 100}


def test_distinct_sorted():
    row, value = distinct_sorted(np.array([0, 0, 0, 2]), np.array([5, 1, 5, 5], np.uint64))
    assert list(row) == [0, 0, 2] and list(value) == [1, 5, 5]


def test_short_texts_are_one_shingle():
    for _, data, offsets in blocks(pa.array(["a b", "c d e f g", "", "a b c"])):
        row, value = shingles(split_words(data, offsets), 4, True)
        assert list(row) == [0, 1, 1, 3] and len(set(value)) == 4
