"""HAT-trie counts against a plain counter, and phrases against brute force."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from odd import odd_rows
from tripspot.llm import collocations as module
from tripspot.llm.collocations import collocations
from tripspot.llm.hattrie import RUN, Container, HatTrie, count_runs, merge_runs, prefixes


def grams(seed, n, width, words=40):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 1 << 63, words, dtype=np.int64).astype(np.uint64) * np.uint64(2)
    pick = np.minimum(rng.geometric(0.1, (n, width)), words) - 1
    return ids[pick]


@pytest.mark.parametrize("width", [1, 2, 3])
def test_trie_counts_bursts_and_spills(width):
    keys, total = grams(3, 20_000, width), Counter()
    trie, peak = HatTrie(width, burst=20, capacity=300), 0
    for part in np.array_split(keys, 97):
        trie.add(part)
        for k, c in trie.spill():
            total.update({tuple(a): 0 for a in k.tolist()})
            for a, b in zip(map(tuple, k.tolist()), c):
                total[a] += int(b)
        peak = max(peak, trie.size())
    assert width == 1 or any(isinstance(c, list) for c in trie.root)  # some container has burst
    for k, c in trie.spill(everything=True):
        for a, b in zip(map(tuple, k.tolist()), c):
            total[a] += int(b)
    assert total == Counter(map(tuple, keys.tolist())) and peak <= 300 and trie.size() == 0


def test_container_adds_repeated_keys_at_once():
    keys = grams(4, 5_000, 2, 12)
    one = Container(2)
    for part in np.array_split(keys, 7):
        one.add(part, np.full(len(part), 2, np.int64))
    got = dict(zip(map(tuple, one.items()[0].tolist()), one.items()[1].tolist()))
    assert got == {k: 2 * n for k, n in Counter(map(tuple, keys.tolist())).items()} and one.size == len(got)


def test_runs_are_sorted_and_merge(spark, scratch, small_batches):
    keys = grams(5, 30_000, 3)

    def runs(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                yield from count_runs([keys[i::8]], 3, 6, 50, 500)

    for run in count_runs([keys], 3, 6, 50, 500):
        assert run.column("prefix").to_pylist() == sorted(set(run.column("prefix").to_pylist()))
    stored = scratch.store(spark.range(8).repartition(4).mapInArrow(runs, RUN), "runs")
    rows = merge_runs(stored, 3, 5).collect()
    want = {tuple(np.array(k, np.uint64).view(np.int64).tolist()): n for k, n in Counter(map(tuple, keys.tolist())).items() if n >= 5}
    assert {tuple(r)[:3]: r.f for r in rows} == want and len(rows) == len(want)


def test_one_first_word_is_spread_over_prefixes():
    keys = grams(6, 500, 2, 200)
    keys[:, 0] = keys[0, 0]
    assert len(np.unique(prefixes(keys, 8))) > 8


def brute(rows, least, top, share=50):
    f, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates, out = {p: a for p, a in f.items() if len(p) > 2 and a >= least}, []
    for (lang, *p), a in candidates.items():
        longer = [b for (m, *q), b in candidates.items() if m == lang and len(p) == 2 and len(q) == 3 and p in (q[:2], q[1:])]
        if any(100 * b >= share * a for b in longer):
            continue
        cuts = [(f[(lang, *p[:k])], f[(lang, *p[k:])]) for k in range(1, len(p))]
        score, k = min((Fraction(1000000 * a * a, x * y).__floor__(), i) for i, (x, y) in enumerate(cuts))
        out.append((lang, " ".join(p), a, *cuts[k], totals[lang], score))
    rows = []
    for lang in totals:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[-1], -r[2], r[1].encode()))[:top]
        rows += [(lang, i + 1, *r[1:]) for i, r in enumerate(own)]
    return sorted(rows)


@pytest.mark.parametrize("least, top", [(4, 2000), (2, 25)])
def test_against_brute_force(spark, scratch, documents, least, top):
    rng, rows = random.Random(8), odd_rows()
    vocabulary = ["the", "New", "york", "zoë", "a\xa0b", "x-y", "Ünder", "🙂", "q"] + [f"w{i}" for i in range(25)]
    for i in range(300):
        words = [rng.choice(vocabulary[: rng.choice([4, 9, 34])]) for _ in range(rng.randrange(0, 40))]
        text = "".join(w + rng.choice([" "] * 9 + ["\t", ". ", ",", "\n", "\x0b", " ! ", ";:"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und", ""]), "s", 1))
    # Small containers and a small trie: they burst and spill all the time.
    got = collocations(documents(rows), scratch, least=least, top=top, burst=8, capacity=64).collect()
    want = brute(rows, least, top)
    assert sorted(map(tuple, got)) == want and len(want) > 20


def test_counts_beyond_64_bits(spark):
    df = spark.createDataFrame([(3_000_000_000_017, 3_000_000_000_019, 3_100_000_000_021)], "a long, l long, r long")
    a, left, right = df.first()
    assert df.select(module._score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (left * right)


def test_empty_tables(spark, scratch, documents):
    assert collocations(documents([]), scratch).collect() == []
    assert collocations(documents([(1, None, None), (2, "", "en"), (3, " .,", None)]), scratch, least=1).collect() == []


def test_a_hash_shared_by_two_words_stops_the_job(spark, scratch, documents, monkeypatch):
    def colliding(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"id": [1, 1], "lang": ["en", "en"], "word": ["a", "b"], "f": [1, 1]})

    monkeypatch.setattr(module, "_words", colliding)
    with pytest.raises(ValueError, match="share a hash"):
        collocations(documents([(1, "a b", "en")]), scratch)
