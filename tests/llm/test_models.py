"""Language and toxicity: kernels and marginals against brute force, held-out accuracy, odd rows."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odd import odd_rows
from tripspot.llm import language, toxicity
from tripspot.llm.sample import first_by_hash

SYLLABLES = {"aa": "ka lo mi tu re".split(), "bb": "schu ber ung zer ent".split(), "cc": "été eau oui ère ien".split()}


def talk(rng, lang, n=80):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def test_presence_counts_distinct_grams():
    texts = ["abcab", "", "a", "ab"]
    for text, row in zip(texts, language.presence(texts)):
        grams = {text[i : i + n] for n in language.GRAMS for i in range(len(text) - n + 1)}
        assert row.sum() == len(grams)
    long = "xyz " * 600_000
    assert language.presence([long]).sum() == language.presence(["xyz " * 3]).sum()


def test_languages_are_learned(spark, documents):
    rng = random.Random(1)
    rows = [(i, talk(rng, lang), lang if i % 5 else None) for i in range(300) for lang in [list(SYLLABLES)[i % 3]]]
    docs = documents(rows)
    model = language.learn(docs, per_language=40, landmarks=6)
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    right = sum(got[i].lang_pred == list(SYLLABLES)[i % 3] for i in range(300))
    assert right == 300 and all(0 <= r.score <= 1 for r in got.values())


def test_language_of_odd_rows(spark, documents):
    rng = random.Random(2)
    rows = odd_rows() + [(100 + i, talk(rng, lang), lang) for i in range(30) for lang in [list(SYLLABLES)[i % 3]]]
    docs = documents(rows)
    model = language.learn(docs, per_language=10, landmarks=3)
    got = language.predict(docs, model).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 5, 8)} == {"und"}
    assert all((r.lang_pred == "und") == (r.score == 0) for r in got if r.doc_id in (3, 4, 5, 8))
    carried = language.predict(docs, model, carry=("source", "size")).columns
    assert carried == ["doc_id", "lang_pred", "score", "text", "source", "size"]


def test_nothing_to_learn(spark, documents):
    nothing = documents([])
    assert language.predict(nothing, language.learn(nothing)).collect() == []
    docs = documents([(1, "some words"), (2, None)])
    assert {r.lang_pred for r in language.predict(docs, language.learn(docs)).collect()} == {"und"}
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert all(r.score < 0.5 and r.spans == [] for r in toxicity.tag(docs, model).collect())


def test_first_by_hash(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("kind"))
    chosen, counts = first_by_hash(rows.union(rows), "kind", F.lit(50), 50)
    got = sorted((r.kind, r.place) for r in chosen.collect())
    assert got == [(k, i) for k in "xy" for i in range(1, 51)]
    assert {r.kind: r["size"] for r in counts.collect()} == {"x": 6667, "y": 13333}


@pytest.mark.parametrize("lengths", [[1], [3, 0, 5], [2, 2]])
def test_marginals_by_enumeration(lengths):
    rng = np.random.default_rng(len(lengths))
    e, transition = rng.normal(0, 2, sum(lengths)), rng.normal(0, 1, (2, 2))
    got, _, _ = toxicity.forward_backward(e, np.array(lengths), transition)
    at = 0
    for n in lengths:
        total, inside = 0.0, np.zeros(n)
        for states in itertools.product((0, 1), repeat=n):
            path = (0, *states, 0)
            weight = np.exp(sum(transition[a, b] for a, b in zip(path, path[1:])) + sum(e[at + i] for i, s in enumerate(states) if s))
            total += weight
            inside += weight * np.array(states)
        assert n == 0 or np.allclose(got[at : at + n], inside / total)
        at += n


def test_long_rows_in_chunks():
    """Chunks compose to the plain recursion, for rows shorter and much longer than a chunk."""
    rng = np.random.default_rng(3)
    lengths = np.array([0, 1, 64, 65, 1000, 7, 0, 4097])
    odds, a = np.exp(rng.normal(0, 6, lengths.sum())), np.exp(rng.normal(0, 1, (2, 2)))
    got, at = toxicity._scan(odds, lengths, a), 0
    for n in lengths:
        r = 0.0
        for t in range(at, at + n):
            r = odds[t] * (a[0, 1] + a[1, 1] * r) / (a[0, 0] + a[1, 0] * r)
            assert np.isclose(got[t], r, rtol=1e-6)
        at += n


def test_toxic_words_and_their_inflections_are_found(spark, documents):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        text = talk(rng, "aa", 60).split()
        toxic = i % 4 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["Grumpf", "blargh" + rng.choice(["en", "ung", "t", "st", "er", "é"])]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = documents(rows)
    marked = spark.createDataFrame(labels + [(9999, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, marked.filter("doc_id % 3 <> 1 or doc_id is null"))
    got = {r.doc_id: r for r in toxicity.tag(docs, model).collect()}
    held_out = [i for i in range(600) if i % 3 == 1]
    assert np.mean([(got[i].score >= 0.7) == (i % 4 == 0) for i in held_out]) > 0.98
    spans = {dict(rows)[i][s.start : s.end] for i in held_out for s in got[i].spans}
    assert spans and all(s.startswith(("Grumpf", "blargh")) for s in spans)


def test_toxicity_of_odd_rows(spark, documents):
    rows = odd_rows()
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (7, 0), (-9, 0)], "doc_id long, toxic int")
    got = toxicity.tag(documents(rows), toxicity.learn(documents(rows), labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.spans == [] for r in got if r.doc_id in (3, 4, 5))
    assert toxicity.tag(documents([]), toxicity.fit([], np.zeros(0, bool))).collect() == []


def test_token_labels_explain_each_document_once():
    texts = ["bad x", "bad y", "fine x", "fine y", "worse z", "worse w"]
    parts = [t for _, t in toxicity.tokens(pa.array(texts))]
    row = np.repeat(np.arange(6), np.concatenate([p.lengths for p in parts]))
    found = toxicity.token_labels(row, np.concatenate([p.features for p in parts]), np.array([1, 1, 0, 0, 1, 1], bool))
    assert list(found) == [True, False, True, False, False, False, False, False, True, False, True, False]
