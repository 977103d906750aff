"""The pipeline's stages on small documents, each against what it must keep, and the whole run against brute force."""

import random

import pytest

import corpus_pipeline as pipeline
from odd import odd_rows
from test_near_dedup import brute
from tripspot.llm.decontaminate import SEED_WORDS
from test_tiling import brute_tiles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    words = lambda k, n: [f"{k}{rng.randrange(900)}" for _ in range(n)]
    items = [words("item", 30) for _ in range(3)]
    rows = []
    for i in range(160):
        text = words("en" if i % 2 else "der", 50)
        rows.append((i, " ".join(text), "en" if i % 2 else "de", f"s{i % 3}" if i % 7 else None, 1))
    for i in range(160, 190):  # near copies
        text = rows[i - 160][1].split()
        text[i % 50] = "edited"
        rows.append((i, " ".join(text), *rows[i - 160][2:]))
    for i in range(190, 196):  # leaks, half of them reordered
        item = items[i % 3]
        rows.append((i, " ".join(words("en", 20) + item[15:] + words("en", 3) + item[:15]), "en", "s1", 1))
    rows += [(196, None, "en", "s1", 0), (197, "1234 ??", "en", "s1", 0), (198, "", None, None, None)]
    path = tmp_path_factory.mktemp("tables")
    schema = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long"])
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(map(" ".join, items))), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_stages_in_order(spark, folder):
    path, rows, items = folder
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == COLUMNS
        kept[name] = sorted(r.doc_id for r in docs.collect())
    assert kept["language_id"] == list(range(196))
    groups = brute([r[:2] for r in rows[:196]], 5)
    assert kept["near_dedup"] == sorted(i for i, c in groups.items() if i == c) and len(kept["near_dedup"]) < 190
    clean = []
    for i in kept["near_dedup"]:
        covered = [sum(n for *_, n in brute_tiles(rows[i][1].split(), item, SEED_WORDS)) / 30 for item in items]
        clean += [i] if max(covered) < 0.5 else []
    assert kept["decontaminate"] == clean and len(clean) == len(kept["near_dedup"]) - 6
    assert set(kept["mix"]) <= set(clean) and max(kept["mix"].count(i) for i in clean) == 2
    placed = pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert sorted(r.doc_id for r in placed) == kept["mix"]
    run = pipeline.run(spark, path).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, placed))


def test_stages_bear_odd_rows(spark, folder, documents):
    for _, stage in pipeline.STAGES:
        out = stage(spark, documents(odd_rows()), folder[0])
        assert out.count() > 0
        assert stage(spark, documents([]), folder[0]).collect() == []
    none = documents([(None, "same words in here", None, None, None)] * 3)
    assert pipeline.near_dedup(spark, none, folder[0]).count() == 1


def test_lettered_texts_stay_when_no_language_is_known(spark, folder, documents):
    docs = documents([(*r[:2], None, *r[3:]) for r in odd_rows()] + [(20, "4711 ##"), (21, "éa")])
    kept = pipeline.language_id(spark, docs, folder[0]).collect()
    lettered = [str(i) for i, t, *_ in odd_rows() if t and any(c.isalpha() for c in t)] + ["21"]
    assert sorted(str(r.doc_id) for r in kept) == sorted(lettered)


def test_rows_are_dropped_by_themselves(spark, folder, documents):
    path, _, items = folder
    leak, clean, other = " ".join(items[0]), "a clean text of the same id as the leak", "words that nothing else here has at all"
    rows = [(None, leak), (None, clean), (5, leak), (5, clean), (6, other)]
    kept = pipeline.decontaminate(spark, documents(rows), path).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("5", clean), ("6", other), ("None", clean)]
    rows = [(9, leak), (7, leak), (8, leak), (7, clean), (8, other), (8, other), (None, other)]
    kept = pipeline.near_dedup(spark, documents(rows), path).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("7", clean), ("7", leak), ("8", other)]


def test_rows_of_files_are_numbered_without_a_copy(spark, scratch, tmp_path, documents):
    documents([(1, "a"), (1, "a"), (None, "b"), (2, None)] * 5).repartition(4).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    first, again = (pipeline.numbered(docs, scratch) for _ in range(2))
    numbers = {r._row: (r.doc_id, r.text) for r in first.collect()}
    assert len(numbers) == 20 and numbers == {r._row: (r.doc_id, r.text) for r in again.repartition(3).collect()}
    assert all("numbered" not in p for p, _ in scratch.tables.values())


def test_only_the_last_tables_are_left(spark, folder):
    from pathlib import Path

    from tripspot.session import shared_dir

    root = Path(shared_dir(spark).removeprefix("file:"))
    before = {p for p in root.iterdir()}
    result = pipeline.run(spark, folder[0])
    new = {p.name.rsplit("-", 1)[0] for p in root.iterdir() if p not in before and any(p.rglob("*.parquet"))}
    assert new == {"pipeline"}
    left = {p.name.rsplit("-", 1)[0] for q in root.iterdir() if q not in before for p in q.iterdir()}
    assert left <= {"mix", "sizes", "placed", "offsets"} and result.count() > 0
