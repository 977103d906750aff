import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from tripspot.llm.base import workspace  # noqa: E402

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHING = [
    "id", "at", "group", "amount", "part", "position", "before", "hash", "component", "component_id", "center", "score",
    "size", "source_size", "target", "taken", "copies", "shard", "slot", "spans", "base", "place", "seed", "item", "bucket",
    "words", "rank", "vector", "block", "digest", "first", "kept", "edits", "held_out", "offset", "rate", "number", "weight",
]


@pytest.fixture
def scratch(spark):
    with workspace(spark, "test") as scratch:
        yield scratch


CONVERSATION = "conv_id long, turn long, role string, text string"
CLASHING_TURNS = ["conv", "part", "open", "digest", "initial", "fault", "rows", "turns", "_at", "copy", "loss", "formatted", "audit", "cost"]


@pytest.fixture
def conversations(spark):
    """A table of conversations, with columns whose names clash."""

    def make(rows, parts=3):
        table = spark.createDataFrame(rows, CONVERSATION)
        for name in CLASHING_TURNS:
            table = table.withColumn(name, table.text)
        return table.repartition(parts)

    return make


@pytest.fixture
def small_batches(spark):
    """Batches of few rows, so that conversations are cut into parts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def documents(spark):
    """A table of documents, with columns whose names clash."""

    def make(rows, clash=True):
        rows = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        docs = spark.createDataFrame(rows, DOCUMENT)
        for name in CLASHING if clash else ():
            docs = docs.withColumn(name, docs.text)
        return docs.repartition(3)

    return make
