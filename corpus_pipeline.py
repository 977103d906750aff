"""From raw documents to a training set: each stage works on what the one before it kept.

`docs` has the columns of `documents`, and may have more, which are dropped. Rows that repeat an id, or have none, are
decided upon each for itself: stages tell rows apart by file and place. A stage stores no texts of its own but those
that near duplicates are compared by, and these go before it returns.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tripspot.llm import language
from tripspot.llm.base import workspace
from tripspot.llm.decontaminate import contaminated_pairs
from tripspot.llm.mixing import mix_sources
from tripspot.llm.near_dedup import near_duplicates
from tripspot.llm.sharding import contiguous_shards
from tripspot.operators.rows import checked_broadcast
from tripspot.session import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARDS = 24


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Texts without a letter, null ones among them, go: no language can be told. All others stay as they are, also
    if no row has a language to learn from."""
    workspace(spark, "language-id")
    model = language.learn(docs)
    kept = language.predict(docs, model, carry=tuple(COLUMNS[2:]), unlearned="unlearned")
    return kept.filter(F.col("lang_pred") != language.UNKNOWN).select(*COLUMNS)


def numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows with a number of their own each, `_row`, which stays the same however often they are read.

    Rows read from Parquet files are numbered by file and place in it, without a copy of the texts; the files' numbers
    are one row for each file. Rows that do not come from files are written with a number first.
    """
    try:
        placed = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    except AnalysisException:
        return scratch.store(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "numbered")
    number = F.row_number().over(Window.orderBy("_file")).cast("long")
    files = scratch.store(placed.select("_file").distinct().withColumn("_number", number), "files")
    row = F.shiftleft("_number", 40).bitwiseOR(F.col("_at")).alias("_row")
    return placed.join(checked_broadcast(files), "_file").select(*COLUMNS, row)


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows whose number is not in `dropped`."""
    return rows.join(checked_broadcast(dropped), "_row", "left_anti").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the row with the smallest id stays, of several the one with
    the smallest number. A row without an id stays only if no row of its group has one."""
    scratch = scratch or workspace(spark, "near-dedup")
    rows = numbered(docs, scratch)
    with workspace(spark, "near-dedup-work") as work:
        groups = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), work)
        copies = work.store(groups.filter("not kept").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")), "copies")
        members = copies.unionByName(copies.select(F.col("_group").alias("_row"), "_group").distinct())
        members = work.store(members.join(rows.select("_row", F.col("doc_id").alias("_id")), "_row"), "members")
        order = F.struct(F.col("_id").isNull(), "_id", "_row")
        first = work.store(members.groupBy("_group").agg(F.min_by("_row", order).alias("_first")), "first")
        dropped = members.join(checked_broadcast(first), "_group").filter(F.col("_row") != F.col("_first"))
        dropped = scratch.store(dropped.select("_row"), "dropped")
    return without(rows, dropped)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents that hold half of a benchmark item or more, in any order, go."""
    scratch = scratch or workspace(spark, "decontaminate")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = numbered(docs, scratch)
    with workspace(spark, "decontaminate-work") as work:
        pairs = contaminated_pairs(rows.select(F.col("_row").alias("doc_id"), "text"), benchmark, work)
        dropped = scratch.store(pairs.select(F.col("doc_id").alias("_row")).distinct(), "dropped")
    return without(rows, dropped)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Each document as many times as the target of its source asks for: not at all, once or twice. Numbers of copies
    are decided on rows without texts, and then joined to the texts once."""
    scratch = scratch or workspace(spark, "mix")
    rows = numbered(docs, scratch)
    with workspace(spark, "mix-work") as work:
        copies = mix_sources(rows, work, carry=("_row",)).filter("copies > 0").select("_row", "copies")
        copies = scratch.store(copies, "copies")
    copied = rows.join(checked_broadcast(copies), "_row")
    return copied.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Where each row goes: shard and slot, by near-equal bytes."""
    return contiguous_shards(docs, scratch or workspace(spark, "shard"), SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]
ORACLE_SQL = None  # SQL expresses neither the classifier nor the tiling


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again. What a stage has stored for itself
    goes when its output is written, and so does the output of the stage before it."""
    scratch = workspace(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with workspace(spark, name) as own:
            docs = scratch.store(stage(spark, docs, sf_dir, own), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir, scratch)
