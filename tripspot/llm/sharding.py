"""Contiguous shards of near-equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripspot.llm.prefix import prefix_sums
from tripspot.session import Scratch

ROW_BYTES = 8


def contiguous_shards(
    docs: DataFrame, scratch: Scratch, shards=24, id_col="doc_id", text_col="text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of `docs`: id, size, text_crc32, law, shard, slot, grown_shard, and the columns to carry.

    Rows in the order of their id (null first; then size, checksum and place in the input) form one sequence of bytes.
    It is cut at equal targets: a row belongs to the shard that its middle byte falls into, so two shards' sizes
    differ by less than the largest row. Slots count from 0 within a shard, in the same order.

    Size is the text's UTF-8 bytes plus 8; a null text has 8 bytes and checksum 0. Repeated rows and repeated ids are
    rows of their own. Fewer rows than shards leave shards empty; an empty table gives no rows. `grown_shard` is null:
    the law is `bytes`, not `key`. Without `carry` only these narrow columns are sorted, never the texts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("amount"),
        F.crc32(text).alias("text_crc32"),
        F.lit(0).cast("long").alias("group"),
        F.monotonically_increasing_id().alias("_at"),
        *[F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)],
    )
    # The sort looks at its input twice; narrow rows are written first so that texts are read once.
    rows = rows if carry else scratch.store(rows, "sizes")
    summed = prefix_sums(rows, ["_id", "amount", "text_crc32", "_at"], scratch)
    total = summed.agg(F.sum("amount")).first()[0] or 1
    middle = (2 * F.col("before") + F.col("amount")) * shards
    cut = summed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle / F.lit(2 * total))).cast("int"))
    first = cut.groupBy("shard").agg(F.min("position").alias("first"))  # one row for each shard
    return cut.join(F.broadcast(first), "shard").select(
        F.col("_id").alias(id_col),
        F.col("amount").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)],
    )
