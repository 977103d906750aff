"""Phrases whose words occur together far more often than apart, by language."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tripspot.llm.hattrie import BURST, CAPACITY, RUN, combine, count_runs, merge_runs
from tripspot.llm.words import U64, blocks, mix, split_words
from tripspot.operators.rows import checked_broadcast
from tripspot.session import Scratch

BREAKS = np.zeros(256, bool)  # bytes that end a piece
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~BREAKS
WORD[[0x20, 0x09]] = False
NO_LANGUAGE = "und"
FILTER_BITS, BLOCK_BITS = 25, 19  # a filter of 4 MB, put together from blocks of 64 KB
PREFIX_WORDS = 1 << 18


def _language_ids(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The language of each row, and a 64-bit number for it."""
    column = pc.fill_null(column, NO_LANGUAGE)
    coded = pc.dictionary_encode(column)
    numbers = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in coded.dictionary.to_pylist()]
    return column, np.array(numbers, U64)[coded.indices.to_numpy()] if len(column) else np.zeros(0, U64)


def _pieces(batches):
    """Of each block of texts: its words, their ids, whether the next word follows in the same piece, and languages.

    A word's id holds its language, so that equal words of two languages are counted apart.
    """
    for batch in batches:
        langs, numbers = _language_ids(batch.column("lang"))
        for first, data, offsets in blocks(batch.column("text")):
            words = split_words(data, offsets, WORD)
            ids = mix(words.hash ^ numbers[first + words.row])
            piece = np.cumsum(BREAKS[words.data], dtype=np.int32)[words.start]
            follows = np.zeros(len(ids), bool)
            follows[:-1] = (words.row[1:] == words.row[:-1]) & (piece[1:] == piece[:-1])
            yield words, ids, follows, langs.slice(first, words.rows)


def _spelled(words, at) -> pa.Array:
    """The words at some places, as text."""
    size = (words.end - words.start)[at]
    offsets = np.concatenate([[0], np.cumsum(size)])
    where = np.repeat(words.start[at] - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(words.data[where].tobytes())])


def _words(batches):
    for words, ids, _, langs in _pieces(batches):
        unique, at, n = np.unique(ids, return_index=True, return_counts=True)
        columns = [pa.array(unique.view(np.int64)), langs.take(pa.array(words.row[at])), _spelled(words, at).cast(pa.string()), pa.array(n)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "lang", "word", "f"])


def _bits(batches):
    """Blocks of the filter as bytes, from places sorted by block."""
    block, bits = None, None
    for batch in batches:
        numbers, places = batch.column("block").to_numpy(), batch.column("place").to_numpy()
        for b in np.unique(numbers):
            if b != block:
                if bits is not None:
                    yield _block(block, bits)
                block, bits = b, np.zeros(1 << BLOCK_BITS, bool)
            bits[places[numbers == b]] = True
    if bits is not None:
        yield _block(block, bits)


def _block(block, bits):
    packed = np.packbits(bits, bitorder="little").tobytes()
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())], ["block", "bits"])


def _places(batches, width):
    for batch in batches:
        keys = np.stack([batch.column(f"w{i + 1}").to_numpy().view(U64) for i in range(width)], axis=1)
        place = (combine(keys) >> U64(64 - FILTER_BITS)).astype(np.int64) if len(keys) else np.zeros(0, np.int64)
        columns = [pa.array((place >> BLOCK_BITS).astype(np.int32)), pa.array((place & ((1 << BLOCK_BITS) - 1)).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, ["block", "place"])


def known_filter(grams: DataFrame, width: int) -> bytes:
    """A bit set of fixed size that says yes for all the n-grams given and for few others. With very many n-grams it
    says yes more often, which costs time and changes no result."""
    places = grams.mapInArrow(functools.partial(_places, width=width), "block int, place int").distinct()
    rows = places.repartition("block").sortWithinPartitions("block").mapInArrow(_bits, "block int, bits binary").collect()
    out = bytearray(1 << (FILTER_BITS - 3))
    size = 1 << (BLOCK_BITS - 3)
    for row in rows:  # at most 64 rows of 64 KB
        out[row["block"] * size : (row["block"] + 1) * size] = row["bits"]
    return bytes(out)


def _known(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = combine(keys) >> U64(64 - FILTER_BITS)
    return (bits[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8) & 1).astype(bool)


def _grams(batches, width, packed):
    """n-grams of which the two parts of one word less are known by the filter."""
    bits = np.frombuffer(packed, np.uint8)
    for _, ids, follows, _ in _pieces(batches):
        whole = len(ids) - width + 1
        if whole <= 0:
            continue
        parts = np.stack([ids[i : len(ids) - width + 2 + i] for i in range(width - 1)], axis=1)
        known = _known(bits, parts)
        inside = known[:-1] & known[1:]
        for i in range(width - 1):
            inside &= follows[i : i + whole]
        yield np.stack([ids[i : i + whole][inside] for i in range(width)], axis=1)


def _count(batches, width, packed, bits, burst, capacity):
    yield from count_runs(_grams(batches, width, packed), width, bits, burst, capacity)


def _score(a, left, right):
    """floor(1000000 a a / (l r)), exact for counts up to 10^15."""
    whole = lambda c: f"cast({c} as decimal(18, 0))"
    return F.expr(f"(cast({whole(a)} * {whole(a)} as decimal(38, 0)) * 1000000) div ({whole(left)} * {whole(right)})")


def collocations(
    docs: DataFrame, scratch: Scratch, text_col="text", lang_col="lang", least=10, top=2000, share=50, burst=BURST, capacity=CAPACITY
) -> DataFrame:
    """Each language's first phrases of two and three words: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; pieces end at `.,;:!?` and line breaks, words at spaces and tabs. A phrase that occurs `least`
    times or more (a) is a candidate. Cut after its first words it has a left and a right part (l, r occurrences) and
    the score floor(1000000 a a / (l r)); its lowest-scoring cut counts, the first of equal ones. A candidate inside a
    longer one with at least `share` percent of its occurrences is dropped. n is the number of words of the language.
    Order: score, then a, descending, then the phrase by bytes.

    Three passes over the texts count words, pairs and triples. A pass counts only n-grams of which both shorter parts
    are frequent, as no other can be; which are goes out as a bit set of fixed size. Each task counts in a HAT-trie of
    bounded size, spills subtrees as sorted runs and the runs are merged by prefix partition, the number of which
    follows the number of words. Everything after that is joins of frequent n-grams.

    Words are told apart by a 64-bit hash; two words that share one stop the job. A null text is empty, a null
    language is `und`. Repeated rows count as often as they occur. Extra columns are ignored; an empty table gives
    no rows.
    """
    own = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counted = own.mapInArrow(_words, "id long, lang string, word string, f long")
    words = scratch.store(counted.groupBy("id", "lang", "word").agg(F.sum("f").alias("f")), "words")
    shared = words.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    if shared:
        raise ValueError("two words share a hash")
    totals = scratch.store(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    n = totals.agg(F.sum("n")).first()[0] or 0
    bits = max(4, (n // PREFIX_WORDS).bit_length())

    def frequent(width, parts):
        count = functools.partial(_count, width=width, packed=known_filter(parts, width - 1), bits=bits, burst=burst, capacity=capacity)
        return scratch.store(merge_runs(own.mapInArrow(count, RUN), width, least), f"grams-{width}")

    single = words.filter(F.col("f") >= least)
    pairs = frequent(2, single.select(F.col("id").alias("w1")))
    triples = frequent(3, pairs.select("w1", "w2"))

    def by(table, name, *ids):
        return table.select(*[F.col(c).alias(i) for c, i in zip(("w1", "w2") if len(ids) == 2 else ("id",), ids)], F.col("f").alias(name))

    inside = triples.select(F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "f")
    inside = inside.groupBy("p.w1", "p.w2").agg(F.max("f").alias("longer"))
    two = (
        pairs.withColumnRenamed("f", "a").join(inside, ["w1", "w2"], "left")
        .filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
        .join(by(single, "l", "w1"), "w1").join(by(single, "r", "w2"), "w2")
        .select("w1", "w2", F.lit(None).cast("long").alias("w3"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    )
    three = (
        triples.withColumnRenamed("f", "a")
        .join(by(pairs, "l2", "w1", "w2"), ["w1", "w2"]).join(by(pairs, "r2", "w2", "w3"), ["w2", "w3"])
        .join(by(single, "l1", "w1"), "w1").join(by(single, "r1", "w3"), "w3")
        .withColumns({"first": _score("a", "l1", "r2"), "second": _score("a", "l2", "r1")})
    )
    early = F.col("first") <= F.col("second")
    three = three.select(
        "w1", "w2", "w3", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("first", "second").alias("score"),
    )
    scored = two.unionByName(three).join(single.select(F.col("id").alias("w1"), "lang"), "w1")
    # All that may be among the first, by numbers alone; then their words decide between equals.
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    kept = scratch.store(scored.withColumn("_rank", F.rank().over(best)).filter(F.col("_rank") <= top).drop("_rank"), "kept")
    used = kept.select(F.explode(F.array("w1", "w2", "w3")).alias("id")).dropna().distinct()
    spelled = scratch.store(single.join(checked_broadcast(scratch.store(used, "used")), "id", "left_semi").select("id", "word"), "spelled")
    for i in (1, 2, 3):
        kept = kept.join(spelled.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"word{i}")), f"w{i}", "left")
    kept = kept.withColumn("phrase", F.concat_ws(" ", "word1", "word2", "word3")).join(checked_broadcast(totals), "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
