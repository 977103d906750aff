"""Benchmark passages in documents, found even when reordered, by greedy string tiling."""

from __future__ import annotations

import functools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tripspot.llm.words import U64, blocks, shingles, split_words
from tripspot.session import Scratch

SEED_WORDS = 4
COVERAGE = 0.5
FILTER_BITS = 24
MASK = (1 << 61) - 1
ROLL = 1_000_003


def greedy_tiles(text: list, pattern: list, shortest: int) -> list[tuple[int, int, int]]:
    """Tiles (start in text, start in pattern, length) of running Karp-Rabin greedy string tiling.

    Windows of a search length are matched by rolling hash among tokens not yet marked, and each match is extended.
    A match of more than twice the search length restarts the search at its length; otherwise all matches are marked,
    longest first (then by place in the text and the pattern), unless a longer one covers part of them; then the
    search length is halved, down to `shortest`. Each token of either side is in one tile at most.
    """
    free_text, free_pattern = [True] * len(text), [True] * len(pattern)
    tiles, size = [], max(shortest, min(len(pattern), 64))
    while True:
        matches = _matches(text, pattern, free_text, free_pattern, size)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * size:
            size = longest
            continue
        again = False
        for p, q, length in sorted(matches, key=lambda m: (-m[2], m[0], m[1])):
            if all(free_text[p : p + length]) and all(free_pattern[q : q + length]):
                free_text[p : p + length] = free_pattern[q : q + length] = [False] * length
                tiles.append((p, q, length))
            else:
                again = True
        if again:  # what is left of a covered match may still be as long
            continue
        if size <= shortest:
            return tiles
        size = max(shortest, size // 2)


def _windows(tokens, free, size):
    """(start, rolling hash) of each window of unmarked tokens."""
    top = pow(ROLL, size - 1, MASK)
    value, run = 0, 0
    for i, token in enumerate(tokens):
        if not free[i]:
            value = run = 0
            continue
        if run == size:
            value = (value - hash(tokens[i - size]) * top) % MASK
            run -= 1
        value = (value * ROLL + hash(token)) % MASK
        run += 1
        if run == size:
            yield i - size + 1, value


def _matches(text, pattern, free_text, free_pattern, size):
    """Maximal matches of at least `size` unmarked tokens, each once."""
    at = defaultdict(list)
    for p, value in _windows(text, free_text, size):
        at[value].append(p)
    found = []
    for q, value in _windows(pattern, free_pattern, size):
        for p in at.get(value, ()):
            if p and q and free_text[p - 1] and free_pattern[q - 1] and text[p - 1] == pattern[q - 1]:
                continue  # part of the match that began earlier
            n = 0
            while (
                p + n < len(text) and q + n < len(pattern)
                and free_text[p + n] and free_pattern[q + n] and text[p + n] == pattern[q + n]
            ):
                n += 1
            if n >= size:
                found.append((p, q, n))
    return found


def _seeds(batches, width):
    """Of each item its words' hashes, and its seeds: the hash of each run of `width` words."""
    for batch in batches:
        for first, data, offsets in blocks(pc.utf8_lower(batch.column("text"))):
            words = split_words(data, offsets)
            n = len(offsets) - 1
            row, value = shingles(words, width, False)
            count, seeds = np.bincount(words.row, minlength=n), np.bincount(row, minlength=n)
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(c)]).astype(np.int32)), pa.array(v.view(np.int64))
                )
                for c, v in ((count, words.hash), (seeds, value))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(first, n), *lists], ["item_id", "words", "seeds"])


def _hits(batches, width, packed):
    """Places in each text that may begin a seed of some item."""
    bits = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)
    for batch in batches:
        for first, data, offsets in blocks(pc.utf8_lower(batch.column("text"))):
            words = split_words(data, offsets)
            row, value = shingles(words, width, False)
            hit = np.flatnonzero(bits[(value >> U64(64 - FILTER_BITS)).astype(np.int64)])
            if len(hit):
                begin = np.searchsorted(row, row[hit])
                rows = pa.array(row[hit] + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("at").take(rows), batch.column("id").take(rows), pa.array(hit - begin), pa.array(value[hit].view(np.int64))],
                    ["at", "id", "place", "seed"],
                )


def _tile(batches, shortest):
    for batch in batches:
        out = []
        for words, pairs in zip(batch.column("words").to_pylist(), batch.column("pairs").to_pylist()):
            # Words of the text where seeds lie, known from the item; regions are kept apart by what equals no word.
            known = {}
            for pair in pairs:
                for j in range(shortest):
                    known[pair["place"] + j] = words[pair["item_place"] + j]
            text, last = [], None
            for place in sorted(known):
                if last is not None and place != last + 1:
                    text.append(("gap", place))
                text.append(known[place])
                last = place
            lengths = [t[2] for t in greedy_tiles(text, words, shortest)]
            out.append((len(words), sum(lengths), len(lengths), max(lengths, default=0)))
        columns = [pa.array([o[i] for o in out], pa.int32()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("item_id"), *columns],
            ["id", "item_id", "item_words", "matched_words", "tiles", "longest"],
        )


def seed_filter(seeds: DataFrame) -> bytes:
    """A fixed-size bit set of all seeds' first bits: 2 MB however many items there are. With very many items it
    only lets more places through to the exact join."""
    at = F.shiftrightunsigned("seed", 64 - FILTER_BITS)
    words = seeds.select(F.shiftright(at, 5).alias("word"), at.bitwiseAND(F.lit(31)).cast("int").alias("bit"))
    mask = F.expr("bit_or(shiftleft(1L, bit))")
    rows = words.groupBy("word").agg(mask.alias("mask")).collect()  # at most 2^(FILTER_BITS - 5) rows
    bits = np.zeros(1 << FILTER_BITS, np.uint8)
    for r in rows:
        bits[r["word"] * 32 + np.flatnonzero(r["mask"] >> np.arange(32) & 1)] = 1
    return np.packbits(bits).tobytes()


def contaminated_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    scratch: Scratch,
    id_col="doc_id",
    text_col="text",
    seed_words=SEED_WORDS,
    coverage=COVERAGE,
) -> DataFrame:
    """id, item_id, item_words, matched_words, tiles, longest, coverage for each document and benchmark item of which
    non-overlapping matches of `seed_words` words or more cover at least `coverage` of the item's words.

    Words are lower-cased and compared by 64-bit hash. One pass over the texts keeps the places of runs of
    `seed_words` words that a bit set of the items' runs may know; an exact join on the run's hash gives pairs of
    document and item. Pairs with fewer different item places than the needed tiles must have are left out before
    tiling, which loses nothing. A run that occurs in a third of the documents costs one row for each of them and
    item, as the result may need it.

    A null or blank text matches nothing; an item with fewer words than a run cannot be found. Repeated rows of a
    document give repeated pairs, repeated rows of an item one. Null ids are kept as they are in `docs`; items with a
    null id or text are left out. Either table empty: no rows.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna()
    items = items.withColumn("_hash", F.xxhash64("text")).dropDuplicates(["item_id", "_hash"]).drop("_hash")
    items = scratch.store(
        items.mapInArrow(functools.partial(_seeds, width=seed_words), "item_id long, words array<long>, seeds array<long>")
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    seeds = items.select("item", F.posexplode("seeds").alias("item_place", "seed"))
    own = docs.select(
        F.monotonically_increasing_id().alias("at"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )
    scan = functools.partial(_hits, width=seed_words, packed=seed_filter(seeds))
    hits = scratch.store(own.mapInArrow(scan, "at long, id long, place long, seed long"), "hits")
    # Tiles of n words in all and of `seed_words` at least each begin no fewer than n / seed_words seeds.
    least = F.ceil(F.size("words") * F.lit(coverage) / seed_words)
    pairs = (
        hits.join(seeds, "seed")
        .groupBy("at", "item")
        .agg(F.first("id").alias("id"), F.collect_list(F.struct("place", "item_place")).alias("pairs"))
        .join(items.drop("seeds"), "item")
        .filter(F.size(F.array_distinct("pairs.item_place")) >= least)
        .select("id", "item_id", "words", "pairs")
    )
    tiled = pairs.mapInArrow(
        functools.partial(_tile, shortest=seed_words),
        "id long, item_id long, item_words int, matched_words int, tiles int, longest int",
    )
    covered = F.col("matched_words") / F.col("item_words")
    return tiled.withColumn("coverage", covered).filter(F.col("coverage") >= coverage).withColumnRenamed("id", id_col)
