"""Near-duplicate documents by one-permutation MinHash, banded buckets and star-shaped candidates."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripspot.llm.components import components
from tripspot.llm.words import U64, blocks, distinct_sorted, mix, shingles, split_words
from tripspot.operators.rows import checked_broadcast
from tripspot.session import Scratch

BINS = 128
ROWS_PER_BAND = 4
BITMAP = 4096
CENTERS = 64
PAIRS = 512
SKETCH = "id long, n_shingles long, set_a long, set_b long, bands array<long>"


@functools.lru_cache(maxsize=4)
def donors(bins: int) -> np.ndarray:
    """For each bin the order in which it asks other bins for a value: a random walk over all bins, equal for all
    texts and independent between bins."""
    return np.argsort(np.random.default_rng(11).random((bins, bins)), axis=1)


def signatures(row: np.ndarray, value: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """One-permutation signature of each row's set (sorted distinct hashes): the minimum per bin of the hash range.

    Empty bins are filled by optimal densification: each takes the value of the first full bin in its own random
    order, so two sets agree in any bin with their Jaccard similarity, however small they are.
    """
    out = np.zeros((rows, bins), U64)
    full = np.zeros((rows, bins), bool)
    at = (value >> U64(64 - bins.bit_length() + 1)).astype(np.int64)
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1])
    out[row[first], at[first]] = value[first]
    full[row[first], at[first]] = True
    asks = donors(bins)
    r, b = np.nonzero(~full & full.any(axis=1)[:, None])
    for step in range(bins):
        if not len(r):
            break
        donor = asks[b, step]
        found = full[r, donor]
        out[r[found], b[found]] = out[r[found], donor[found]]
        r, b = r[~found], b[~found]
    return out


def band_hashes(signature: np.ndarray, rows_per_band: int) -> np.ndarray:
    """One bucket number for each band of a signature; bands never share buckets."""
    rows, bins = signature.shape
    parts = signature.reshape(rows, bins // rows_per_band, rows_per_band)
    total = np.zeros(parts.shape[:2], U64) + mix(np.arange(1, parts.shape[1] + 1, dtype=U64))
    for j in range(rows_per_band):
        total = mix(total ^ parts[:, :, j]) * U64(0x9E3779B97F4A7C15 + 2 * j)
    return mix(total).view(np.int64)


def _sketch(batches, width, bins, rows_per_band):
    for batch in batches:
        for first, data, offsets in blocks(batch.column("text")):
            n = len(offsets) - 1
            row, value = distinct_sorted(*shingles(split_words(data, offsets), width, True))
            size = np.bincount(row, minlength=n)
            key = np.zeros((2, n), U64)
            if len(row):
                start = np.flatnonzero(np.diff(row, prepend=-1))
                for k in range(2):
                    key[k, row[start]] = np.add.reduceat(mix(value ^ U64(0xA5A5A5A5 + k)), start)
            bands = band_hashes(signatures(row, value, n, bins), rows_per_band)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * bands.shape[1]), pa.array(bands.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(first, n), pa.array(size), *(pa.array(k.view(np.int64)) for k in key), lists],
                ["id", "n_shingles", "set_a", "set_b", "bands"],
            )


def _confirm(batches, width, percent):
    # Few pairs at a time: the sets of both texts are held at once.
    for batch in (b.slice(i, PAIRS) for b in batches for i in range(0, b.num_rows, PAIRS)):
        sides = []
        for name in ("center_text", "text"):
            sets = []
            for _, data, offsets in blocks(batch.column(name)):
                row, value = distinct_sorted(*shingles(split_words(data, offsets), width, True))
                sets += np.split(value, np.searchsorted(row, np.arange(1, len(offsets) - 1)))
            sides.append(sets)
        keep = []
        for a, b in zip(*sides):
            both = np.concatenate([a, b])
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * common >= percent * (len(both) - common) and len(both) > 0)
        yield batch.select(["center", "id"]).filter(pa.array(keep, pa.bool_()))


def _linked(pairs, texts, width, percent):
    """The pairs whose full shingle sets are similar enough."""
    sided = pairs.join(texts, "id").join(texts.select(F.col("id").alias("center"), F.col("text").alias("center_text")), "center")
    return sided.mapInArrow(functools.partial(_confirm, width=width, percent=percent), "center long, id long").distinct()


def _edges(links):
    return functools.reduce(DataFrame.unionByName, links).select(F.col("center").alias("u"), F.col("id").alias("v"))


def _open(members, labels):
    """Members of buckets that hold several components, with their component, the bucket's largest component, and the
    number of members outside it."""
    labelled = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")).drop("center")
    split = (
        labelled.groupBy("bucket", "component")
        .agg(F.count("*").alias("k"))
        .groupBy("bucket")
        .agg(F.max_by("component", F.struct("k", "component")).alias("largest"), (F.sum("k") - F.max("k")).alias("others"))
        .filter("others > 0")
    )
    return labelled.join(split, "bucket")


def _bitmaps(batches, width):
    for batch in batches:
        for first, data, offsets in blocks(batch.column("text")):
            n = len(offsets) - 1
            row, value = distinct_sorted(*shingles(split_words(data, offsets), width, True))
            bits = np.zeros((n, BITMAP), np.uint8)
            bits[row, (value % U64(BITMAP)).astype(np.int64)] = 1
            longs = np.packbits(bits, axis=1).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * longs.shape[1]), pa.array(longs.ravel()))
            ones = bits.sum(axis=1, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(first, n), pa.array(np.bincount(row, minlength=n)), pa.array(ones), lists],
                ["id", "n", "ones", "bits"],
            )


def _may_link(percent):
    """Whether two sets could reach the threshold, by bounds on what they share that are never too low: the smaller of
    their shared parts; and the bits that are set in both bitmaps, with the shingles that share a bit inside a set."""

    def reaches(most):
        return 100 * most >= percent * (F.col("n") + F.col("n_b") - most)

    parts = F.least("shared", "shared_b")
    both = F.aggregate(F.zip_with("bits", "bits_b", lambda x, y: F.bit_count(x.bitwiseAND(y)).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    bits = both + F.least(F.col("n") - F.col("ones"), F.col("n_b") - F.col("ones_b"))
    return F.col("any_text") | F.col("any_text_b") | (reaches(parts) & reaches(F.least(parts, bits)))


def _short_hashes(batches, width):
    for batch in batches:
        for first, data, offsets in blocks(batch.column("text")):
            row, value = distinct_sorted(*shingles(split_words(data, offsets), width, True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row + first)), pa.array((value >> U64(32)).astype(np.uint32).view(np.int32))],
                ["id", "shingle"],
            )


def _shared_parts(ids, texts, width):
    """id, n (shingles), shared (those that another of these ids has too), any_text (the id has several texts), and a
    bitmap of the shingles with its number of ones.

    Two sets share no more than the smaller of their shared parts, which bounds their similarity before any comparison.
    Shingles are compared by 32 bits: a collision makes the bound weaker, never wrong.
    """
    own = texts.join(checked_broadcast(ids), "id", "left_semi")
    hashed = own.mapInArrow(functools.partial(_short_hashes, width=width), "id long, shingle int")
    alone = hashed.groupBy("shingle").agg(F.min("id").alias("id"), F.max("id").alias("last"), F.count("*").alias("times"))
    alone = alone.filter("id = last").groupBy("id").agg(F.sum("times").alias("alone"))
    drawn = own.mapInArrow(functools.partial(_bitmaps, width=width), "id long, n long, ones long, bits array<long>")
    texts_of = drawn.groupBy("id").agg(
        (F.count("*") > 1).alias("any_text"), F.max("n").alias("n"), F.max("ones").alias("ones"), F.first("bits").alias("bits")
    )
    shared = (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared")
    return texts_of.join(alone, "id", "left").select("id", "n", shared, "any_text", "ones", "bits")


def _same_document(sketches, sets, scratch):
    """Pairs of a set's smallest id and an id that has other sets too: each such id ties all its sets together."""
    key = F.struct("set_a", "set_b")
    by_id = sketches.groupBy("id").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    several = scratch.store(by_id.filter("low <> high").select("id"), "several")
    own = sketches.select("id", "set_a", "set_b").join(checked_broadcast(several), "id", "left_semi").distinct()
    centers = sets.select("set_a", "set_b", F.col("id").alias("center"))
    return own.join(centers, ["set_a", "set_b"]).filter("center <> id").select("center", "id").distinct()


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    id_col="doc_id",
    text_col="text",
    width=5,
    percent=80,
    bins=BINS,
    rows_per_band=ROWS_PER_BAND,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Two documents are linked when 100 * shared >= percent * united shingles of `width` words; a component's id is the
    smallest id reachable over links, and that document is kept.

    1. One pass makes each text's set size, a 128-bit key of its set and one bucket per band. Equal sets become one
       node, so groups of copies, however large, cost one row per task.
    2. Each bucket links its members to its smallest id: a star, one candidate per member and never all pairs.
       Candidates are confirmed on the full sets, confirmed ones give components.
    3. A member that its star's centre did not confirm may be like another member. In buckets that still hold several
       components, bounds tell what may still be similar: two sets share no more than the smaller of the parts of
       them that any other such set has, and little more than the bits that their bitmaps share. Sets that cannot
       reach the threshold leave; of the others, those
       outside their bucket's largest component become centres in turn, 64 times as many each round, and are
       compared with members of other components as far as the bound allows. So no link within a bucket is lost, a
       bucket of one component costs nothing more, and a large group of texts that are almost similar enough is told
       apart without comparing its texts.

    With 128 bins and 4 rows a band, a pair at similarity 0.8 shares no bucket with probability (1 - 0.8^4)^32, about
    5e-8. Ids are whole numbers. A null or blank text has no shingles: it is linked with nothing and kept. A null id
    takes no part: its row comes back with component null and kept true. Rows that repeat an id count as one document
    that may have several texts; each row comes back. Extra columns are ignored, an empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketches = scratch.store(
        own.mapInArrow(functools.partial(_sketch, width=width, bins=bins, rows_per_band=rows_per_band), SKETCH), "sketches"
    )
    sets = scratch.store(
        sketches.filter("id is not null and n_shingles > 0")
        .groupBy("set_a", "set_b")
        .agg(F.min("id").alias("id"), F.first("bands").alias("bands")),
        "sets",
    )
    entries = sets.select("id", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("id").alias("center"), F.max("id").alias("last")).filter("center < last")
    members = scratch.store(entries.join(shared.drop("last"), "bucket").distinct(), "members")
    ids = scratch.store(members.select("id").distinct(), "ids")
    texts = own.join(checked_broadcast(ids), "id", "left_semi")
    texts = scratch.store(texts.withColumn("hash", F.xxhash64("text")).dropDuplicates(["id", "hash"]).drop("hash"), "texts")

    pairs = scratch.store(members.filter("id <> center").select("center", "id").distinct(), "pairs")
    compared = [pairs]
    same = _same_document(sketches.filter("id is not null and n_shingles > 0"), sets, scratch)
    links = [scratch.store(_linked(pairs, texts, width, percent), "links"), scratch.store(same, "same")]
    labels = scratch.store(components(_edges(links), scratch), "labels")
    candidates = scratch.store(_open(members, labels), "open")
    shared = scratch.store(_shared_parts(candidates.select("id").distinct(), texts, width), "parts")
    able = shared.filter(F.col("any_text") | (100 * F.col("shared") >= percent * F.col("n")))
    candidates = scratch.store(candidates.select("bucket", "id").join(able, "id"), "able")
    centers, open_members = CENTERS, None
    while True:
        if open_members is None:
            open_members = scratch.store(_open(candidates, labels), "open")
        most = open_members.agg(F.max("others")).first()[0]
        if most is None:
            break
        share = (F.xxhash64("id", "bucket") % 1_000_000 + 1_000_000) / 2_000_000
        stars = open_members.filter((F.col("component") != F.col("largest")) & (share * F.col("others") <= centers))
        other = ["id", "component", "n", "shared", "any_text", "ones", "bits"]
        fresh = (
            stars.join(open_members.select("bucket", *[F.col(c).alias(f"{c}_b") for c in other]), "bucket")
            .filter((F.col("component") != F.col("component_b")) & _may_link(percent))
            .select(F.least("id", "id_b").alias("center"), F.greatest("id", "id_b").alias("id"))
            .distinct()
        )
        fresh = scratch.store(
            fresh.join(functools.reduce(DataFrame.unionByName, compared), ["center", "id"], "left_anti"), "fresh"
        )
        found = scratch.store(_linked(fresh, texts, width, percent), "links")
        if found.head(1):
            compared.append(fresh)
            links.append(found)
            labels, open_members = scratch.store(components(_edges(links), scratch), "labels"), None
        if centers >= most:
            break
        centers *= CENTERS

    scratch.keep_only(sketches, sets, labels)
    by_set = sets.join(labels, "id", "left").select("set_a", "set_b", F.coalesce("component", "id").alias("component"))
    placed = (
        sketches.filter("id is not null and n_shingles > 0").drop("bands").join(by_set, ["set_a", "set_b"])
        .select("id", "n_shingles", "component")
    )
    rest = scratch.store(sketches.filter("id is null or n_shingles = 0").select("id", "n_shingles"), "rest")
    # A row without shingles belongs to the component of its id's other texts.
    others = placed.join(checked_broadcast(rest.select("id").dropna().distinct()), "id", "left_semi").select("id", "component").distinct()
    rest = rest.join(others, "id", "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component"))
    return placed.unionByName(rest).select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
