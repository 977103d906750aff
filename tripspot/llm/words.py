"""Words of whole texts as 64-bit hashes, computed on the buffers of Arrow batches.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 no other character holds such a byte. Nothing
here loops over words or characters in Python.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 4 << 20  # bytes of text worked on at once; one longer text is a block of its own
PIECE = 1 << 20
U64 = np.uint64
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15 | 1
VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) | U64(1)


class Words(NamedTuple):
    """Words of some rows: row number, hash, and byte offsets in `data`."""

    row: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    rows: int


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    return powers(PIECE + 1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        values = np.full(n, base, U64)
        values[0] = 1
        out.append(np.multiply.accumulate(values))
    return tuple(out)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes; both borders must not decrease. Equal bytes have equal hashes anywhere."""
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE, "right")))
        first, last = int(start[i]), int(end[j - 1])
        up, down = _powers() if last - first <= PIECE else powers(last - first + 1)
        sums = np.zeros(last - first + 1, U64)
        np.cumsum(VALUES[data[first:last]] * up[: last - first], out=sums[1:])
        s = start[i:j] - first
        out[i:j] = (sums[end[i:j] - first] - sums[s]) * down[s]
        i = j
    return mix(out)


def blocks(texts: pa.Array):
    """(first row, data, row offsets) for runs of rows of about BLOCK bytes; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def runs(inside: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values; a run never crosses a border between rows."""
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    before[borders] = False
    start = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(inside) + 1, bool)
    after[:-1] = inside
    after[borders] = False
    end = np.flatnonzero(inside & ~after[1:]) + 1
    return start, end


def split_words(data: np.ndarray, offsets: np.ndarray, word=WORD, lower=True) -> Words:
    """Words of one block, A-Z lower-cased unless told otherwise."""
    data = LOWER[data] if lower else data
    start, end = runs(word[data], offsets)
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(row, hash_spans(data, start, end), start, end, data, len(offsets) - 1)


def count_words(texts: pa.Array) -> np.ndarray:
    """Number of words of each text."""
    out = np.zeros(len(texts), np.int64)
    for first, data, offsets in blocks(texts):
        start, _ = runs(WORD[data], offsets)
        out[first : first + len(offsets) - 1] = np.diff(np.searchsorted(start, offsets))
    return out


def shingles(words: Words, width: int, short_as_one: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of `width` words, in text order.

    With `short_as_one`, the whole sequence of a shorter text of at least one word counts as its only shingle.
    """
    factors = mix(np.arange(1, width + 1, dtype=U64)) | U64(1)
    n = len(words.hash)
    whole = max(0, n - width + 1)
    total = np.zeros(whole, U64)
    for j in range(width):
        total += words.hash[j : j + whole] * factors[j]
    same = words.row[:whole] == words.row[width - 1 :] if whole else np.zeros(0, bool)
    row, value = words.row[:whole][same], mix(total[same])
    if short_as_one and n:
        first = np.flatnonzero(np.diff(words.row, prepend=-1))
        length = np.diff(np.append(first, n))
        few, size = first[length < width], length[length < width]
        if len(few):
            total = np.zeros(len(few), U64)
            for j in range(width - 1):
                has = size > j
                total[has] += words.hash[few[has] + j] * factors[j]
            row = np.concatenate([row, words.row[few]])
            value = np.concatenate([value, mix(total + size.astype(U64))])
            order = np.argsort(row, kind="stable")
            row, value = row[order], value[order]
    return row, value


def distinct_sorted(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, ascending within the row. `row` must not decrease."""
    value = value.copy()
    first = np.flatnonzero(np.diff(row, prepend=-1))
    for i, j in zip(first, np.append(first[1:], len(row))):
        value[i:j].sort()
    keep = np.ones(len(row), bool)
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return row[keep], value[keep]
