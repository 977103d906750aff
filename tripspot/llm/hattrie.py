"""Counts of word n-grams: a HAT-trie in each task, spilled as sorted runs that are merged per prefix partition."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripspot.llm.words import U64, mix

DIGIT = 4  # bits of a word's id that a trie level branches on
BURST = 1 << 16
CAPACITY = 3 << 19
RUN = "prefix int, keys binary, counts binary"
MERGED = 1 << 20


def combine(keys: np.ndarray) -> np.ndarray:
    """One hash of each row of ids."""
    out = mix(keys[:, 0])
    for column in keys.T[1:]:
        out = mix(out * U64(0x9E3779B97F4A7C15) + column)
    return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.lexsort(keys.T[::-1])
    keys, counts = keys[order], counts[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    at = np.flatnonzero(first)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


class Container:
    """Counts by key in an open-addressing hash table; many keys are added at once, repeated ones among them."""

    def __init__(self, width: int, slots=256):
        self.keys, self.counts = np.zeros((slots, width), U64), np.zeros(slots, np.int64)
        self.size = 0

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        full = self.counts > 0
        return self.keys[full], self.counts[full]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        slots = len(self.counts)
        if 2 * (self.size + len(keys)) > slots:
            own = self.items()
            self.__init__(keys.shape[1], 1 << int(2 * (self.size + len(keys))).bit_length())
            slots = len(self.counts)
            if len(own[0]):
                self.add(*own)
        slot = (combine(keys) >> U64(8)).astype(np.int64) & (slots - 1)
        left, owner = np.arange(len(keys)), np.empty(slots, np.int64)
        while len(left):
            at = slot[left]
            empty = self.counts[at] == 0
            owner[at[empty]] = left[empty]
            won = left[empty][owner[at[empty]] == left[empty]]  # one key for each empty slot
            self.keys[slot[won]] = keys[won]
            self.size += len(won)
            taken = np.zeros(len(left), bool)
            taken[empty] = True
            same = (self.keys[at] == keys[left]).all(axis=1) & (~empty | taken)
            np.add.at(self.counts, at[same], counts[left[same]])
            left = left[~same]
            slot[left] = (slot[left] + 1) & (slots - 1)


class HatTrie:
    """Counts of n-grams of word ids. A level of the trie branches on the first bits of the next word's id; below it lie
    hash containers, and one that holds more than `burst` keys becomes a node with a container for each branch.

    When more than `capacity` keys are held, whole subtrees, the largest first, are spilled until half of it is free.
    """

    def __init__(self, width: int, burst=BURST, capacity=CAPACITY):
        self.width, self.burst, self.capacity = width, burst, capacity
        self.root: list = [None] * (1 << DIGIT)

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        self._add(self.root, 0, keys, np.ones(len(keys), np.int64) if counts is None else counts)

    def _add(self, node, level, keys, counts):
        digit = (keys[:, level] >> U64(64 - DIGIT)).astype(np.uint8)
        order = np.argsort(digit, kind="stable")
        bounds = np.searchsorted(digit[order], np.arange(len(node) + 1))
        for d in np.flatnonzero(np.diff(bounds)):
            part = order[bounds[d] : bounds[d + 1]]
            if isinstance(node[d], list):
                self._add(node[d], level + 1, keys[part], counts[part])
                continue
            node[d] = node[d] or Container(self.width)
            node[d].add(keys[part], counts[part])
            if node[d].size > self.burst and level + 1 < self.width:
                full, node[d] = node[d], [None] * (1 << DIGIT)
                self._add(node[d], level + 1, *full.items())

    def size(self, node=None) -> int:
        if isinstance(node, Container):
            return node.size
        return sum(self.size(c) for c in (self.root if node is None else node) if c is not None)

    def _items(self, node):
        if isinstance(node, Container):
            return [node.items()]
        return [i for child in node if child is not None for i in self._items(child)]

    def spill(self, everything=False):
        """Subtrees as (keys, counts), taken out of the trie: all, or as many as free half of the capacity."""
        sizes = {d: self.size(c) for d, c in enumerate(self.root) if c is not None}
        held = sum(sizes.values())
        if held <= self.capacity and not everything:
            return
        for d in sorted(sizes, key=sizes.get, reverse=True):
            if not everything and 2 * held <= self.capacity:
                return
            items = self._items(self.root[d])
            self.root[d] = None
            held -= sizes[d]
            yield np.concatenate([k for k, _ in items]), np.concatenate([c for _, c in items])


def prefixes(keys: np.ndarray, bits: int) -> np.ndarray:
    """The prefix partition of each key: half of the bits from the first word, half from the second, so that the n-grams
    of one frequent first word are spread, too."""
    first, second = bits - bits // 2, bits // 2
    out = (keys[:, 0] >> U64(64 - first)).astype(np.int64) << second
    if second and keys.shape[1] > 1:
        out |= (keys[:, 1] >> U64(64 - second)).astype(np.int64)
    return out


def sorted_run(keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """A subtree in the order of prefix and key: one row for each prefix partition."""
    prefix = prefixes(keys, bits)
    order = np.lexsort((*keys.T[::-1], prefix))
    prefix, keys, counts = prefix[order], np.ascontiguousarray(keys[order]), counts[order]
    start = np.flatnonzero(np.diff(prefix, prepend=-1))
    bounds = np.append(start, len(prefix))
    binary = lambda x, size: pa.Array.from_buffers(
        pa.binary(), len(start), [None, pa.py_buffer((bounds * size).astype(np.int32)), pa.py_buffer(x.tobytes())]
    )
    columns = [pa.array(prefix[start], pa.int32()), binary(keys, 8 * keys.shape[1]), binary(counts.astype(np.uint32), 4)]
    return pa.RecordBatch.from_arrays(columns, ["prefix", "keys", "counts"])


def count_runs(grams, width: int, bits: int, burst=BURST, capacity=CAPACITY):
    """Sorted runs of the counts of n-grams, given as arrays of ids."""
    trie = HatTrie(width, burst, capacity)
    for keys in grams:
        for i in range(0, len(keys), capacity // 2):
            trie.add(keys[i : i + capacity // 2])
            for subtree in trie.spill():
                yield sorted_run(*subtree, bits)
    for subtree in trie.spill(everything=True):
        yield sorted_run(*subtree, bits)


def _bytes(column: pa.BinaryArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column end to end, and each row's number of them."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    size = np.dtype(kind).itemsize
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // size


def _merge(batches, width, least):
    """Runs in the order of their prefix partition, merged: a partition is finished when the next begins."""
    names = [f"w{i + 1}" for i in range(width)]

    def finished(keys, counts):
        enough = counts >= least
        columns = [pa.array(k.view(np.int64)) for k in np.ascontiguousarray(keys[enough].T)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts[enough])], [*names, "f"])

    held_prefix, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        prefix = batch.column("prefix").to_numpy()
        counts, size = _bytes(batch.column("counts"), np.uint32)
        keys = _bytes(batch.column("keys"), U64)[0].reshape(-1, width)
        at = np.append(0, np.cumsum(size))
        split = int(at[np.searchsorted(prefix, prefix[-1])])  # where the last prefix begins
        counts = counts.astype(np.int64)
        if held_prefix is not None and prefix[0] != held_prefix:
            yield finished(*_joined(held))
            held = []
        if prefix[0] != prefix[-1]:
            yield finished(*_joined([*held, (keys[:split], counts[:split])]))
            held, keys, counts = [], keys[split:], counts[split:]
        held.append((keys, counts))
        held_prefix = prefix[-1]
        if sum(len(k) for k, _ in held) > MERGED:
            held = [_joined(held)]
    if held:
        yield finished(*_joined(held))


def _joined(runs):
    return summed(np.concatenate([k for k, _ in runs]), np.concatenate([c for _, c in runs]))


def merge_runs(runs: DataFrame, width: int, least: int) -> DataFrame:
    """(w1, ..., f) of the n-grams counted at least `least` times, from runs of all tasks.

    Rows of runs are dealt out and sorted by prefix partition; a task merges one partition at a time and holds no more
    than its distinct keys."""
    schema = "".join(f"w{i + 1} long, " for i in range(width)) + "f long"
    dealt = runs.repartition("prefix").sortWithinPartitions("prefix")
    return dealt.mapInArrow(functools.partial(_merge, width=width, least=least), schema)
