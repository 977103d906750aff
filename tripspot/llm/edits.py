"""Token counts that follow edits: per-document segment trees over runs of pre-tokens."""

from __future__ import annotations

import base64
import functools
import re
from bisect import bisect_right
from typing import NamedTuple

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pre-token pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 512  # characters after which a leaf ends at the next safe cut
COUNTED = (
    "id long, n_tokens long, n_tokens_edited long, n_edits long, n_leaves long, leaves_encoded long, chars_encoded long"
)
# A space between two characters that are no white space always begins a pre-token, so no token crosses it; nor does one
# cross the border of a Latin letter and a digit.
CUT = re.compile(r"(?<=\S) (?=\S)|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
TREES = "id long, pieces array<string>, sums array<long>"
EDITED = "n_tokens long, n_tokens_edited long, n_edits long, leaves_encoded long, chars_encoded long"
PRIVATE = re.compile(
    r"(?P<EMAIL>[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})|(?P<SECRET>AKIA[A-Z0-9]{16,}|[0-9a-f]{24,})|(?P<NUMBER>[0-9]{9,})"
)


class Edit(NamedTuple):
    """Replace text[start:end]; places are code points of the text before any edit."""

    start: int
    end: int
    text: str


def redactions(text: str) -> list[Edit]:
    """Replace mail addresses, keys and long numbers by the name of what they are."""
    return [Edit(m.start(), m.end(), f"<{m.lastgroup}>") for m in PRIVATE.finditer(text)]


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """Function from a text to its number of tokens; loaded once for each Python worker."""
    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text)) if text else 0


def leaves(text: str, size=LEAF) -> list[str]:
    """The text as runs of whole pre-tokens, each of `size` characters and on to the next safe cut."""
    out, begin = [], 0
    while begin < len(text):
        cut = CUT.search(text, begin + size)
        end = cut.start() if cut else len(text)
        out.append(text[begin:end])
        begin = end
    return out


def is_cut(left: str, right: str) -> bool:
    """Whether the border of two pieces is a safe cut."""
    return bool(CUT.match(left[-1] + right[:2], 1))


def _tree_rows(ids, trees, more=()):
    """A batch of trees as they are kept."""
    columns = [ids, pa.array([t.pieces for t in trees], pa.list_(pa.string())), pa.array([t.sums for t in trees], pa.list_(pa.int64()))]
    names = ["id", "pieces", "sums"]
    for name, values in more:
        columns, names = [*columns, pa.array(values, pa.int64())], [*names, name]
    return pa.RecordBatch.from_arrays(columns, names)


def orderly(edits, length: int) -> list[Edit]:
    """Edits in order of place, within the text; one that begins inside the one before it is left out."""
    out, end = [], 0
    for edit in sorted(Edit(min(max(0, e.start), length), min(max(0, e.end), length), e.text or "") for e in edits):
        if edit.end >= edit.start >= end:
            out.append(edit)
            end = edit.end
    return out


class SegmentTree:
    """Leaves of a text with their token counts, and the sum of each subtree, kept true under edits."""

    def __init__(self, text: str, count, size=LEAF, kept: tuple[list, list] | None = None):
        self.count = count
        self.encoded = self.encoded_chars = 0
        if kept is not None:  # leaves and sums of an earlier tree: nothing is encoded
            self.pieces, self.sums = kept
            self.width = len(self.sums) // 2
            return
        self.pieces = leaves(text, size) or [""]
        self.width = 1 << (len(self.pieces) - 1).bit_length()
        self.sums = [0] * (2 * self.width)
        for i, piece in enumerate(self.pieces):
            self.sums[self.width + i] = count(piece)
        for node in range(self.width - 1, 0, -1):
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def total(self) -> int:
        return self.sums[1]

    def apply(self, edits: list[Edit]) -> None:
        """Apply orderly edits to this text. Only leaves that they touch are encoded again, joined with a neighbour
        where the border between them is no safe cut any more; then the sums above those leaves are renewed."""
        starts, at = [], 0
        for piece in self.pieces:
            starts.append(at)
            at += len(piece)
        dirty = set()
        for edit in reversed(edits):  # right to left, so that places before an edit stay as they were
            first = bisect_right(starts, edit.start) - 1
            last = max(first, bisect_right(starts, edit.end - 1) - 1)
            for i in range(last, first - 1, -1):
                piece, begin = self.pieces[i], max(0, edit.start - starts[i])
                # An edit at the right of this one may have changed what follows; cut by what this edit removes.
                end = min(edit.end - starts[i], (starts[i + 1] if i + 1 < len(starts) else at) - starts[i])
                self.pieces[i] = piece[:begin] + (edit.text if i == first else "") + piece[end:]
                dirty.add(i)
        self._before, self._after = list(range(-1, len(self.pieces) - 1)), list(range(1, len(self.pieces) + 1))
        for i in sorted(dirty):
            self._join(i, dirty)
        for i in sorted(dirty):
            self.encoded += bool(self.pieces[i])
            self.encoded_chars += len(self.pieces[i])
            node = self.width + i
            self.sums[node] = self.count(self.pieces[i])
            while node > 1:
                node //= 2
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def _near(self, i: int, towards: list[int]) -> int | None:
        """The next leaf on one side that holds text. Emptied leaves are stepped over and then pointed past, so many of
        them in a row are walked over once."""
        j, passed = towards[i], [i]
        while 0 <= j < len(self.pieces) and not self.pieces[j]:
            passed.append(j)
            j = towards[j]
        for k in passed:
            towards[k] = j
        return j if 0 <= j < len(self.pieces) else None

    def _join(self, i: int, dirty: set[int]) -> None:
        """Join leaf i with its neighbours until both its borders are safe cuts; the left leaf takes the text."""
        while self.pieces[i]:
            left, right = self._near(i, self._before), self._near(i, self._after)
            if left is not None and not is_cut(self.pieces[left], self.pieces[i]):
                pair = (left, i)
            elif right is not None and not is_cut(self.pieces[i], self.pieces[right]):
                pair = (i, right)
            else:
                return
            self.pieces[pair[0]] += self.pieces[pair[1]]
            self.pieces[pair[1]] = ""
            dirty.update(pair)
            i = pair[0]
        # An emptied leaf brings its neighbours together.
        left, right = self._near(i, self._before), self._near(i, self._after)
        if left is not None and right is not None and not is_cut(self.pieces[left], self.pieces[right]):
            self.pieces[left] += self.pieces[right]
            self.pieces[right] = ""
            dirty.update((left, right))

    def text(self) -> str:
        return "".join(self.pieces)


def _count(batches, propose, vocabulary: str, leaf: int):
    count = encoder(vocabulary)
    for batch in batches:
        out = []
        given = batch.column("edits").to_pylist() if "edits" in batch.schema.names else None
        for i, text in enumerate(batch.column("text")):
            text = text.as_py() or ""
            edits = propose(text) if given is None else [Edit(e["start"], e["end"], e["text"]) for e in given[i] or ()]
            tree = SegmentTree(text, count, leaf)
            before, edits = tree.total, orderly(edits, len(text))
            tree.apply(edits)
            out.append((before, tree.total, len(edits), sum(map(bool, tree.pieces)), tree.encoded, tree.encoded_chars))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array([o[j] for o in out], pa.int64()) for j in range(6))],
            ["id", "n_tokens", "n_tokens_edited", "n_edits", "n_leaves", "leaves_encoded", "chars_encoded"],
        )


def count_edited(
    docs: DataFrame, id_col="doc_id", text_col="text", edits_col=None, propose=redactions, vocabulary=VOCABULARY, leaf=LEAF
) -> DataFrame:
    """id, n_tokens, n_tokens_edited, n_edits, n_leaves, leaves_encoded and chars_encoded of every whole text.

    Each text's tree is built once, edits are applied, and only the touched leaves are encoded again; both counts
    equal those of encoding the whole text. Edits come from column `edits_col`, an array of (start, end, text), or
    from `propose`. One pass, no shuffle; the vocabulary's file must be readable where tasks run.

    A null or empty text has no tokens before edits, and may get some by an insertion. Edits beyond the text are cut
    to it; of two that overlap the first by place stays. Null edits are none, an edit's null text is empty. Repeated
    rows and null ids are rows like others; extra columns are ignored.
    """
    columns = [F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")]
    columns += [F.col(edits_col).alias("edits")] if edits_col else []
    count = functools.partial(_count, propose=propose, vocabulary=vocabulary, leaf=leaf)
    return docs.select(*columns).mapInArrow(count, COUNTED).withColumnRenamed("id", id_col)


def _build(batches, vocabulary: str, leaf: int):
    count = encoder(vocabulary)
    for batch in batches:
        yield _tree_rows(batch.column("id"), [SegmentTree(t.as_py() or "", count, leaf) for t in batch.column("text")])


def _apply(batches, vocabulary: str):
    count = encoder(vocabulary)
    for batch in batches:
        trees, figures = [], []
        for pieces, sums, edits in zip(*(batch.column(c).to_pylist() for c in ("pieces", "sums", "edits"))):
            tree = SegmentTree("", count, kept=(pieces, sums))
            before = tree.total
            own = orderly([Edit(e["start"], e["end"], e["text"]) for e in edits], sum(map(len, pieces)))
            tree.apply(own)
            trees.append(tree)
            figures.append((before, tree.total, len(own), tree.encoded, tree.encoded_chars))
        names = [f.split()[0] for f in EDITED.split(", ")]
        yield _tree_rows(batch.column("id"), trees, [(n, [f[i] for f in figures]) for i, n in enumerate(names)])


def build_trees(docs: DataFrame, id_col="doc_id", text_col="text", vocabulary=VOCABULARY, leaf=LEAF) -> DataFrame:
    """The trees of whole texts as a table to keep: id, pieces (its leaves, which join to the text), sums (of each node;
    the first is unused, the second the text's count). Each text is encoded once, here."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return own.mapInArrow(functools.partial(_build, vocabulary=vocabulary, leaf=leaf), TREES)


def edit_trees(trees: DataFrame, edits: DataFrame, vocabulary=VOCABULARY) -> DataFrame:
    """Kept trees after a batch of edits: the columns of a tree, and n_tokens, n_tokens_edited, n_edits, leaves_encoded and
    chars_encoded; write it and give it to the next batch.

    `edits` has rows of id, start, end, text, with places in the text as the trees have it. Only leaves that edits
    touch are encoded; trees without edits are neither sent to Python nor changed. Edits bear the rules of
    `count_edited`; those of an unknown or null id are ignored, those of a repeated id go to each of its rows.
    """
    given = edits.filter("id is not null").groupBy(F.col("id").cast("long").alias("id"))
    given = given.agg(F.collect_list(F.struct("start", "end", "text")).alias("edits"))
    joined = trees.select("id", "pieces", "sums").join(given, "id", "left")
    touched = joined.filter("edits is not null").mapInArrow(functools.partial(_apply, vocabulary=vocabulary), f"{TREES}, {EDITED}")
    zero, total = F.lit(0).cast("long"), F.get("sums", F.lit(1))
    rest = joined.filter("edits is null").select("id", "pieces", "sums", total.alias("n_tokens"), total.alias("n_tokens_edited"),
        zero.alias("n_edits"), zero.alias("leaves_encoded"), zero.alias("chars_encoded"))
    return touched.unionByName(rest)
