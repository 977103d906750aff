"""Secrets in whole texts, and who owns them across the corpus."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tripspot.session import Scratch

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "example", "live")
# What a text must hold to be looked at more closely; a superset, told by one pass of a finite automaton.
HINT = r"(?i)passw(or)?d|secret|token|api_?key|AKIA|[0-9a-f]{24}"
PLACEHOLDER = re.compile(r"example|changeme|placeholder|your|dummy|x{4}|12345678", re.IGNORECASE | re.ASCII)

SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
CANDIDATE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("hash", pa.string()), ("strong", pa.bool_())])
SCANNED = (
    "at long, id long, repo string, owner string, n_assign long, n_access long, n_hex long,"
    " base array<struct<start:int,rank:int,end:int>>,"
    " candidates array<struct<start:int,end:int,hash:string,strong:boolean>>"
)


def find(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, rank of kind, end, start and end of the value) of each base span, leftmost and non-overlapping per kind."""
    found = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            found.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 20:
            found.append((m.start(), 1, m.end(), m.start(), m.end()))
    # Runs are maximal, so asking for 24 digits at once finds the same spans as dropping shorter runs.
    found += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def looks_live(value: str) -> bool:
    """Long and irregular enough for a generated credential, and no wording of a placeholder."""
    if len(value) < 12 or PLACEHOLDER.search(value):
        return False
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values()) >= 3.0


def _scan(batches):
    for batch in batches:
        texts = batch.column("text")
        hinted = pc.fill_null(pc.match_substring_regex(texts, HINT), False).to_pylist()
        counts, base, candidates = [[], [], []], [], []
        for i, hint in enumerate(hinted):
            text = texts[i].as_py() if hint else ""
            found = find(text) if hint else []
            for rank in range(3):
                counts[rank].append(sum(f[1] == rank for f in found))
            base.append([{"start": f[0], "rank": f[1], "end": f[2]} for f in found])
            values = {(f[3], f[4]): text[f[3] : f[4]] for f in found}
            candidates.append(
                [{"start": s, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest(), "strong": looks_live(v)}
                 for (s, e), v in sorted(values.items())]
            )
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("at", "id", "repo", "owner")), *(pa.array(c, pa.int64()) for c in counts),
             pa.array(base, pa.list_(SPAN)), pa.array(candidates, pa.list_(CANDIDATE))],
            ["at", "id", "repo", "owner", "n_assign", "n_access", "n_hex", "base", "candidates"],
        )


def ownership(scanned: DataFrame) -> DataFrame:
    """hash, strong, repos, owners: in how many repositories, and of how many owners, each candidate value occurs.

    Counted over the whole corpus in steps that combine before each shuffle, so a value copied everywhere is one row
    per task. A null repository or owner counts as one of its own.
    """
    seen = scanned.select("repo", "owner", F.explode("candidates").alias("c")).groupBy(
        F.col("c.hash").alias("hash"), F.col("c.strong").alias("strong"), "owner", "repo"
    ).agg(F.lit(1).alias("one"))
    by_owner = seen.groupBy("hash", "strong", "owner").agg(F.sum("one").alias("repos"))
    return by_owner.groupBy("hash", "strong").agg(F.sum("repos").alias("repos"), F.count("*").alias("owners"))


def verdicts(owned: DataFrame, copied_owners=3, copied_repos=10) -> DataFrame:
    """hash and the rank of its verdict: a value that `copied_owners` or more owners, or `copied_repos` or more
    repositories, share is an example that people copy; one of a single owner and of fewer repositories that looks
    generated is live. Others get none."""
    copied = (F.col("owners") >= copied_owners) | (F.col("repos") >= copied_repos)
    rank = F.when(copied, F.lit(KINDS.index("example"))).when(
        (F.col("owners") == 1) & F.col("strong"), F.lit(KINDS.index("live"))
    )
    return owned.select("hash", rank.cast("int").alias("verdict")).filter("verdict is not null")


def joined(spans, between=",") -> F.Column:
    """kind:start:end of each span."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(
        spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(text, between)


def scan_secrets(
    docs: DataFrame, scratch: Scratch, id_col="doc_id", text_col="text", repo_col="doc_id", owner_col="source", copied_owners=3,
    copied_repos=10,
) -> DataFrame:
    """One row per row of `docs`: id, n_assign, n_access, n_hex, base_spans, spans, n_example, n_live.

    Base spans are found by pattern; the value in each is hashed, and hashes are counted over repositories and owners
    of the whole corpus. To the base spans the method adds, over the value, `example` for values that many owners or
    many repositories have and `live` for generated-looking values of one owner and few repositories. Exact copies of
    a text in several repositories count once for each. Spans are (start, rank of kind, end) in code points, in order.

    Texts are read once and stay where they are: only hashes, and rows that hold a candidate, are shuffled, and a
    value in a third of all rows is split. A null or empty text has no spans. Repeated rows are rows of their own (of
    one repository). Null repositories or owners count as one each.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("at"),
        F.col(id_col).cast("long").alias("id"),
        F.col(repo_col).cast("string").alias("repo"),
        F.col(owner_col).cast("string").alias("owner"),
        F.col(text_col).alias("text"),
    )
    scanned = scratch.store(rows.mapInArrow(_scan, SCANNED), "scanned")
    counts = ["at", "id", "n_assign", "n_access", "n_hex", "base"]
    found = scanned.filter(F.size("candidates") > 0).select(*counts, F.explode("candidates").alias("c"))
    judged = found.join(verdicts(ownership(scanned), copied_owners, copied_repos).withColumnRenamed("hash", "_hash"), F.col("c.hash") == F.col("_hash"), "left")
    added = F.when(
        F.col("verdict").isNotNull(),
        F.struct(F.col("c.start").alias("start"), F.col("verdict").alias("rank"), F.col("c.end").alias("end")),
    )
    with_any = judged.groupBy("at").agg(
        *[F.first(c).alias(c) for c in counts[1:]],
        F.collect_set(added).alias("added"),
    )
    none = scanned.filter(F.size("candidates") == 0).select(
        *counts, F.expr("cast(array() as array<struct<start:int,rank:int,end:int>>)").alias("added")
    )
    both = with_any.unionByName(none)
    how_many = lambda kind: F.size(F.filter("added", lambda s: s["rank"] == KINDS.index(kind))).cast("long")
    return both.select(
        F.col("id").alias(id_col),
        "n_assign",
        "n_access",
        "n_hex",
        F.col("base").alias("base_spans"),
        F.array_sort(F.concat("base", "added")).alias("spans"),
        how_many("example").alias("n_example"),
        how_many("live").alias("n_live"),
    )
