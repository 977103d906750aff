"""Repair of conversations against a search of all edits, whole and in parts."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from tripspot.llm import repair
from tripspot.llm.repair import COUNTS, damage, ranked_paths, repair_conversations

NEXT = {"": "user", "s": "user", "u": "assistant", "a": "user"}
FITS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def brute(rows):
    """Figures, audit and lines of one conversation: the cheapest edits by search, of these the least audit."""
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], md5(r[2])))
    faults, seen = [], set()
    for _, role, text in rows:
        seen_text = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not seen_text else "duplicate" if (role, text) in seen else "truncated" if seen_text[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    out = {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
    }
    heap, done = [(0, "", 0, "", ())], set()
    while heap:  # in the order of cost and audit; a node is left first with its least pair of both among equal costs
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return out | {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
        if (cost, audit) in done:
            continue
        done.add((cost, audit))
        role = NEXT[state]
        if audit.count("I") <= 2 * len(rows) + 2:
            heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], (*lines, f"{role}:")))
        if i < len(rows):
            _, own, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = int(faults[i] == "truncated")
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, role[0], (*lines, f"{role}:{text}")))
                if (state, own[:1]) in FITS:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, own[0], (*lines, f"{own}:{text}")))
    raise AssertionError


def random_rows(seed, convs, most=7):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for _ in range(rng.randrange(1, most)):
            text = rng.choice(["Yes.", "No!", "cut", "", " \n", None, "Why? ", "a.b", "é…", "z" * rng.randrange(1, 4) + "."])
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(["user", "assistant", "system", "bot", "", None, "u"]), text))
    return rows


def check(result, rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(tuple(row))
    got = [r for r in result.collect()]
    last = {r.conv_id: r for r in got if r.audit is not None}
    assert set(last) == set(groups) and sum(r.audit is not None for r in got) == len(groups)
    for conv, own in groups.items():
        want = brute(own)
        assert {c: last[conv][c] for c in want} == want, (conv, own)
        parts = sorted((r for r in got if r.conv_id == conv), key=lambda r: r.part)
        lines = [f"{t.role}:{t.text}" for r in parts for t in r.turns]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == want["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_against_search(spark, scratch, conversations, seed):
    rows = random_rows(seed, 120)
    check(repair_conversations(conversations(rows), scratch), rows)


def test_in_parts(spark, scratch, conversations, small_batches):
    # A long conversation holds most rows; parts of four rows cut it, and task borders fall inside others.
    rows = random_rows(3, 12, 5) + [(50, i // 2, random.Random(i).choice(["user", "assistant"]), f"t{i % 17}" + "." * (i % 3 > 0)) for i in range(60)]
    rows += [(51, None, "user", "same.")] * 25
    got = [r for r in repair_conversations(conversations(rows), scratch, part_rows=4).collect()]
    assert sum(r.conv_id == 50 for r in got) > 3 and sum(r.conv_id == 51 for r in got) > 1
    small = [r for r in rows if r[0] not in (50, 51)]
    mine = {r.conv_id: r for r in got if r.audit is not None}
    for conv in {r[0] for r in small}:
        want = brute([r[1:] for r in small if r[0] == conv])
        assert {c: mine[conv][c] for c in want} == want
    whole = repair_conversations(conversations(rows, 1).coalesce(1), scratch).filter("audit is not null").collect()
    same = {r.conv_id: r for r in whole}
    for conv in (50, 51):
        assert all(mine[conv][c] == same[conv][c] for c in [*COUNTS, "audit", "repaired_sha256"])
    assert (mine[51].duplicate, mine[51].gaps, mine[51].cost, mine[51].audit) == (24, 0, 74, "K" + "D" * 24 + "I")


def test_ranks_order_all_nodes_by_their_audit():
    rng = np.random.default_rng(5)
    able, goal = rng.random((60, 4)) < 0.5, np.zeros((60, 4), int)
    for v in range(60):
        goal[v] = rng.integers(v + 1, 61, 4).clip(max=59)
        able[v] &= goal[v] > v
    pointers, letter, length = ranked_paths(able, goal)

    def audit(v):
        return "" if not able[v].any() else "DIKR"[able[v].argmax()] + audit(goal[v, able[v].argmax()])

    for v in range(60):
        assert length[v] == len(audit(v)) and (length[v] == 0 or "DIKR"[letter[v]] == audit(v)[0])
        node = v
        for _ in range(min(8, length[v])):
            node = pointers[0][node]
        assert len(pointers) < 4 or length[v] < 8 or node == pointers[3][v]


def test_damage(spark, conversations):
    rows = [(c, t, "assistant", "Yes. No? a") for c in range(20) for t in [*range(9), None]] + [(None, 3, None, None)]
    got = sorted(map(str, ((r.conv_id, r.turn, r.role, r.text) for r in damage(conversations(rows)).collect())))
    want = []
    for conv, turn, role, text in rows:
        part = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{part(conv)}:{part(turn)}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", part(text))}.get(fault, part(text))
        want += [(conv, turn, "user" if fault == 4 else part(role), text)] * {0: 0, 3: 2}.get(fault, 1)
    assert got == sorted(map(str, want))


def test_empty_and_long(spark, scratch, conversations):
    assert repair_conversations(conversations([]), scratch).collect() == []
    long = "word " * 200_000 + "."
    row = repair_conversations(conversations([(1, 0, "user", long)]), scratch).first()
    assert (row.audit, row.cost, row.turns[0].text == long) == ("KI", 2, True)


def test_roles_are_listed_by_state():
    assert repair.ROLES.to_pylist() == ["", "system", "user", "assistant"]
