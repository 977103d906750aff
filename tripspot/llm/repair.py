"""Repair of conversations whose turns are damaged: cheapest edits by dynamic programming, least audit by prefix doubling."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tripspot.llm.turns import ROWS, flat_index, in_order, lists, runs
from tripspot.operators.rows import checked_broadcast
from tripspot.session import Scratch

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
# States of a repaired beginning: nothing yet, or the initial of its last role. Wanted are s?(ua)+ or nothing.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = pa.array(["", "system", "user", "assistant"])
NEXT = np.array([USER, USER, ASSISTANT, USER])  # the role that an inserted or reroled turn gets in each state
FITS = np.zeros((4, 4), bool)  # whether a turn with an initial can be kept in a state
FITS[[NOTHING, NOTHING, SYSTEM, USER, ASSISTANT], [SYSTEM, USER, USER, ASSISTANT, USER]] = True
LEGAL = FITS & (np.arange(4) > NOTHING)[:, None]  # neighbours in a conversation, where 0 is any other initial
FINAL = np.array([0, 4, 2, 0])  # cost of the insertions that end a repaired conversation
BLANK, CUT, REPEATED = 1, 2, 3  # a row's first fault
DELETE, INSERT, KEEP, REROLE = range(4)  # in the order of their letters
LETTERS = np.frombuffer(b"DIKR", np.uint8)
NEVER = 1 << 40

ROW = "struct<turn: long, role: string, text: string, digest: string, initial: int, fault: int>"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of conversations (conv_id, turn, role, text), damaged by the checksum of `conv_id:turn` modulo 20: 0 drops a
    row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user. Nulls are one space in
    the checksum, the role and the text; a null turn stays null."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(part("text"), ENDS, "")).otherwise(part("text"))
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(fault == 4, "user").otherwise(part("role")).alias("role"),
        text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy"),
    )
    return rows.drop("_copy")


def least_costs(initial, fault, start, count, end) -> np.ndarray:
    """Least cost from each node to the end of its run; `end` has the cost of each state behind a run.

    A run of n rows has n + 1 nodes of four states: before each row, and behind the last. All runs go back one row
    at a time together.
    """
    first = start + np.arange(len(start))
    cost = np.empty((len(initial) + len(start), 4), np.int64)
    cost[first + count] = end
    longest = np.argsort(-count, kind="stable")
    falling = -count[longest]
    for j in range(int(count.max(initial=0)) - 1, -1, -1):
        live = longest[: int(np.searchsorted(falling, -j, "left"))]
        at = first[live] + j
        options = _edits(initial[start[live] + j], fault[start[live] + j], cost[at + 1])
        best = options.min(axis=0)
        cost[at] = np.minimum(best, np.minimum(2 + best[:, NEXT], 4 + best[:, NEXT[NEXT]]))
    return cost


def _edits(initial, fault, after) -> np.ndarray:
    """Cost of deleting, keeping and reroling rows in each state, with what follows."""
    stays = np.where((fault == BLANK) | (fault == REPEATED), NEVER, np.where(fault == CUT, 1, 0))[:, None]
    kept = np.take_along_axis(after, initial[:, None], 1) + stays
    return np.stack([3 + after, np.where(FITS[:, initial].T, kept, NEVER), 2 + stays + after[:, NEXT]])


def ranked_paths(able: np.ndarray, goal: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Pointers of 1, 2, 4, ... arcs along each node's least path, the letter of its first arc, and its length.

    `able` and `goal` have a column for each letter: whether an optimal arc of that letter leaves a node, and where it
    leads. Nodes without one are ends. Nodes are ranked by the first letter of their audit, then by its first two,
    four, ... letters: the rank for twice a length is that of the pair (own rank, rank of the node that the pointer
    reaches). A node's arc is the one with the least (letter, rank of its goal). A letter leaves a node by one arc at
    most, so longer ranks refine the choice and never overturn it: a pointer once made stays.
    """
    nodes, letters = np.arange(len(able)), np.arange(able.shape[1])
    ends = ~able.any(axis=1)

    def select(rank):
        order = np.where(able, letters * (rank.max(initial=0) + 1) + rank[goal], np.iinfo(np.int64).max)
        return order.argmin(axis=1)

    rank = np.where(ends, 0, able.argmax(axis=1) + 1)
    letter = select(rank)
    pointers, length = [np.where(ends, nodes, goal[nodes, letter])], (~ends).astype(np.int64)
    while not ends[pointers[-1]].all():
        jump = pointers[-1]
        rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1].ravel()
        letter, length = select(rank), length + length[jump]
        pointers.append(jump[jump])
    return pointers, letter, length


def solve(initial, fault, start, end, entry, closed):
    """The least audit among the cheapest edits of each run: (letter, node, row or -1, state after it) of every edit in
    order, edits of each run, cost and last state of each run.

    `end` is the cost of each state behind a run, `entry` the state before it, `closed` whether nothing follows.
    """
    count = np.diff(np.append(start, len(initial)))
    cost = least_costs(initial, fault, start, count, end)
    first = start + np.arange(len(start))
    last = first + count
    behind = np.zeros(len(cost), bool)
    behind[last] = True
    at = np.flatnonzero(~behind)  # the node before each row
    able = np.zeros((len(cost), 4, 4), bool)  # node, state, letter
    options = _edits(initial, fault, cost[at + 1])
    able[at[:, None], np.arange(4), [[DELETE]]] = options[0] == cost[at]
    able[at[:, None], np.arange(4), [[KEEP]]] = options[1] == cost[at]
    able[at[:, None], np.arange(4), [[REROLE]]] = options[2] == cost[at]
    inserts = 2 + cost[:, NEXT] == cost
    inserts[last[~closed]] = False  # the next part does it
    able[:, :, INSERT] = inserts
    here = np.arange(len(cost))[:, None] * 4
    after = np.minimum(here + 4, 4 * len(cost) - 4)
    goal = np.empty(able.shape, np.int64)
    goal[:, :, DELETE] = after + np.arange(4)
    goal[:, :, INSERT] = here + NEXT
    goal[:, :, REROLE] = after + NEXT
    kept = np.zeros(len(cost), np.int64)
    kept[at] = initial
    goal[:, :, KEEP] = after + kept[:, None]
    pointers, letter, length = ranked_paths(able.reshape(-1, 4), goal.reshape(-1, 4))

    begin = first * 4 + entry
    run, place = flat_index(length[begin])
    node = begin[run]
    for k, pointer in enumerate(pointers):  # the node after `place` arcs, by the bits of `place`
        node = np.where(place >> k & 1, pointer[node], node)
    letters = letter[node]
    out = pointers[0][node]
    row = np.where(letters == INSERT, -1, node // 4 - run)
    exit_ = begin.copy()
    for k, pointer in enumerate(pointers):
        exit_ = np.where(length[begin] >> k & 1, pointer[exit_], exit_)
    return letters, row, out % 4, length[begin], cost[first, entry], exit_ % 4


def repeated(table: pa.Table, run: np.ndarray) -> np.ndarray:
    """Whether a row's role and text came before in its run."""
    both = pc.dictionary_encode(pc.binary_join_element_wise(table.column("role"), table.column("digest"), "").combine_chunks())
    key = run * (len(both.dictionary) + 1) + both.indices.to_numpy(zero_copy_only=False)
    out = np.ones(len(key), bool)
    out[np.unique(key, return_index=True)[1]] = False
    return out


def _numbers(table, name, missing=0):
    return pc.fill_null(table.column(name), missing).to_numpy().astype(np.int64)


def measures(table: pa.Table, start: np.ndarray, fault: np.ndarray) -> dict:
    """Of each run: least and greatest turn, number of turns, faults, and neighbours whose initials do not fit."""
    run_start = np.zeros(len(fault), bool)
    run_start[start] = True
    turn, known = _numbers(table, "turn"), table.column("turn").is_valid().to_numpy()
    new = known & (run_start | ~np.roll(known, 1) | (turn != np.roll(turn, 1)))
    initial = _numbers(table, "initial")
    wrong = ~run_start & ~LEGAL[np.roll(initial, 1), initial]
    add = lambda x: np.add.reduceat(x.astype(np.int64), start)
    return {
        "low": np.minimum.reduceat(np.where(known, turn, np.iinfo(np.int64).max), start),
        "high": np.maximum.reduceat(np.where(known, turn, np.iinfo(np.int64).min), start),
        "turns": add(new), "blank": add(fault == BLANK), "duplicate": add(fault == REPEATED), "truncated": add(fault == CUT),
        "illegal": add(wrong),
    }


def gaps(low, high, turns):
    return np.where(turns > 0, high - low + 1 - turns, 0)


def repaired(table, letters, row, state, edits):
    """The turns of each run after its edits, and its audit."""
    stays = letters != DELETE
    row, state, kept = row[stays], state[stays], pa.array(letters[stays] == KEEP)
    source = pa.array(row, mask=row < 0)
    taken = table.select(["role", "text"]).combine_chunks()
    text = pc.fill_null(taken.column("text").combine_chunks().take(source), "")
    role = pc.if_else(kept, taken.column("role").combine_chunks().take(source), ROLES.take(pa.array(state)))
    run = np.repeat(np.arange(len(edits)), edits)
    size = np.bincount(run[stays], minlength=len(edits))
    offsets = np.concatenate([[0], np.cumsum(edits)]).astype(np.int32)
    audit = pa.StringArray.from_buffers(len(edits), pa.py_buffer(offsets), pa.py_buffer(LETTERS[letters].tobytes()))
    turns = lists(pa.StructArray.from_arrays([role, text], fields=list(TURNS.value_type)), size)
    lines = lists(pc.binary_join_element_wise(role, text, ":"), size)
    return turns, audit, pc.binary_join(lines, "\n").to_pylist()


def _schema(conv: str) -> str:
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return f"conv {conv}, part long, turns array<struct<role: string, text: string>>, {counts}, audit string, repaired_sha256 string, open boolean, rows array<{ROW}>"


def _first_pass(batches, types, part_rows):
    """Whole conversations repaired, and the rows of open ones as they are."""
    for table, start, open_, number in runs(batches, rows=part_rows):
        count = np.diff(np.append(start, table.num_rows))
        which = np.repeat(open_, count)
        if open_.any():
            rows = table.filter(pa.array(which)).select(["turn", "role", "text", "digest", "initial", "fault"]).combine_chunks()
            structs = pa.StructArray.from_arrays([c.combine_chunks() for c in rows.columns], names=rows.column_names)
            n = int(open_.sum())
            some = {
                "conv": table.column("conv").take(pa.array(start[open_])), "part": number + np.flatnonzero(open_),
                "open": np.ones(n, bool), "rows": lists(structs, count[open_]),
            }
            yield _batch(some, n, types)
        if not open_.all():
            table, count, number = table.filter(pa.array(~which)), count[~open_], number + np.flatnonzero(~open_)
            start = np.cumsum(count) - count
            run = np.repeat(np.arange(len(start)), count)
            fault = _numbers(table, "fault")
            fault[(fault != BLANK) & repeated(table, run)] = REPEATED
            n, closed = len(start), np.ones(len(start), bool)
            end, entry = np.tile(FINAL, (n, 1)), np.zeros(n, np.int64)
            letters, row, state, edits, cost, _ = solve(_numbers(table, "initial"), fault, start, end, entry, closed)
            turns, audit, lines = repaired(table, letters, row, state, edits)
            found = measures(table, start, fault)
            some = {
                "conv": table.column("conv").take(pa.array(start)), "part": number, "turns": turns, "cost": cost, "audit": audit,
                "gaps": gaps(found["low"], found["high"], found["turns"]), "open": ~closed,
                "repaired_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in lines],
            }
            yield _batch(some | {c: found[c] for c in COUNTS if c in found}, n, types)


def _batch(columns: dict, rows: int, types: pa.Schema) -> pa.RecordBatch:
    """A batch of the given types; columns that are not given are null."""
    out = []
    for field in types:
        value = columns.get(field.name)
        value = pa.nulls(rows, field.type) if value is None else value
        value = value.combine_chunks() if isinstance(value, pa.ChunkedArray) else value
        out.append(value.cast(field.type) if isinstance(value, pa.Array) else pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(out, schema=types)


def _part_rows(batch, i):
    """The rows of one open part as a table, with their faults."""
    rows = batch.column("rows")[i].values
    table = pa.table({f.name: rows.field(f.name) for f in rows.type})
    fault = _numbers(table, "fault")
    again = np.ones(len(fault), bool)
    again[batch.column("firsts")[i].as_py() or []] = False
    fault[(fault != BLANK) & again] = REPEATED
    return table, fault


def _backward(batches):
    """For the parts of a conversation from the last to the first: the cost of each state behind the part."""
    held, end = None, FINAL
    for batch in batches:
        convs, out, closed = batch.column("conv").to_pylist(), [], []
        for i, conv in enumerate(convs):
            closed.append(held is None or held[0] != conv)
            if closed[-1]:
                end = FINAL
            held = (conv,)
            table, fault = _part_rows(batch, i)
            out.append(end)
            n = table.num_rows
            end = least_costs(_numbers(table, "initial"), fault, np.zeros(1, np.int64), np.array([n]), end[None])[0]
        yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array([e.tolist() for e in out]), pa.array(closed)], ["part", "ends", "closed"])


def _forward(batches, types):
    """The parts of a conversation from the first to the last, repaired; the last bears the conversation's figures."""
    fresh = lambda: {"state": NOTHING, "sha": hashlib.sha256(), "lines": 0, "audit": [], "cost": None, "sum": {}, "last": None}
    now = fresh()
    for batch in batches:
        for i in range(batch.num_rows):
            table, fault = _part_rows(batch, i)
            closed = batch.column("closed")[i].as_py()
            end = np.array([batch.column("ends")[i].as_py()])
            start, initial = np.zeros(1, np.int64), _numbers(table, "initial")
            letters, row, state, edits, cost, exit_ = solve(initial, fault, start, end, np.array([now["state"]]), np.array([closed]))
            turns, audit, lines = repaired(table, letters, row, state, edits)
            found, total = {k: int(v[0]) for k, v in measures(table, start, fault).items()}, now["sum"]
            for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
                total[name] = total.get(name, 0) + found[name]
            if now["last"]:
                before, turn = now["last"]
                total["illegal"] += int(not LEGAL[before, initial[0]])
                total["turns"] -= int(turn is not None and turn == table.column("turn")[0].as_py())
            now["last"] = int(initial[-1]), table.column("turn")[-1].as_py()
            total["low"] = min(total.get("low", found["low"]), found["low"])
            total["high"] = max(total.get("high", found["high"]), found["high"])
            now["cost"] = int(cost[0]) if now["cost"] is None else now["cost"]
            now["state"] = int(exit_[0])
            now["audit"].append(audit[0].as_py())
            if len(turns[0]):
                now["sha"].update(("\n" if now["lines"] else "").encode() + lines[0].encode())
                now["lines"] += len(turns[0])
            some = {"conv": batch.column("conv").slice(i, 1), "part": batch.column("part").slice(i, 1), "turns": turns, "open": [True]}
            if closed:
                some |= {c: [total[c]] for c in COUNTS if c in total}
                some |= {"gaps": gaps(np.array([total["low"]]), total["high"], np.array([total["turns"]])), "cost": [now["cost"]]}
                some |= {"audit": ["".join(now["audit"])], "repaired_sha256": [now["sha"].hexdigest()]}
                now = fresh()
            yield _batch(some, 1, types)


def repair_conversations(rows: DataFrame, scratch: Scratch, conv_col="conv_id", part_rows=ROWS) -> DataFrame:
    """Repaired conversations: conv_id, part, turns (role, text), and, on a conversation's last part, gaps, blank,
    duplicate, truncated, illegal, cost, audit and repaired_sha256 (of the lines `role:text`); null on its other parts.

    Rows are taken by turn (null first), then role and the MD5 of the text; rows equal in all of them are repeats. A
    row's first fault counts: blank, duplicate (role and text came before), truncated (its last character that is no
    space is none of `.!?`). Keep costs 0, Rerole to user or assistant 2, Delete 3 (a blank or duplicate row must go),
    Insert of an empty turn of user or assistant 2; a truncated row that stays costs 1 more. The cheapest edits that
    leave the initials `s?(ua)+` or nothing are taken, and of these the audit (initials of the edits) that is least.

    1. A range sort brings rows into order; a task repairs the conversations that lie in it whole, thousands at a time:
       the cost of each node (row, state) goes backward, then optimal arcs are ranked by prefix doubling
       (`ranked_paths`) and the path is read off the doubled pointers.
    2. Conversations at a task's border, and parts of very long ones, are stored as parts. Their repeats are found by
       one aggregate; costs go backward and states forward over the parts in order, a part at a time. Beyond parts, a
       task holds only the audit, which is one cell of the result. The digest has no parallel form: the parts of one
       conversation pass one task in order.

    A null role or text counts as one space: such a text is blank, such a role fits nowhere, as an empty role does.
    `gaps` ignores null turns and is 0 if all are null. A null id is a conversation of its own. Extra columns are
    ignored; an empty table gives no rows.
    """
    trimmed = F.rtrim("text", F.lit(SPACES))
    fault = F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(*ENDS), CUT).otherwise(0)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(NOTHING)
    own = rows.select(
        F.col(conv_col).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    own = in_order(own.withColumns({"initial": initial, "fault": fault}))
    schema = _schema(own.schema["conv"].dataType.simpleString())
    types = _arrow(rows.sparkSession, schema)
    done = scratch.store(own.mapInArrow(functools.partial(_first_pass, types=types, part_rows=part_rows), schema), "repaired")

    parts = done.filter("open").select("conv", "part", "rows")
    entries = parts.select("conv", "part", F.posexplode("rows").alias("place", "row"))
    seen = entries.groupBy("conv", "row.role", "row.digest").agg(F.min(F.struct("part", "place")).alias("first"))
    firsts = seen.groupBy(F.col("first.part").alias("part")).agg(F.collect_list("first.place").alias("firsts"))
    parts = scratch.store(parts.join(firsts, "part", "left"), "parts")
    thin = parts.select("conv", "part", F.transform("rows", lambda r: F.struct(r["initial"], r["fault"])).alias("rows"), "firsts")
    back = thin.repartition("conv").sortWithinPartitions("conv", F.desc("part"))
    ends = scratch.store(back.mapInArrow(_backward, "part long, ends array<long>, closed boolean"), "ends")
    ordered = parts.join(checked_broadcast(ends), "part").repartition("conv").sortWithinPartitions("conv", "part")
    joined = ordered.mapInArrow(functools.partial(_forward, types=types), schema)
    both = done.filter("not open").unionByName(joined)
    return both.withColumnRenamed("conv", conv_col).drop("open", "rows")


def _arrow(spark, schema: str) -> pa.Schema:
    """The Arrow types of a schema string."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)
