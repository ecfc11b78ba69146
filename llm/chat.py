"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn, ending with the assistant. A dynamic
program over this automaton chooses for every row whether it keeps its role, takes another, or is merged into the turn
before, and where empty turns are put in, at the least total cost. The repaired rows are rendered as fragments whose
concatenation, in order, is the conversation's training text.

Rows are range-partitioned by conversation and turn, so a very long conversation lies in several pieces. A piece's costs
form a min-plus matrix over the automaton's four states; the few matrices and back pointers of conversations that
cross a boundary are chained on the driver, at most two pieces for each partition, and each piece is then solved alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.base import ship, shuffle_partitions, written

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = (None, "system", "user", "assistant")
# Names that data sets use for the three roles.
NAMES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER, "question": USER, "customer": USER,
         "assistant": ASSISTANT, "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT, "answer": ASSISTANT, "chatgpt": ASSISTANT}
MERGE, RELABEL, NAME_UNKNOWN, INSERT = 2, 3, 1, 5
FAR = 10**12
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
MARK = re.compile(r"<(\\*)\|(?=im_(?:start|end)\|>)")


def _follow() -> dict[tuple[int, int], list[tuple[int, str, tuple[int, ...]]]]:
    """(state, next role): the ways to go on, as (cost, action, empty turns put in)."""
    ways = {(s, q): [] for s in range(4) for q in (SYSTEM, USER, ASSISTANT)}
    legal = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
    for s, q in ways:
        if (s, q) in legal:
            ways[s, q].append((0, "keep", ()))
        if s == q:
            ways[s, q].append((MERGE, "merge", ()))
        ways[s, q] += [(INSERT, "keep", (x,)) for x in (USER, ASSISTANT) if (s, x) in legal and (x, q) in legal and (s, q) not in legal]
    return ways


# The cheapest way between two states; merging wins over inserting.
WAYS = {k: min(v, key=lambda w: w[0]) for k, v in _follow().items() if v}
ENDING = {START: (0, ()), SYSTEM: (2 * INSERT, (USER, ASSISTANT)), USER: (INSERT, (ASSISTANT,)), ASSISTANT: (0, ())}


def role_of(name: str | None) -> int:
    return NAMES.get((name or "").strip().lower(), START)


def _label(role: int, q: int) -> int:
    return 0 if role == q else NAME_UNKNOWN if role == START else RELABEL


def forward(costs: list[int], roles: list[int]) -> tuple[list[int], list[tuple[int, int, int, int]]]:
    """Costs of the four states after the rows, and for each row the best state before each state."""
    back = []
    for role in roles:
        new, came = [FAR] * 4, [0] * 4
        for (s, q), way in WAYS.items():
            cost = costs[s] + way[0] + _label(role, q)
            if cost < new[q] or cost == new[q] and s < came[q]:
                new[q], came[q] = cost, s
        costs = [min(c, FAR) for c in new]
        back.append(tuple(came))
    return costs, back


def backward(back: list, last: int) -> list[int]:
    """The states before the first row and after each row, given the state after the last."""
    states = [last]
    for came in reversed(back):
        states.append(came[states[-1]])
    return states[::-1]


def best_end(costs: list[int]) -> int:
    return min(range(1, 4), key=lambda s: (costs[s] + ENDING[s][0], s))


def repair(roles: list[int]) -> list[int]:
    """States before the first row and after each row of a whole conversation, at least cost; ties go to the state that comes first, from the end on."""
    costs, back = forward([0, FAR, FAR, FAR], roles)
    return backward(back, best_end(costs))


def escaped(text: str) -> str:
    """A text in which no turn begins or ends: a mark gets a backslash after its ``<``, and so does an escaped one."""
    return MARK.sub(r"<\1\\|", text)


def _fragments(states: list[int], roles: list[int], texts: list[str], is_end: bool):
    """(role, action, empty turns put in, fragment) of each row; the end of a conversation closes its last turn."""
    for k, (role, text) in enumerate(zip(roles, texts, strict=True)):
        s, q = states[k], states[k + 1]
        _, action, inserted = WAYS[s, q]
        text = escaped(text)
        if action == "merge":
            fragment = "\n" + text
        else:
            fragment = ("" if s == START else CLOSE) + "".join(f"{OPEN}{ROLES[x]}\n{CLOSE}" for x in inserted) + f"{OPEN}{ROLES[q]}\n{text}"
            action = "relabel" if role != q else action
        count = len(inserted)
        if is_end and k == len(roles) - 1:
            tail = ENDING[q][1]
            fragment += CLOSE + "".join(f"{OPEN}{ROLES[x]}\n{CLOSE}" for x in tail)
            count += len(tail)
        yield ROLES[q], action, role != q, count, fragment


def _pieces(batches) -> Iterator[tuple[int, object, list]]:
    """(partition, conversation, rows) of runs of equal (pid, conv_id) in sorted rows."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("pid", "conv_id", "turn", "role", "text")), strict=True):
            if key is not None and row[:2] != key:
                yield *key, rows
                rows = []
            key = row[:2]
            rows.append(row[2:])
    if key is not None:
        yield *key, rows


def repair_chats(conversations: DataFrame) -> DataFrame:
    """Per row of ``conversations`` (conv_id long, turn long, role, text): conv_id, turn, old_role, role, action, relabelled, n_inserted, fragment.

    action: keep, relabel or merge (into the turn before); relabelled also tells it of merged rows. n_inserted: empty
    turns put in before the row, or after a conversation's last one. Fragments in order of turn make the rendered text.
    Marks of turns inside a text are escaped, so that no text opens or closes a turn.

    Null text counts as empty; a null or unknown role is named at a small cost. Rows of one turn, also repeated ones, are
    taken in order of a hash of role and text; null turns come first; rows with null conv_id are one conversation. An empty
    table gives an empty result; other columns are ignored.
    """
    spark = conversations.sparkSession
    ship(spark)
    n = shuffle_partitions(spark)
    columns = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")]
    dealt = conversations.select(*columns).repartitionByRange(n, F.col("conv_id"), F.col("turn"), F.xxhash64("role", "text"))
    dealt = written(dealt.withColumn("pid", F.spark_partition_id()), "chats")
    sorted_rows = dealt.repartition(n, "pid").sortWithinPartitions("pid", "conv_id", "turn", F.xxhash64("role", "text"), "role", "text")
    ends = dealt.groupBy("pid").agg(F.min(F.struct("conv_id")).alias("low"), F.max(F.struct("conv_id")).alias("high"))
    pieces_of: dict[object, list[int]] = {}
    for row in ends.orderBy("pid").collect():
        for conv in dict.fromkeys((row["low"]["conv_id"], row["high"]["conv_id"])):
            pieces_of.setdefault(conv, []).append(row["pid"])
    crossing = {c: p for c, p in pieces_of.items() if len(p) > 1}
    wanted = {(p, c) for c, ps in crossing.items() for p in ps}
    entry: dict[tuple[int, object], list[int]] = {}
    exits: dict[tuple[int, object], int] = {}

    def described(given: dict, schema: str) -> dict:
        """For each crossing piece: its min-plus matrix, or with entry costs its state before for each state after."""
        def describe(batches):
            out = []
            for pid, conv, rows in _pieces(batches):
                if (pid, conv) in wanted:
                    roles = [role_of(r[1]) for r in rows]
                    if given:
                        _, back = forward(given[pid, conv], roles)
                        values = [backward(back, q)[0] for q in range(4)]
                    else:
                        values = [c for s in range(4) for c in forward([0 if x == s else FAR for x in range(4)], roles)[0]]
                    out.append((pid, conv, values))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.int64()))], ["pid", "conv_id", "values"])

        return {(r["pid"], r["conv_id"]): r["values"] for r in sorted_rows.mapInArrow(describe, schema).collect()}

    if crossing:
        schema = "pid int, conv_id long, values array<long>"
        matrices = described({}, schema)
        last = {}
        for conv, pids in crossing.items():
            costs = [0, FAR, FAR, FAR]
            for p in pids:
                entry[p, conv], m = costs, matrices[p, conv]
                costs = [min(min(costs[s] + m[4 * s + q] for s in range(4)), FAR) for q in range(4)]
            last[conv] = best_end(costs)
        before = described(entry, schema)
        for conv, pids in crossing.items():
            state = last[conv]
            for p in reversed(pids):
                exits[p, conv] = state
                state = before[p, conv][state]
    final = {c: p[-1] for c, p in crossing.items()}

    def solve(batches):
        held: list = []
        names = ["conv_id", "turn", "old_role", "role", "action", "relabelled", "n_inserted", "fragment"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string()]

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in held], t) for k, t in enumerate(kinds)], names)

        for pid, conv, rows in _pieces(batches):
            roles = [role_of(r[1]) for r in rows]
            if (pid, conv) in exits:
                _, back = forward(entry[pid, conv], roles)
                states = backward(back, exits[pid, conv])
            else:
                states = repair(roles)
            for row, made in zip(rows, _fragments(states, roles, [r[2] or "" for r in rows], final.get(conv, pid) == pid), strict=True):
                held.append((conv, row[0], row[1], *made))
            if len(held) >= 4096:
                yield batch()
                held = []
        yield batch()

    return sorted_rows.mapInArrow(solve, "conv_id long, turn long, old_role string, role string, action string, relabelled boolean, n_inserted long, fragment string")
