"""Chat formatting with minimum-cost role repair.

A legal conversation is a path of the turn automaton: an optional system turn, then user and assistant turns in turn
(an assistant may call a tool, whose turn goes back to the assistant), ending with the assistant. For each turn the
repair keeps or changes its role, merges it into the repaired turn before, or puts empty turns before it; the cheapest
repair (then the one of fewest turns) is found by dynamic programming over the automaton's states.

A step of the programme is a min-plus matrix, so a conversation of any length can be cut: rows are dealt out by ranges
of (conversation, turn), each task gives the product of its first and last conversation's matrices (two small matrices
a partition reach the driver), the driver fixes the states at the cuts, and each task then repairs its own rows. The
result has a row for every input turn with its piece of the rendering: pieces joined in order are the conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_folder, text_of

# States of the automaton, its moves, where it may end, and the costs.
STATES = ("start", "system", "user", "assistant", "tool")
MOVES = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)}
FINAL = "assistant"
MERGE, RELABEL, INSERT = 1, 2, 3

_N = len(STATES)
_UNIT = 1 << 32  # a value is cost * _UNIT + repaired turns
_FAR = 1 << 60


def _paths() -> dict[tuple[int, int], list[int]]:
    """The shortest path of one move or more from state to state, without the first."""
    out = {}
    for s in range(_N):
        layer = [[STATES.index(x)] for x in MOVES[STATES[s]]]
        while layer:
            more = []
            for p in layer:
                if (s, p[-1]) not in out:
                    out[s, p[-1]] = p
                    more += [[*p, STATES.index(x)] for x in MOVES[STATES[p[-1]]]]
            layer = more
    return out


_PATH = _paths()
_END = [_PATH.get((s, STATES.index(FINAL))) if STATES[s] not in (FINAL, "start") else [] for s in range(_N)]
END_VALUE = np.array([len(p) * (INSERT * _UNIT + 1) for p in _END], np.int64)


def step(role: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(values, merges): the cheapest way from state to state over a turn of this role; null and unknown are relabelled."""
    value, merge = np.full((_N, _N), _FAR, np.int64), np.zeros((_N, _N), bool)
    for s in range(_N):
        for t in range(1, _N):
            base = 0 if STATES[t] == role else RELABEL
            if (s, t) in _PATH:
                n = len(_PATH[s, t])
                value[s, t] = (base + INSERT * (n - 1)) * _UNIT + n
            if s == t and (base + MERGE) * _UNIT < value[s, t]:
                value[s, t], merge[s, t] = (base + MERGE) * _UNIT, True
    return value, merge


STEPS = {r: step(r) for r in (*STATES[1:], None)}


def _role(r: str | None) -> str | None:
    r = r.strip().lower() if r else None
    return r if r in STEPS else None


def product(roles: list[str | None]) -> np.ndarray:
    """The min-plus product of the turns' matrices."""
    out = np.where(np.eye(_N, dtype=bool), 0, _FAR)
    for r in roles:
        out = np.minimum((out[:, :, None] + STEPS[r][0][None]).min(axis=1), _FAR)
    return out


def best_path(roles: list[str | None], entry: int = 0, leave: int | None = None) -> list[int]:
    """The states after each turn, of the cheapest repair that begins in `entry` and ends in `leave` (None: at an end)."""
    value, back = np.full(_N, _FAR, np.int64), []
    value[entry] = 0
    for r in roles:
        both = value[:, None] + STEPS[r][0]
        back.append(both.argmin(axis=0))
        value = np.minimum(both.min(axis=0), _FAR)
    at = int((value + END_VALUE).argmin()) if leave is None else leave
    out = []
    for b in reversed(back):
        out.append(at)
        at = int(b[at])
    return out[::-1]


def render(roles: list[str | None], raw: list[str | None], texts: list[str], states: list[int], entry: int, seq: int, ends: bool) -> Iterator[tuple]:
    """(seq, role, action, inserted before, inserted after, piece, cost) of each turn."""
    s = entry
    for i, (r, t, text) in enumerate(zip(roles, states, texts, strict=True)):
        merged = bool(STEPS[r][1][s, t])
        cost = (0 if STATES[t] == r else RELABEL) + (MERGE if merged else 0)
        empty = 0
        if merged:
            piece = "\n" + text
        else:
            path = _PATH[s, t]
            empty = len(path) - 1
            seq += len(path)
            cost += INSERT * empty
            piece = ("<|end|>\n" if s else "") + "".join(f"<|{STATES[x]}|>\n<|end|>\n" for x in path[:-1]) + f"<|{STATES[t]}|>\n{text}"
        action = ("merge" if merged else "keep") if STATES[t] == r else ("relabel+merge" if merged else "relabel")
        after = 0
        if ends and i == len(roles) - 1:
            after = len(_END[t])
            cost += INSERT * after
            piece += "<|end|>\n" + "".join(f"<|{STATES[x]}|>\n<|end|>\n" for x in _END[t])
        yield seq, STATES[t], action, empty, after, piece, cost
        s = t


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """(conversation, its rows) in order, for rows that are sorted by conversation."""
    conv, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and row[0] != conv:
                yield conv, rows
                rows = []
            conv = row[0]
            rows.append(row)
    if rows:
        yield conv, rows


def _cuts(found: list) -> dict[tuple[int, bool], tuple[int, int | None, int]]:
    """(partition, whether its first segment) -> (state before, state after or None at the end, turns before)."""
    out = {}
    found = sorted(found, key=lambda r: (r["part"], r["last"]))
    i = 0
    while i < len(found):
        j = i + 1  # a chain: the last segment of a partition goes on in the first of the next that has rows
        while j < len(found) and found[j]["part"] != found[j - 1]["part"] and found[j]["conv"] == found[j - 1]["conv"]:
            j += 1
        chain = found[i:j]
        value, back, values = np.full(_N, _FAR, np.int64), [], []
        value[0] = 0
        for r in chain:
            values.append(value)
            both = value[:, None] + np.array(r["product"], np.int64).reshape(_N, _N)
            back.append(both.argmin(axis=0))
            value = np.minimum(both.min(axis=0), _FAR)
        leave = int((value + END_VALUE).argmin())
        for k in range(len(chain) - 1, -1, -1):
            entry = int(back[k][leave])
            out[chain[k]["part"], not chain[k]["last"]] = (entry, leave if k < len(chain) - 1 else None, int(values[k][entry] % _UNIT))
            leave = entry
        i = j
    return out


def repair_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per input turn: conversation, turn, `seq` (its repaired turn, from 1), new role, action, empty turns put
    before and after it, cost, and its piece of the rendering.

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows have a defined order; a null
    conversation is one conversation. Null and unknown roles are relabelled; null texts are empty; other columns are
    ignored; an empty table gives no rows.
    """
    spark = turns.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), text_of(text_col).alias("text"), F.monotonically_increasing_id().alias("tie"))
    order = ["conv", "turn", "role", "text", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text").checkpoint()

    def ends(batches):
        first = last = None
        for conv, part in _segments(batches):
            now = (conv, product([_role(r[2]) for r in part])) if first is None else (conv, part)
            if first is None:
                first = now
            else:
                last = now
        found = [] if first is None else [(False, *first)]
        if last is not None:
            found.append((True, last[0], product([_role(r[2]) for r in last[1]])))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(found), pa.int32()), "last": pa.array([x for x, *_ in found], pa.bool_()), "conv": pa.array([repr(x) for _, x, _ in found], pa.string()), "product": pa.array([p.ravel().tolist() for *_, p in found], pa.list_(pa.int64()))})

    cuts = spark.sparkContext.broadcast(_cuts(rows.select("conv", "turn", "role").mapInArrow(ends, "part int, last boolean, conv string, product array<bigint>").collect()))

    kinds = [("seq", "bigint", pa.int64()), ("role", "string", pa.string()), ("action", "string", pa.string()), ("inserted_before", "bigint", pa.int64()), ("inserted_after", "bigint", pa.int64()), ("rendered", "string", pa.string()), ("cost", "bigint", pa.int64())]
    schema = T.StructType([T.StructField(conv_col, rows.schema["conv"].dataType), T.StructField(turn_col, rows.schema["turn"].dataType), *(T.StructField(n, T._parse_datatype_string(t)) for n, t, _ in kinds)])

    def repair(batches):
        part, held, first = TaskContext.get().partitionId(), None, True
        types: list = []

        def noted(it):
            for b in it:
                types[:] = [b.column(0).type, b.column(1).type]
                yield b

        def out(segment, cut):
            entry, leave, seq = cut
            raw = [r[2] for r in segment]
            roles = [_role(r) for r in raw]
            states = best_path(roles, entry, leave)
            got = list(render(roles, raw, [r[3] for r in segment], states, entry, seq, leave is None))
            for i in range(0, len(got), 4096):
                a, b = segment[i : i + 4096], got[i : i + 4096]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in a], types[0]), pa.array([r[1] for r in a], types[1]), *(pa.array([r[k] for r in b], kind) for k, (_, _, kind) in enumerate(kinds))], names=schema.names)

        for _, segment in _segments(noted(batches)):
            if held is not None:
                yield from out(held, cuts.value[part, True] if first else (0, None, 0))
                first = False
            held = segment
        if held is not None:
            yield from out(held, cuts.value[part, first])

    return rows.mapInArrow(repair, schema)
