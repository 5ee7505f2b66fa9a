"""Chat formatting with minimum-cost role repair.

Grammar. A legal conversation is an optional system turn, then user and assistant in turn, ending
with an assistant. Automaton states: nothing yet, after system, after user, after assistant.

Method. Each turn is given a role (its own, or another at ``RELABEL``, or at ``UNKNOWN`` if its own is
none of the three) and is appended where the role is legal, merged into the turn before if that has
the same role (``MERGE``), or preceded by the one or two empty turns that make it legal (``INSERT`` each).
At the end empty turns are added until the state is legal. The cheapest choice is found by dynamic
programming. A turn's costs form a matrix from state to state, and matrices combine in the algebra of
minimum and plus, which is associative: a conversation is cut into chunks of at most ``CHUNK_TURNS``
turns, each chunk gives one small matrix, the matrices of a conversation give each chunk its entry
and exit state, and chunks are then traced back on their own. A conversation that holds a third of
all rows is spread over as many tasks as its
partitions are; only one matrix for each of these comes together.

Output is one row a turn with its rendered piece; the pieces of a conversation, in order, are the
rendered conversation. Ties go to the smaller state and then to fewer inserts, so runs agree.

Cases. A null or unknown role is relabelled at ``UNKNOWN``; roles are compared trimmed and in lower
case. Null and empty texts are kept as empty turns. Turns of one number stand in order of role and
text; null numbers come last. A null conv_id is a conversation of its own. Repeated rows are turns.
Empty tables give no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import table
from shelfmark.session import stash

ROLES = ("system", "user", "assistant")
RELABEL, UNKNOWN, MERGE, INSERT = 4, 1, 1, 3
#: Bound of a chunk.
CHUNK_TURNS, CHUNK_CHARS = 512, 4_000_000
STATES = 4  # 0 nothing yet, else 1 + index of the last role
FAR = 10**9
#: Roles that must be put in, empty, before a role is legal after a state; None: never.
GAP: dict[tuple[int, int], tuple[int, ...] | None] = {
    (0, 0): (), (0, 1): (), (0, 2): (1,),
    (1, 0): None, (1, 1): (), (1, 2): (1,),
    (2, 0): None, (2, 1): (2,), (2, 2): (),
    (3, 0): None, (3, 1): (), (3, 2): (1,),
}
#: Empty turns that end a conversation legally, by last state.
CLOSING = {0: (), 1: (1, 2), 2: (2,), 3: ()}


def role_code(role: str | None) -> int:
    r = (role or "").strip().lower()
    return ROLES.index(r) if r in ROLES else -1


def options(code: int, state: int) -> list[tuple[int, int, bool, tuple[int, ...]]]:
    """``(cost, next state, merged, inserts)`` for a turn of role ``code`` after ``state``."""
    out = []
    for role in range(3):
        cost = 0 if role == code else UNKNOWN if code < 0 else RELABEL
        if state == role + 1:
            out.append((cost + MERGE, role + 1, True, ()))
        gap = GAP[(state, role)]
        if gap is not None:
            out.append((cost + INSERT * len(gap), role + 1, False, gap))
    return out


_BEST = {(c, s): {t: min(((o[0], len(o[3]), not o[2]), o) for o in options(c, s) if o[1] == t)[1] for t in {o[1] for o in options(c, s)}} for c in range(-1, 3) for s in range(STATES)}
_STEP = {c: np.array([[_BEST[(c, s)][t][0] if t in _BEST[(c, s)] else FAR for t in range(STATES)] for s in range(STATES)]) for c in range(-1, 3)}
_END = np.array([INSERT * len(CLOSING[s]) for s in range(STATES)])


def chunk_matrix(codes: list[int]) -> list[int]:
    m = np.where(np.eye(STATES, dtype=bool), 0, FAR)
    for c in codes:
        m = np.minimum((m[:, :, None] + _STEP[c][None, :, :]).min(1), FAR)
    return m.ravel().tolist()


def combine(matrices: list[list[int]]) -> list[int]:
    """The matrix of matrices one after the other."""
    out = np.where(np.eye(STATES, dtype=bool), 0, FAR)
    for m in matrices:
        out = np.minimum((out[:, :, None] + np.array(m).reshape(STATES, STATES)[None, :, :]).min(1), FAR)
    return out.ravel().tolist()


def chunk_states(matrices: list[list[int]], entry: int = 0, leave: int | None = None) -> tuple[list[tuple[int, int]], int]:
    """Entry and exit state of each chunk between two states (no ``leave``: to the end), and the whole cost."""
    ms = [np.array(m).reshape(STATES, STATES) for m in matrices]
    best = [np.where(np.arange(STATES) == entry, 0, FAR)]
    for m in ms:
        best.append(np.minimum((best[-1][:, None] + m).min(0), FAR))
    state = int(np.argmin(best[-1] + _END)) if leave is None else leave
    total, out = int(best[-1][state] + (_END[state] if leave is None else 0)), []
    for i in range(len(ms) - 1, -1, -1):
        before = int(np.argmin(best[i] + ms[i][:, state]))
        out.append((before, state))
        state = before
    return out[::-1], total


def trace(codes: list[int], entry: int, leave: int) -> list[tuple[int, bool, tuple[int, ...]]]:
    """The cheapest ``(state, merged, inserts)`` of each turn between the two states."""
    best = [[0 if s == entry else FAR for s in range(STATES)]]
    for c in codes:
        best.append([min(best[-1][s] + int(_STEP[c][s][t]) for s in range(STATES)) for t in range(STATES)])
    out, state = [], leave
    for i in range(len(codes) - 1, -1, -1):
        before = min((s for s in range(STATES) if state in _BEST[(codes[i], s)]), key=lambda s: best[i][s] + _STEP[codes[i]][s][state])
        _, _, merged, gap = _BEST[(codes[i], before)][state]
        out.append((state, merged, gap))
        state = before
    return out[::-1]


def _open(role: int) -> str:
    return f"<|im_start|>{ROLES[role]}\n"


def _chunks(turns: DataFrame) -> DataFrame:
    """Turns in order, cut into written chunks: one row a chunk with its turns and its matrix."""
    order = [F.col("conv_id").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("role").asc(), F.col("text").asc()]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["conv_id", "part", "chunk", "turns", "roles", "texts", "matrix"]
    longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        number, size, conv = 0, 0, None

        def flush() -> pa.RecordBatch:
            matrix = chunk_matrix([role_code(h[1]) for h in held])
            values = [conv, part, number, [h[0] for h in held], [h[1] for h in held], [h[2] for h in held], matrix]
            kinds = [pa.int64(), pa.int64(), pa.int64(), longs, strings, strings, longs]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for c, t, r, x in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text"))):
                if held and (c != conv or len(held) >= CHUNK_TURNS or size >= CHUNK_CHARS):
                    yield flush()
                    held, number, size = [], number + 1, 0
                conv = c
                held.append((t, r, x))
                size += len(x or "")
        if held:
            yield flush()

    return stash(rows.mapInArrow(run, "conv_id long, part long, chunk long, turns array<bigint>, roles array<string>, texts array<string>, matrix array<bigint>"), "chunks")


def repair(turns: DataFrame) -> DataFrame:
    """One row a turn: new role, action, inserts before and after it, its conversation's cost, its rendered piece."""
    chunks = _chunks(turns)
    # chunks of a partition combine to one matrix, so that a conversation gathers one for each partition it spans
    lists = chunks.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("chunk", "matrix"))).alias("list"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [combine([c["matrix"] for c in row]) for row in batch.column("list").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(made, pa.list_(pa.int64()))], ["conv_id", "part", "matrix"])

    parts = lists.mapInArrow(sums, "conv_id long, part long, matrix array<bigint>")
    by_conv = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "matrix"))).alias("list"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for conv, row in zip(batch.column("conv_id").to_pylist(), batch.column("list").to_pylist()):
                found, total = chunk_states([p["matrix"] for p in row])
                out += [(conv, p["part"], a, b, i + 1 == len(row), total) for i, (p, (a, b)) in enumerate(zip(row, found))]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*out)) or [[]] * 6, kinds)], ["_conv", "_part", "entry", "leave", "final", "cost"])

    spans = by_conv.mapInArrow(ends, "_conv long, _part long, entry int, leave int, final boolean, cost long")

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                found, _ = chunk_states([c["matrix"] for c in row["list"]], row["entry"], row["leave"])
                out += [(row["part"], c["chunk"], a, b, row["final"] and i + 1 == len(found), row["cost"]) for i, (c, (a, b)) in enumerate(zip(row["list"], found))]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*out)) or [[]] * 6, kinds)], ["part", "chunk", "entry", "leave", "last", "cost"])

    met = lists.join(spans, (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv", "_part")
    placed = met.mapInArrow(states, "part long, chunk long, entry int, leave int, last boolean, cost long")
    schema = "conv_id long, turn long, role string, new_role string, action string, n_inserted int, cost long, rendered string"
    names = [f.split()[0] for f in schema.split(", ")]

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = [role_code(r) for r in row["roles"]]
                done = trace(codes, row["entry"], row["leave"])
                out: list[tuple] = []
                for i, (code, (state, merged, gap)) in enumerate(zip(codes, done)):
                    role = state - 1
                    first = row["entry"] == 0 and i == 0
                    end = i + 1 == len(done) and row["last"]
                    after = CLOSING[state] if end else ()
                    # a turn closes the one before it unless it merges into that
                    text = "" if first else "\n" if merged else "<|im_end|>\n"
                    text += "".join(_open(g) + "<|im_end|>\n" for g in gap)
                    text += ("" if merged else _open(role)) + (row["texts"][i] or "")
                    text += ("<|im_end|>\n" + "".join(_open(g) + "<|im_end|>\n" for g in after)) if end else ""
                    action = "+".join(["relabel"] * (code != role) + ["merge"] * merged + ["insert"] * bool(gap or after)) or "keep"
                    out.append((row["conv_id"], row["turns"][i], row["roles"][i], ROLES[role], action, len(gap) + len(after), row["cost"], text))
                kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.int32(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return chunks.join(placed, ["part", "chunk"]).mapInArrow(render, schema)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))
