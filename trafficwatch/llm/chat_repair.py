"""Least-cost repair of conversation roles, and chat rendering.

Legal conversations: an optional system turn, then user and assistant in turn,
ending with the assistant.  Dynamic programming over that automaton decides for
every turn whether it keeps its role, takes another, merges into the turn
before, or needs empty turns inserted before it (and after the last one).

The table is sorted by conversation and turn into segments of bounded size.
A segment's effect on a conversation is a (min, +) matrix over the states, so a
conversation of any length is solved from its segments' matrices first and
inside each segment afterwards, without bringing its turns together.

Defined results: turns are ordered by (turn, role, text hash), nulls first;
rows that repeat are turns of their own; null text is empty; roles are compared
in lower case without outer blanks, others and null are relabelled; rows
without conv_id form one conversation; chat markers inside a text are broken
up by a zero-width space; a very long text passes
as it is, in the segment of its turn; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm import shared

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the turn before.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_FAR = 10**12
_SEGMENT_ROWS, _SEGMENT_BYTES = 10_000, 4 << 20


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    relabel: int = 2
    name: int = 1  # a role for a turn that has none
    insert: int = 3


@lru_cache
def _way(state: int, role: int) -> tuple[int, ...] | None:
    """Fewest turns to insert so that a turn of ``role`` may follow ``state``; None if none can."""
    paths = [(state, ())]
    for _ in range(4):
        for at, done in paths:
            if role in _NEXT[at]:
                return done
        paths = [(n, (*done, n)) for at, done in paths for n in _NEXT[at]]
    return None


@lru_cache
def actions(kind: int, costs: Costs) -> tuple[np.ndarray, dict]:
    """For a turn of role ``kind`` (0: another or none): cost matrix and the cheapest action of each (state, next state)."""
    matrix, chosen = np.full((4, 4), _FAR, np.int64), {}
    for state in range(4):
        for role in (SYSTEM, USER, ASSISTANT):
            label = 0 if role == kind else costs.relabel if kind else costs.name
            options = []
            if state == role:
                options.append((costs.merge, True, ()))
            way = _way(state, role)
            if way is not None:
                options.append((costs.insert * len(way), False, way))
            if options:
                cost, merged, way = min(options)
                matrix[state, role] = label + cost
                chosen[state, role] = (label + cost, merged, way)
    return matrix, chosen


def closing(costs: Costs) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """Cost and inserted turns for ending in each state."""
    ways = [() if s in (START, ASSISTANT) else (*_way(s, ASSISTANT), ASSISTANT) for s in range(4)]
    return np.array([costs.insert * len(w) for w in ways]), ways


def kind_of(role: str | None) -> int:
    role = (role or "").strip().lower()
    return ROLES.index(role) + 1 if role in ROLES else 0


def product(kinds: list[int], costs: Costs) -> np.ndarray:
    """(min, +) product of the turns' matrices."""
    out = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for k in kinds:
        out = (out[:, :, None] + actions(k, costs)[0][None, :, :]).min(1)
        np.minimum(out, _FAR, out=out)
    return out


def solve(kinds: list[int], entry: int, end: np.ndarray, costs: Costs) -> list[int]:
    """States after each turn on a cheapest path from ``entry``, with end costs by state."""
    n = len(kinds)
    best = np.full((n + 1, 4), _FAR, np.int64)
    best[0, entry] = 0
    back = np.zeros((n, 4), np.int64)
    for t, k in enumerate(kinds):
        total = best[t][:, None] + actions(k, costs)[0]
        back[t] = total.argmin(0)
        best[t + 1] = np.minimum(total.min(0), _FAR)
    state, path = int((best[n] + end).argmin()), []
    for t in range(n - 1, -1, -1):
        path.append(state)
        state = int(back[t][state])
    return path[::-1]


def _segments(turns: DataFrame, segment_rows: int) -> DataFrame:
    """The sorted turns with their segment and place, stored."""

    def run(batches):
        part, seq, at, held = TaskContext.get().partitionId(), 0, 0, 0
        for batch in shared.by_bytes(batches, 3, 1 << 20):
            for k in range(0, batch.num_rows, segment_rows):
                own = batch.slice(k, segment_rows)
                if at and (at + own.num_rows > segment_rows or held > _SEGMENT_BYTES):
                    seq, at, held = seq + 1, 0, 0
                n = own.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([part << 32 | seq] * n), pa.array(np.arange(at, at + n)), *own.columns], names=["segment", "place", "conv_id", "turn", "role", "text"])
                at, held = at + n, held + own.column(3).nbytes

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "_tie"]
    rows = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    return shared.materialize(rows.mapInArrow(run, "segment long, place long, conv_id long, turn long, role string, text string"), "turns", batch_rows=1024)


def _runs(ids: list) -> list[tuple[int, int]]:
    """Bounds of the runs of equal ids."""
    cut = [0] + [k for k in range(1, len(ids)) if ids[k] != ids[k - 1]] + [len(ids)]
    return list(zip(cut, cut[1:]))


def _boundary_states(stored: DataFrame, costs: Costs) -> DataFrame:
    """(segment, conv_id, entry, leave): states at the ends of the conversations that reach a segment's edge; leave -1: ends there."""

    def matrices(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        ids, roles = table["conv_id"].to_pylist(), table["role"].to_pylist()
        runs = _runs(ids)
        edges = runs if len(runs) < 2 else [runs[0], runs[-1]]
        out = [product([kind_of(r) for r in roles[a:b]], costs).ravel().tolist() for a, b in edges]
        segment = table["segment"][0].as_py()
        return pa.table({"segment": pa.array([segment] * len(out)), "conv_id": pa.array([ids[a] for a, _ in edges], pa.int64()), "costs": pa.array(out, pa.list_(pa.int64()))})

    def states(table: pa.Table) -> pa.Table:
        table = table.sort_by("segment")
        steps = [np.array(m).reshape(4, 4) for m in table["costs"].to_pylist()]
        end, _ = closing(costs)
        best, back = np.array([0, _FAR, _FAR, _FAR]), []
        for m in steps:
            total = best[:, None] + m
            back.append(total.argmin(0))
            best = np.minimum(total.min(0), _FAR)
        state, entry, leave = int((best + end).argmin()), [], []
        for k in range(len(steps) - 1, -1, -1):
            leave.append(-1 if k == len(steps) - 1 else state)
            state = int(back[k][state])
            entry.append(state)
        return pa.table({"segment": table["segment"], "conv_id": table["conv_id"], "entry": pa.array(entry[::-1], pa.int32()), "leave": pa.array(leave[::-1], pa.int32())})

    edges = stored.select("segment", "place", "conv_id", "role").groupBy("segment").applyInArrow(matrices, "segment long, conv_id long, costs array<long>")
    return edges.groupBy("conv_id").applyInArrow(states, "segment long, conv_id long, entry int, leave int")


def _turn(role: int, text: str = "") -> str:
    return f"<|im_start|>{ROLES[role - 1]}\n{text}"


_CLOSE = "<|im_end|>\n"


def _safe(text: str) -> str:
    return text.replace("<|im_start|>", "<​|im_start|>").replace("<|im_end|>", "<​|im_end|>")


def repair(turns: DataFrame, costs: Costs = Costs(), segment_rows: int = _SEGMENT_ROWS) -> DataFrame:
    """One row per turn of ``turns`` (conv_id, turn, role, text), in repaired form.

    ``fragment`` is the turn's part of the rendered chat: the fragments of a
    conversation in (segment, place) order, put together, are its rendering.
    """
    shared.with_python(turns.sparkSession)
    stored = _segments(turns, segment_rows)
    edges = shared.materialize(_boundary_states(stored, costs), "boundary-states")
    same = F.col("t.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("t.segment") == F.col("e.segment"))
    joined = stored.alias("t").join(edges.alias("e"), same, "left").select("t.*", "e.entry", "e.leave")
    end, ways = closing(costs)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        ids, roles, texts, entries, leaves = (table[c].to_pylist() for c in ("conv_id", "role", "text", "entry", "leave"))
        out = {"new_role": [], "action": [], "inserted": [], "cost": [], "fragment": []}
        for a, b in _runs(ids):
            kinds = [kind_of(r) for r in roles[a:b]]
            state = START if entries[a] is None else entries[a]
            goal = end if leaves[a] in (None, -1) else np.where(np.arange(4) == leaves[a], 0, _FAR)
            path = solve(kinds, state, goal, costs)
            for k, (kind, role) in enumerate(zip(kinds, path)):
                cost, merged, way = actions(kind, costs)[1][state, role]
                inserted = list(way)
                text = _safe(texts[a + k])
                if merged:
                    piece = "\n" + text
                else:
                    piece = (_CLOSE if state != START else "") + "".join(_turn(w) + _CLOSE for w in way) + _turn(role, text)
                if k == len(path) - 1 and leaves[a] in (None, -1):
                    piece += _CLOSE + "".join(_turn(w) + _CLOSE for w in ways[role])
                    cost += int(end[role])
                    inserted += ways[role]
                out["new_role"].append(ROLES[role - 1])
                out["action"].append(("merge" if merged else "append") if role == kind else ("relabel+merge" if merged else "relabel"))
                out["inserted"].append([ROLES[w - 1] for w in inserted])
                out["cost"].append(cost)
                out["fragment"].append(piece)
                state = role
        kinds_ = {"new_role": pa.string(), "action": pa.string(), "inserted": pa.list_(pa.string()), "cost": pa.int64(), "fragment": pa.string()}
        columns = {c: table[c] for c in ("segment", "place", "conv_id", "turn", "role")}
        return pa.table(columns | {c: pa.array(v, kinds_[c]) for c, v in out.items()})

    schema = "segment long, place long, conv_id long, turn long, role string, new_role string, action string, inserted array<string>, cost long, fragment string"
    return joined.groupBy("segment").applyInArrow(run, schema)


def rendered(fragments: DataFrame) -> DataFrame:
    """conv_id, turns, cost and the whole chat text, for conversations that fit a row."""
    ordered = F.array_sort(F.collect_list(F.struct("segment", "place", "fragment")))
    rows = fragments.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.sum("cost").alias("cost"), ordered.alias("_parts"))
    return rows.select("conv_id", "turns", "cost", F.array_join(F.transform("_parts", lambda x: x["fragment"]), "").alias("chat"))
