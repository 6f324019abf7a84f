"""Conversations repaired to legal role sequences at minimum cost, and rendered."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.plans.shared import broadcast_if_small, materialise
from tidegrid.plans.ship import ship

#: States of the automaton of legal sequences, which ends in ``assistant``.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs of a turn that joins the one before, of an empty turn put in, and of a change
#: of role (from a known one; names of no known role cost one).
MERGE, INSERT, RELABEL, UNKNOWN = 2, 3, 4, 1
NONE = 1 << 40
#: Turns of a chunk of a long conversation.
CHUNK = 2048

# an action leads from one state to another: the role a turn gets, whether it merges
# into the turn before, and the empty turns put in before it
Action = tuple[int, bool, tuple[int, ...]]


def _inserts() -> dict[tuple[int, int], tuple[int, ...]]:
    """The fewest empty turns to put in so that ``role`` may follow ``state``."""
    found: dict[tuple[int, int], tuple[int, ...]] = {}
    for state in range(4):
        paths: list[tuple[int, tuple[int, ...]]] = [(state, ())]
        while paths:
            at, put = paths.pop(0)
            for role in LEGAL[at]:
                if (state, role) not in found:
                    found[state, role] = put
                    paths.append((role, (*put, role)))
    return found


_PUT = _inserts()
#: From each state, in order of preference: cost without relabelling, and action.
ACTIONS: list[list[tuple[int, Action]]] = [
    sorted(
        [(MERGE, (s, True, ()))] * (s != START) + [(INSERT * len(put), (role, False, put)) for (at, role), put in _PUT.items() if at == s],
        key=lambda x: (x[0], x[1][0]),
    )
    for s in range(4)
]
#: What it costs to end a conversation in each state: empty turns up to ``assistant``.
CLOSING = [INSERT * (0 if s == ASSISTANT else len(_PUT[s, ASSISTANT]) + 1) for s in range(4)]
END_PUT = [() if s == ASSISTANT else (*_PUT[s, ASSISTANT], ASSISTANT) for s in range(4)]


def _relabel(role: str | None, to: int) -> int:
    return 0 if role == ROLES[to] else RELABEL if role in ROLES[1:] else UNKNOWN


_NAMES = (*ROLES[1:], None)
#: Transition costs of one turn by its role: state before x state after.
STEPS = {role: np.full((4, 4), NONE, np.int64) for role in _NAMES}
for _role, _m in STEPS.items():
    for _s in range(4):
        for _cost, (_to, _, _) in ACTIONS[_s]:
            _m[_s, _to] = min(_m[_s, _to], _cost + _relabel(_role, _to))


def known(role: str | None) -> str | None:
    return role if role in ROLES[1:] else None


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), NONE)


def to_go(roles: list[str | None], closing: np.ndarray) -> np.ndarray:
    """Least cost from before each turn to the end, for each state."""
    out = np.empty((len(roles) + 1, 4), np.int64)
    out[-1] = closing
    for i in range(len(roles) - 1, -1, -1):
        out[i] = np.minimum((STEPS[known(roles[i])] + out[i + 1]).min(axis=1), NONE)
    return out


def walk(roles: list[str | None], state: int, closing: np.ndarray) -> tuple[list[Action], int]:
    """The first least-cost actions in order of preference, and the state they end in."""
    left, out = to_go(roles, closing), []
    for i, role in enumerate(roles):
        action = next(a for c, a in ACTIONS[state] if c + _relabel(role, a[0]) + left[i + 1][a[0]] == left[i][state])
        out.append(action)
        state = action[0]
    return out, state


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``chunk`` and ``place`` to sorted turns; a chunk holds whole conversations or a part of one."""
    task = TaskContext.get().partitionId()
    chunk, held, last = 0, 0, None
    for batch in batches:
        chunks, places = [], []
        for conv in batch.column("conv").to_pylist():
            if held >= CHUNK or held >= CHUNK // 4 and conv != last:
                chunk, held = chunk + 1, 0
            chunks.append((task << 32) + chunk)
            places.append(held)
            held, last = held + 1, conv
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunks, pa.int64()), pa.array(places, pa.int32())], [*batch.schema.names, "chunk", "place"])


def _pieces(rows: pd.DataFrame) -> list[pd.DataFrame]:
    """Runs of one conversation in a chunk, in order."""
    rows = rows.sort_values("place", ignore_index=True)
    cuts = [*np.flatnonzero(rows["conv"] != rows["conv"].shift()), len(rows)]
    return [rows.iloc[a:b] for a, b in zip(cuts, cuts[1:])]


def _roles(piece: pd.DataFrame) -> list[str | None]:
    return [r if isinstance(r, str) else None for r in piece["role"]]


def _summary(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the first and the last conversation of a chunk, which others may continue: their matrices."""
    out, pieces = [], _pieces(rows)
    for piece in [pieces[0], *pieces[1:][-1:]]:
        m = np.where(np.eye(4, dtype=bool), 0, NONE).astype(np.int64)
        for role in _roles(piece):
            m = product(m, STEPS[known(role)])
        out.append((piece["conv"].iloc[0], rows["chunk"].iloc[0], m.ravel().tolist()))
    return pd.DataFrame(out, columns=["conv", "chunk", "costs"])


def _goals(rows: pd.DataFrame) -> pd.DataFrame:
    """For each part of a conversation, the least cost from its end onwards; no row for whole ones."""
    rows = rows.sort_values("chunk", ignore_index=True)
    goals, after = [], np.array(CLOSING, np.int64)
    for costs in rows["costs"][::-1]:
        goals.append(after.tolist())
        after = np.minimum((np.array(costs).reshape(4, 4) + after).min(axis=1), NONE)
    rows = rows.assign(goal=goals[::-1], last=rows.index == len(rows) - 1)
    return (rows if len(rows) > 1 else rows.iloc[:0])[["conv", "chunk", "goal", "last"]]


def _exits(rows: pd.DataFrame) -> pd.DataFrame:
    """Where a part of a conversation ends, for each state it may be entered in."""
    closing = np.array(rows["goal"].iloc[0], np.int64)
    roles = _roles(rows.sort_values("place"))
    exits = [walk(roles, s, closing)[1] for s in range(4)]
    return rows[["conv", "chunk", "goal", "last"]].iloc[:1].assign(exits=[exits])


def _entries(rows: pd.DataFrame) -> pd.DataFrame:
    rows, state, entry = rows.sort_values("chunk", ignore_index=True), START, []
    for exits in rows["exits"]:
        entry.append(state)
        state = exits[state]
    return rows.assign(entry=entry)[["conv", "chunk", "goal", "last", "entry"]]


def _repair(rows: pd.DataFrame) -> pd.DataFrame:
    out = []
    for piece in _pieces(rows):
        part = not pd.isna(piece["entry"].iloc[0])
        entry = int(piece["entry"].iloc[0]) if part else START
        actions, state = walk(_roles(piece), entry, np.array(piece["goal"].iloc[0] if part else CLOSING, np.int64))
        last = not part or bool(piece["last"].iloc[0])
        for i, (row, (role, merged, put)) in enumerate(zip(piece["row"], actions)):
            ends = last and i == len(actions) - 1
            out.append((row, ROLES[role], merged, [ROLES[r] for r in put], [ROLES[r] for r in END_PUT[state]] if ends else [], i == 0 and entry == START, ends))
    return pd.DataFrame(out, columns=["row", "new_role", "merged", "inserted", "appended", "opens", "ends"])


_PART = "conv string, chunk long, goal array<long>, last boolean"


def repaired(turns: DataFrame) -> DataFrame:
    """Each turn with its repair and its part of the rendered conversation.

    Returns for every row of ``turns``: ``conv_id, turn, role, new_role, merged,
    inserted, appended, rendered``. Turns are ordered by turn, role and text; a
    null role and roles other than system, user and assistant are unknown and get
    one of these at a lower cost. A legal sequence has at most one system turn, at
    the start, then user and assistant in turn, and ends with the assistant.
    ``merged`` turns join the one before; ``inserted`` and ``appended`` name the
    empty turns put in before it and, at the end, after it. Of repairs of least
    cost the one is taken whose first choices come first in ``ACTIONS``.

    A turn is rendered as ``<|role|>``, its text and ``<|end|>`` on lines of their
    own; a line of a text that begins with ``<|``, or with backslashes before it, gets
    one more backslash, so that the rendering can be read back. ``rendered`` is what a row adds, so that a conversation is the ``rendered``
    of its rows in order. Null texts render as empty, rows with a null conv_id are
    one conversation, repeated rows are turns of their own, an empty table gives an
    empty result, and other columns are not read.

    The costs of a run of turns are a min-plus matrix over the automaton's states,
    so long conversations are cut into chunks that are solved side by side.
    """
    ship(turns.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    slim = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), text.alias("text"), conv.alias("conv"))
    kinds = {c: slim.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    order = ["conv", "turn", "role", "text", "salt"]
    dealt = slim.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    dealt = dealt.mapInArrow(_chunked, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, conv string, chunk long, place int")
    dealt = materialise(dealt.withColumn("row", F.monotonically_increasing_id()), "turns")
    roles = dealt.select("conv", "role", "chunk", "place", "row")

    sums = roles.groupBy("chunk").applyInPandas(_summary, "conv string, chunk long, costs array<long>")
    parts = materialise(sums.groupBy("conv").applyInPandas(_goals, _PART), "parts")
    cut = roles.join(broadcast_if_small(parts), ["conv", "chunk"])
    exits = cut.groupBy("chunk", "conv").applyInPandas(_exits, f"{_PART}, exits array<int>")
    entries = materialise(exits.groupBy("conv").applyInPandas(_entries, f"{_PART}, entry int"), "entries")
    entered = roles.join(broadcast_if_small(entries), ["conv", "chunk"], "left")
    fixed = entered.groupBy("chunk").applyInPandas(
        _repair, "row long, new_role string, merged boolean, inserted array<string>, appended array<string>, opens boolean, ends boolean"
    )

    head: Callable[[Column], Column] = lambda r: F.concat(F.lit("<|"), r, F.lit("|>\n"))
    tail = F.lit("\n<|end|>\n")
    empty: Callable[[str], Column] = lambda c: F.array_join(F.transform(c, lambda r: F.concat(head(r), tail)), "")
    before = F.concat(F.when(F.col("opens"), "").otherwise(tail), empty("inserted"), head(F.col("new_role")))
    after = F.when(F.col("ends"), F.concat(tail, empty("appended"))).otherwise("")
    shown = F.when(F.col("text").contains("<|"), F.regexp_replace("text", r"(?dm)^(\\*<\|)", r"\\$1")).otherwise(F.col("text"))
    rendered = F.concat(F.when(F.col("merged"), F.lit("\n")).otherwise(before), shown, after)
    return dealt.join(fixed, "row").select("conv_id", "turn", "role", "new_role", "merged", "inserted", "appended", rendered.alias("rendered"))
