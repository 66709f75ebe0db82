"""Repair of the structure of conversations at least cost, in linear space.

A conversation is well formed if its roles are empty or an optional system turn followed by
pairs of user and assistant.  Edits, and their letters in the audit: Keep a row (0), Rerole
it to user or assistant (1), Delete it (2; a must for blank rows and repetitions), Insert an
empty user or assistant turn (5).  A row cut off in mid-sentence that is not deleted adds 5.
Of all cheapest lists of edits the one whose letters come first in ASCII is taken.

After any row the result so far is in one of four states: empty, or its last role.  The
method is Hirschberg's: costs of the four states run forward from the start to the middle
of a stretch and backward from its end to the middle; the state where their sum is least is
crossed, and both halves are solved alone.  The forward vector carries, beside the costs,
the order of the states' audits, so that the crossing of the least audit is known without
any audit being kept: two audits of the same rows that end in a row's edit are never one
the beginning of the other, so the first that differs decides.

A conversation may be of any length.  Its rows lie in ranges of the whole order, in stretches
of ``2 ** STRETCH`` rows at most; of a stretch only the costs between every two states go on.
Stretches of one conversation meet ``FAN`` at a time, in levels; from the top the crossings
between them are chosen as between rows, and each stretch is solved between its two states.

Cases: a null role or text is one space, so a row of null text is blank; null turns come
first, rows of equal turn are ordered by role and the digest of their text; a role that
doesn't begin with s, u or a can't be kept; rows of null conversation are one conversation;
an empty table gives an empty result; further columns are left aside.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import Batches, in_arrow, pick
from spoor.session import materialize

# Costs of the edits, white space, marks that end a text.
RENAME, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"

#: Rows of a stretch (as a power of 2), stretches that meet in one task.
STRETCH, FAN = 10, 1024

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
# Where a role may follow, and the state after it.
_FOLLOWS = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# Turns to insert to come from one state to another.
_INSERTS = {(EMPTY, USER): 1, (EMPTY, ASSISTANT): 2, (SYSTEM, USER): 1, (SYSTEM, ASSISTANT): 2,
            (USER, ASSISTANT): 1, (ASSISTANT, USER): 1} | {(s, s): 0 for s in range(4)}
# Turns to insert at the end.
_TAIL = {EMPTY: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}

#: A kind of row: its role's initial (o: another), in capitals if cut off; d: must go.
KINDS = "dsuaoSUAO"


def _row_table(kind: str) -> tuple:
    """Cheapest way (cost, letters) from each state before a row to each after it."""
    ways: dict[tuple[int, int], list] = {}
    for (before, ready), n in _INSERTS.items():
        def way(after, cost, letter):
            ways.setdefault((before, after), []).append((INSERT * n + cost, "I" * n + letter))

        way(ready, DELETE, "D")
        if kind != "d":
            cut = CUT_OFF if kind.isupper() else 0
            for letter, role, cost in (("K", kind.lower(), 0), ("R", "u", RENAME), ("R", "a", RENAME)):
                after = _FOLLOWS.get(role, {}).get(ready)
                if after is not None:
                    way(after, cost + cut, letter)
    return tuple(tuple(min(ways[p, q]) if (p, q) in ways else None for q in range(4)) for p in range(4))


_ROWS = {k: _row_table(k) for k in KINDS}


def _table(element):
    """The ways through an element: the kind of a row, or a stretch's own table, which has
    the order of the audits in place of letters."""
    return _ROWS[element] if isinstance(element, str) else element


@lru_cache(maxsize=1 << 16)
def _forward(vector: tuple, element) -> tuple[tuple, int]:
    """The vector (cost above the least, order of the audit; None: not to be reached) after
    an element, and by how much the least cost rose."""
    ways = _table(element)
    best = []
    for q in range(4):
        found = [(v[0] + ways[p][q][0], v[1], ways[p][q][1])
                 for p, v in enumerate(vector) if v and ways[p][q]]
        best.append(min(found) if found else None)
    keys = sorted({b[1:] for b in best if b}, key=lambda k: k)
    least = min(b[0] for b in best if b)
    return tuple((b[0] - least, keys.index(b[1:])) if b else None for b in best), least


@lru_cache(maxsize=1 << 16)
def _backward(vector: tuple, element) -> tuple:
    """Cost (above the least) from each state before an element to the end."""
    ways = _table(element)
    best = []
    for p in range(4):
        found = [ways[p][q][0] + v for q, v in enumerate(vector) if v is not None and ways[p][q]]
        best.append(min(found) if found else None)
    least = min(b for b in best if b is not None)
    return tuple(None if b is None else b - least for b in best)


def _unit(state: int, value) -> tuple:
    return tuple(value if s == state else None for s in range(4))


def between(elements: str | list, start: int) -> tuple:
    """Cost and order of audit from ``start`` to each state over all elements."""
    vector, base = _unit(start, (0, 0)), 0
    for e in elements:
        vector, rise = _forward(vector, e)
        base += rise
    return tuple((v[0] + base, v[1]) if v else None for v in vector)


def crossings(elements: str | list, start: int, end: int) -> list[int]:
    """The states before, between and after the elements on the best way."""
    states = [start] * len(elements) + [end]
    todo = [(0, len(elements), start, end)]
    while todo:
        low, high, a, b = todo.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        ahead, back = _unit(a, (0, 0)), _unit(b, 0)
        for i in range(low, middle):
            ahead = _forward(ahead, elements[i])[0]
        for i in range(high - 1, middle - 1, -1):
            back = _backward(back, elements[i])
        s = min((f[0] + g, f[1], s) for s, (f, g) in enumerate(zip(ahead, back))
                if f and g is not None)[2]
        states[middle] = s
        todo += [(low, middle, a, s), (middle, high, s, b)]
    return states


def letters(kinds: str, start: int, end: int) -> list[str]:
    """The edits of a stretch of rows: for each row its letter, after those inserted."""
    states = crossings(kinds, start, end)
    return [_ROWS[k][p][q][1] for k, p, q in zip(kinds, states, states[1:])]


def finish(ways: tuple) -> tuple[int, int, int]:
    """Cost, last state and turns inserted at the end, from the ways out of the start."""
    cost, _, state = min((w[0] + INSERT * _TAIL[s], w[1], s) for s, w in enumerate(ways) if w)
    return cost, state, _TAIL[state]


def _bytes(table: tuple) -> bytes:
    """A stretch's table as 32 numbers: cost (-1: no way) and order of each way."""
    return np.array([w or (-1, -1) for row in table for w in row], np.int64).tobytes()


@lru_cache(maxsize=1 << 12)
def _unbytes(data: bytes) -> tuple:
    pairs = [tuple(x) if x[0] >= 0 else None for x in np.frombuffer(data, np.int64).reshape(-1, 2).tolist()]
    return tuple(tuple(pairs[i : i + 4]) for i in range(0, 16, 4))


def in_order(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, digest, at: a number that rises in the order of the rows
    and without gaps within a conversation and task."""
    rows = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    rows = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")})
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    # Rows equal in all columns are dealt to several tasks as well.
    rows = rows.withColumn("deal", F.pmod(F.monotonically_increasing_id(), F.lit(1024)))
    order = ["conv_id", "turn", "role", "digest", "deal"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("deal")
    return materialize(rows.withColumn("at", F.monotonically_increasing_id()), "turns")


def _kind(role: Column, text: Column) -> Column:
    said = F.rtrim(text, F.lit(SPACE))
    first = F.substring(role, 1, 1)
    kept = F.when(first.isin("s", "u", "a"), first).otherwise("o")
    ended = F.right(said, F.lit(1)).isin(*ENDS)
    return F.when(said == "", "d").when(ended, kept).otherwise(F.upper(kept))


_STRETCHES = ("conv_id long, at long, kinds string, table binary, first string, last string, "
              "blank long, duplicate long, truncated long, illegal long")
_LEGAL = {"su", "ua", "au"}


def _cut(batches: Batches) -> Batches:
    """Stretches from their cells: rows (at, kind, initial), and before a row one of null
    kind if its role and text are the first such."""
    for batch in batches:
        cells = batch.column("cells")
        flat = cells.flatten()
        edges = np.concatenate([[0], np.cumsum(np.diff(cells.offsets.to_numpy()))]).tolist()
        at, kind, initial = (flat.field(i).to_pylist() for i in range(3))
        out = []
        for a, b in zip(edges, edges[1:]):
            kinds, roles, blank, twice, cut, new = [], [], 0, 0, 0, False
            for k, r in zip(kind[a:b], initial[a:b]):
                if k is None:
                    new = True
                    continue
                roles.append(r)
                if k == "d":
                    blank += 1
                elif not new:
                    k, twice = "d", twice + 1
                else:
                    cut += k.isupper()
                kinds.append(k)
                new = False
            wrong = sum(x + y not in _LEGAL for x, y in zip(roles, roles[1:]))
            line = "".join(kinds)
            table = tuple(between(line, s) for s in range(4))
            out.append((at[a], line, _bytes(table), roles[0], roles[-1], blank, twice, cut, wrong))
        columns = zip(zip(*out), (pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string(),
                                  *[pa.int64()] * 4))
        names = [c.split()[0] for c in _STRETCHES.split(", ")]
        if out:
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *[pa.array(c, k) for c, k in columns]], names)


def stretches(rows: DataFrame) -> DataFrame:
    """The conversations of ``in_order`` in stretches: their rows' kinds, the table of ways
    through them, and their faults."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    slim = rows.select("conv_id", "at", _kind(F.col("role"), F.col("text")).alias("kind"),
                       F.substring("role", 1, 1).alias("initial"), "role", "digest")
    first = slim.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at"))
    none = F.lit(None).cast("string")
    cells = slim.select("conv_id", "at", "kind", "initial").unionByName(
        first.select("conv_id", "at", none.alias("kind"), none.alias("initial")))
    cells = cells.groupBy("conv_id", F.shiftright("at", STRETCH).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("at", "kind", "initial"))).alias("cells"))
    return materialize(in_arrow(cells.select("conv_id", "cells"), lambda: _cut,
                                _STRETCHES.replace("conv_id long", f"conv_id {conv}")), "stretches")


_NODE = ("at", "table", "first", "last", "illegal")


def _together(nodes: DataFrame, shift: int | None) -> DataFrame:
    """Groups of neighbouring nodes of a conversation; ``shift`` None: all."""
    part = F.lit(0).cast("long") if shift is None else F.shiftright("at", shift)
    return nodes.groupBy("conv_id", part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct(*_NODE))).alias("below"),
        F.min("at").alias("at")).drop("part")


def _illegal(below: list[dict]) -> int:
    """Illegal pairs inside the nodes and where they meet."""
    return sum(x["illegal"] for x in below) + sum(
        x["last"] + y["first"] not in _LEGAL for x, y in zip(below, below[1:]))


def _joined(batches: Batches) -> Batches:
    for batch in batches:
        nodes = []
        for below in batch.column("below").to_pylist():
            elements = [_unbytes(x["table"]) for x in below]
            table = _bytes(tuple(between(elements, s) for s in range(4)))
            nodes.append((table, below[0]["first"], below[-1]["last"], _illegal(below)))
        kinds = (pa.binary(), pa.string(), pa.string(), pa.int64())
        if nodes:
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("at"),
                 *[pa.array(c, k) for c, k in zip(zip(*nodes), kinds)]], ["conv_id", *_NODE])


_PATHS = "array<struct<at: long, enter: int, leave: int, tail: int>>"
_PATH_TYPE = pa.list_(pa.struct([("at", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32()),
                                 ("tail", pa.int32())]))


def _ways(below: list[dict], enter: int, leave: int, tail: int) -> list[dict]:
    elements = [_unbytes(x["table"]) for x in below]
    states = crossings(elements, enter, leave)
    return [{"at": x["at"], "enter": p, "leave": q, "tail": tail if x is below[-1] else 0}
            for x, p, q in zip(below, states, states[1:])]


def _settled(batches: Batches) -> Batches:
    """Illegal pairs and cost of each conversation and the ways through its top's nodes."""
    for batch in batches:
        costs, paths, illegal = [], [], []
        for below in batch.column("below").to_pylist():
            cost, leave, tail = finish(between([_unbytes(x["table"]) for x in below], EMPTY))
            costs.append(cost)
            paths.append(_ways(below, EMPTY, leave, tail))
            illegal.append(_illegal(below))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()),
             pa.array(paths, _PATH_TYPE)], ["conv_id", "illegal", "cost", "paths"])


def _passed(batches: Batches) -> Batches:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("below", "enter", "leave", "tail"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([_ways(*x) for x in zip(*columns)], _PATH_TYPE)], ["paths"])


def solved(parts: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(conv_id, illegal, cost) of each conversation and (at, enter, leave, tail) of each
    stretch."""
    conv = parts.schema["conv_id"].dataType.simpleString()
    nodes, shift, levels = parts.select("conv_id", *_NODE), STRETCH, []
    while True:
        # A conversation of more nodes than meet at once: neighbours first.
        most = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
        if most <= fan or shift >= 63:
            break
        shift += fan.bit_length() - 1
        groups = materialize(_together(nodes, shift), "stretch-groups")
        levels.append(groups)
        nodes = materialize(in_arrow(
            groups, lambda: _joined,
            f"conv_id {conv}, at long, table binary, first string, last string, illegal long"), "stretch-tables")
    top = materialize(in_arrow(_together(nodes, None), lambda: _settled,
                               f"conv_id {conv}, illegal long, cost long, paths {_PATHS}"), "settled")
    paths = top.select(F.inline("paths"))
    for groups in reversed(levels):
        held = groups.select("at", "below").join(paths, "at")
        paths = materialize(in_arrow(held, lambda: _passed, f"paths {_PATHS}"), "paths").select(
            F.inline("paths"))
    return top.select("conv_id", "illegal", "cost"), paths


_EDITS = "conv_id long, at long, step int, edit string, new_role string"


def _edited(batches: Batches) -> Batches:
    for batch in batches:
        rows: list[tuple] = []
        for conv, at, kinds, enter, leave, tail in zip(*(batch.column(c).to_pylist() for c in (
                "conv_id", "at", "kinds", "enter", "leave", "tail"))):
            state = enter
            for i, way in enumerate([*letters(kinds, enter, leave), "I" * tail]):
                # What is inserted at the end follows the last row.
                place, first = (at + i, 0) if i < len(kinds) else (at + i - 1, 8)
                for step, letter in enumerate(way, first):
                    role = None
                    if letter == "K":
                        state = _FOLLOWS[kinds[i].lower()][state]
                    elif letter in "RI":
                        state = ASSISTANT if state == USER else USER
                        role = "assistant" if state == ASSISTANT else "user"
                    rows.append((conv, place, step, letter, role))
        columns = zip(zip(*rows), (batch.schema.field("conv_id").type, pa.int64(), pa.int32(),
                                   pa.string(), pa.string()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns],
                                             [c.split()[0] for c in _EDITS.split(", ")])


def edits(parts: DataFrame, paths: DataFrame) -> DataFrame:
    """conv_id, at, step, edit and new role: the audit's letters in order; an inserted turn
    has the ``at`` of the row it stands before (at the end: after), and a step of its own."""
    conv = parts.schema["conv_id"].dataType.simpleString()
    return in_arrow(parts.select("conv_id", "at", "kinds").join(paths, "at"), lambda: _edited,
                    _EDITS.replace("conv_id long", f"conv_id {conv}"))


@dataclass
class Repair:
    """``rows``: conv_id, at, step, edit, role, text of every edit (deleted rows too), in the
    order of (at, step); ``faults``: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost."""

    rows: DataFrame
    faults: DataFrame


FAULTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repaired(turns: DataFrame, fan: int = FAN, **columns: str) -> Repair:
    """The cheapest repair of each conversation of ``turns``; ``columns``: conv_col,
    turn_col, role_col, text_col."""
    rows = in_order(turns, **columns)
    parts = stretches(rows)
    costs, paths = solved(parts, fan)
    found = edits(parts, paths).join(
        rows.select(F.col("at").alias("row_at"), F.col("role").alias("old_role"), "text"),
        (F.col("at") == F.col("row_at")) & (F.col("edit") != "I"), "left")
    done = found.select("conv_id", "at", "step", "edit", F.coalesce("new_role", "old_role").alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    gaps = rows.groupBy("conv_id", "turn").agg(F.count("*")).groupBy("conv_id").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    every = [gaps, parts.select("conv_id", "blank", "duplicate", "truncated"), costs]
    return Repair(done, summed([x.select("conv_id", *[
        F.col(f) if f in x.columns else F.lit(0).cast("long").alias(f) for f in FAULTS])
        for x in every]))


def summed(parts: list[DataFrame]) -> DataFrame:
    """Numbers of faults by conversation, from several tables of them."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("conv_id").agg(*[F.sum(f).alias(f) for f in FAULTS])


_TOLD = "conv_id long, audit string, repaired_sha256 string"


def _read_out(batches: Batches) -> Batches:
    """Audit and digest of each conversation, from its lines in order."""
    conv, audit, digest, any_row, any_line = None, bytearray(), None, False, False

    for batch in batches:
        done: list[tuple] = []
        for c, letter, line in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "edit", "line"))):
            if not any_row or c != conv:
                if any_row:
                    done.append((conv, audit.decode(), digest.hexdigest()))
                conv, audit, digest, any_row, any_line = c, bytearray(), hashlib.sha256(), True, False
            audit += letter.encode()
            if line is not None:
                digest.update(b"\n" + line.encode() if any_line else line.encode())
                any_line = True
        yield _told(done, batch.schema.field("conv_id").type)
    if any_row:
        yield _told([(conv, audit.decode(), digest.hexdigest())], batch.schema.field("conv_id").type)


def _told(rows: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, (conv, pa.string(), pa.string()))],
        [c.split()[0] for c in _TOLD.split(", ")])


def told(rows: DataFrame) -> DataFrame:
    """conv_id, audit and SHA-256 of the repaired ``role:text`` lines of each conversation.

    A digest needs the lines of a conversation one after the other; they stream through a
    task in their order, of which it holds a batch and one letter per edit.
    """
    conv = rows.schema["conv_id"].dataType.simpleString()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = rows.select("conv_id", "at", "step", "edit", F.when(
        F.col("edit") != "D", F.concat("role", F.lit(":"), "text")).alias("line"))
    lines = lines.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "at", "step")
    return in_arrow(lines.select("conv_id", "edit", "line"), lambda: _read_out,
                    _TOLD.replace("conv_id long", f"conv_id {conv}"))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults by the checksum of ``conv_id:turn``, modulo 20:
    0 drops the row, 1 empties its text, 2 removes the marks that end sentences, 3 repeats
    it, 4 makes it the user's.  Nulls are one space, in the checksum as well."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(named.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), space) for c in ("text", "role"))
    rows = turns.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text",
                       F.explode(F.sequence(F.lit(1), "times"))).drop("col")
