"""Repair of conversation structure at least cost, by tables over blocks of symbols (four Russians).

A conversation is a string of symbols (role, fault).  What it costs to finish from each of the four states
of the role pattern is a vector; less its minimum it is one of a few dozen, whatever the conversation.  So for
every such vector and every block of four symbols the vector before the block is worked out once.  A
conversation is then read block by block from its end; each block is expanded from the vector behind it, and
edits are chosen forwards, so of all cheapest edits the first in ASCII order comes out.

Rows are put in order once by range partitioning, which gives each a position.  Pieces of 4096 positions
are read on their own: a piece maps the vector behind it to the one before it, and then the state before it
to the one behind.  Only these maps, one for 4096 rows, are strung together in one task, and as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import Scratch

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLOCK = 4
PIECE_BITS = 12
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
# States: what stands last.  The pattern is (s?(ua)+)?, so after a user an assistant follows, else a user.
_AFTER = (USER, USER, ASSISTANT, USER)
_KEEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
# Symbols: role (s, u, a or other) and whether it is truncated; the last one has to be deleted.
FORCED = 8
_INFINITE = 1 << 20


class Step(NamedTuple):
    """What happens at a row: its letters, the roles inserted before it, its new role, the next state."""

    edit: str
    before: str
    role: str | None
    state: int


def _with_inserts(g: list[int]) -> list[int]:
    """Costs when rows may be inserted first."""
    user, assistant = min(g[USER], INSERT + g[ASSISTANT]), min(g[ASSISTANT], INSERT + g[USER])
    return [min(g[NOTHING], INSERT + user), min(g[SYSTEM], INSERT + user), user, assistant]


def _options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row, in ASCII order."""
    found = [("D", DELETE, state)]
    if symbol != FORCED:
        late = TRUNCATED * (symbol % 2)
        kept = _KEEPS.get((state, (INITIALS + "x")[symbol // 2]))
        found += [("K", late, kept)] if kept is not None else []
        found += [("R", late + REROLE, _AFTER[state])]
    return found


class Tables(NamedTuple):
    """Vectors by number, the number before each symbol and block, and the step at each symbol and state."""

    vectors: list[tuple[int, ...]]
    before: list[list[int]]
    blocks: np.ndarray
    steps: list[list[list[Step]]]


END = 0


@cache
def tables() -> Tables:
    """Made from the rules above; vector 0 is that of the end."""
    end = tuple(_with_inserts([0, _INFINITE, _INFINITE, 0]))
    number, vectors = {end: END}, [end]
    before: list[list[int]] = [[] for _ in range(FORCED + 1)]
    steps: list[list[list[Step]]] = [[] for _ in range(FORCED + 1)]
    for vector in vectors:
        for symbol in range(FORCED + 1):
            own = [min(cost + vector[to] for _, cost, to in _options(symbol, q)) for q in range(4)]
            costs = _with_inserts(own)
            steps[symbol].append([_step(symbol, q, vector, costs) for q in range(4)])
            plain = tuple(c - min(costs) for c in costs)
            if plain not in number:
                number[plain] = len(vectors)
                vectors.append(plain)
            before[symbol].append(number[plain])
    single = np.array(before)
    blocks = np.empty(((FORCED + 1) ** BLOCK, len(vectors)), np.int64)
    for code, symbols in enumerate(product(range(FORCED + 1), repeat=BLOCK)):
        row = np.arange(len(vectors))
        for symbol in reversed(symbols):
            row = single[symbol][row]
        blocks[code] = row
    return Tables(vectors, before, blocks, steps)


def _step(symbol: int, state: int, vector: tuple[int, ...], costs: list[int]) -> Step:
    """The least letter at each choice that still leads to the least cost."""
    edit = before = ""
    while True:
        options = {letter: to for letter, cost, to in _options(symbol, state) if cost + vector[to] == costs[state]}
        if "D" in options:
            return Step(edit + "D", before, None, state)
        if INSERT + costs[_AFTER[state]] == costs[state]:
            state = _AFTER[state]
            edit, before = edit + "I", before + INITIALS[state - 1]
        elif "K" in options:
            return Step(edit + "K", before, None, options["K"])
        else:
            return Step(edit + "R", before, _NAMES[options["R"]], options["R"])


def _codes(symbols: np.ndarray) -> tuple[int, list[int]]:
    """How many symbols stand before the first whole block, and the blocks' numbers."""
    front = len(symbols) % BLOCK
    return front, (symbols[front:].reshape(-1, BLOCK) @ (FORCED + 1) ** np.arange(BLOCK - 1, -1, -1)).tolist()


def vector_map(symbols: np.ndarray) -> np.ndarray:
    """For each vector behind the symbols the one before them."""
    t = tables()
    front, codes = _codes(symbols)
    row = np.arange(len(t.vectors))
    for code in reversed(codes):
        row = t.blocks[code][row]
    for symbol in reversed(symbols[:front].tolist()):
        row = np.array(t.before[symbol])[row]
    return row


def behind(symbols: np.ndarray, end: int = END) -> list[int]:
    """The vector behind each symbol: by lookup from block to block, then inside each block."""
    t = tables()
    front, codes = _codes(symbols)
    bounds = [end]
    for code in reversed(codes):
        bounds.append(int(t.blocks[code, bounds[-1]]))
    out: list[int] = []
    values = symbols.tolist()
    pieces = [values[:front], *[values[i : i + BLOCK] for i in range(front, len(values), BLOCK)]]
    for piece, vector in zip(pieces, reversed(bounds), strict=True):
        inside = [vector]
        for symbol in reversed(piece[1:]):
            inside.append(t.before[symbol][inside[-1]])
        out += reversed(inside[: len(piece)])
    return out


def trace(symbols: np.ndarray, end: int = END, state: int = NOTHING) -> list[Step]:
    """The cheapest edits in order, the ASCII-least of them."""
    steps, out = tables().steps, []
    for symbol, vector in zip(symbols.tolist(), behind(symbols, end), strict=True):
        out.append(steps[symbol][vector][state])
        state = out[-1].state
    return out


def closing(state: int) -> str:
    """Initials of the rows to insert at the end."""
    return {NOTHING: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}[state]


def _vector_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [vector_map(np.array(s, np.int64)).tolist() for s in batch.column("symbols").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("piece"), pa.array(maps, pa.list_(pa.int32()))], ["conv", "piece", "map"]
        )


def _state_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = tables().steps
    for batch in batches:
        maps = []
        for symbols, end in zip(batch.column("symbols").to_pylist(), batch.column("end").to_pylist(), strict=True):
            states = list(range(4))
            for symbol, vector in zip(symbols, behind(np.array(symbols, np.int64), end), strict=True):
                states = [steps[symbol][vector][q].state for q in states]
            maps.append(states)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("piece"), pa.array(maps, pa.list_(pa.int32()))], ["conv", "piece", "map"]
        )


def _carried(start: int):
    """Pieces in order: the value before each, which its map turns into the value before the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, value, fresh = None, start, True
        for batch in batches:
            out = []
            for own, step in zip(batch.column("conv").to_pylist(), batch.column("map").to_pylist(), strict=True):
                if fresh or own != conv:
                    conv, value, fresh = own, start, False
                out.append(value)
                value = step[value]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("piece"), pa.array(out, pa.int32())], ["conv", "piece", "value"]
            )

    return run


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for places, symbols, end, state, last in zip(*[batch.column(k).to_pylist() for k in ("places", "symbols", "end", "start", "last")], strict=True):
            steps = trace(np.array(symbols, np.int64), end, state)
            tail = closing(steps[-1].state) if last else ""
            rows += [(p, s.edit, s.before, s.role, "") for p, s in zip(places, steps, strict=True)]
            rows[-1] = (*rows[-1][:1], steps[-1].edit + "I" * len(tail), *rows[-1][2:4], tail)
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), *[pa.string()] * 4)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["pos", "edit", "before", "new_role", "after"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: audit, pairs of roles that must not meet, and the hash of the repaired lines."""
    names = {"u": "user:", "a": "assistant:"}
    conv, held, closed = None, None, []

    def close() -> None:
        if held is not None:
            closed.append((conv, "".join(held[0]), held[1].hexdigest(), held[2]))

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in ("conv", "role", "text", "edit", "before", "new_role", "after")]
        for own, role, text, edit, before, new_role, after in zip(*columns, strict=True):
            if held is None or own != conv:
                close()
                conv, held = own, [[], hashlib.sha256(), 0, None, True]
            initial = role[:1]
            held[2] += held[3] is not None and held[3] + initial not in ("su", "ua", "au")
            held[3] = initial
            held[0].append(edit)
            lines = [names[x] for x in before]
            if "D" not in edit:
                lines.append(f"{role if new_role is None else new_role}:{text}")
            lines += [names[x] for x in after]
            if lines:
                held[1].update(("" if held[4] else "\n").encode() + "\n".join(lines).encode())
                held[4] = False
        if closed:
            yield _digest_batch(closed, batch.column("conv").type)
            closed.clear()
    close()
    if closed:
        yield _digest_batch(closed, batch.column("conv").type)


def _digest_batch(closed: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (kind, pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*closed, strict=True), kinds, strict=True)], ["conv", "audit", "repaired_sha256", "illegal"]
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def damage(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text, copy)``: rows with faults dealt by the CRC of their key; nulls read as a space.

    Of 20 values 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it a user's.
    """
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(read(conv), F.lit(":"), read(turn)).cast("binary")) % 20
    words = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(read(text), "[.!?]", "")).otherwise(read(text))
    who = F.when(fault == 4, F.lit("user")).otherwise(read(role))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter(fault != 0).select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), who.alias("role"), words.alias("text"), F.explode(copies).alias("copy")
    )


def _faults(ordered: DataFrame) -> DataFrame:
    """``(conv, pos, fault, symbol)``: each row's first fault, and its symbol in the tables."""
    narrow = ordered.select("conv", "pos", "role", "t1", "t2", "blank", "cut")
    first = narrow.groupBy("conv", "role", "t1", "t2").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select(*[F.col(c).alias(f"f_{c}") for c in ("conv", "role", "t1", "t2")], "first")
    same = _same("conv", "f_conv") & (F.col("role") == F.col("f_role")) & (F.col("t1") == F.col("f_t1")) & (F.col("t2") == F.col("f_t2"))
    again = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), F.lit("blank")).when(again, F.lit("duplicate")).when(F.col("cut"), F.lit("truncated"))
    place = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    who = F.when((F.length("role") > 0) & (place > 0), place - 1).otherwise(len(INITIALS))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), FORCED).otherwise(2 * who + F.coalesce(F.col("fault") == "truncated", F.lit(False)).cast("int"))
    flagged = narrow.join(first, same, "left").select("conv", "pos", "role", fault.alias("fault"))
    return flagged.select("conv", "pos", "fault", symbol.cast("int").alias("symbol"))


def repair(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """``(conv, pos, role, text, fault, edit, before, new_role, after)``: every row of ``(conv, turn, role, text, copy)``.

    ``edit`` has the letters of the edits at this row (Keep, Rerole, Delete, Insert), ``before`` and ``after``
    the initials of the rows to insert around it.  Rows follow their turn, nulls first; rows of one turn follow
    role and text by code point.
    """
    visible, complete = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
    order = ["conv", "turn", "role", "text", "copy"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.monotonically_increasing_id().alias("pos"), "conv", "turn", "role", "text",
        F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("2"), "text").alias("t2"),
        (~F.rlike("text", F.lit(visible))).alias("blank"), (~F.rlike("text", F.lit(complete))).alias("cut"),
    )
    ordered = scratch.save(ordered, "ordered")
    flagged = scratch.save(_faults(ordered), "flagged")
    piece = F.shiftright("pos", PIECE_BITS)
    pieces = flagged.groupBy("conv", piece.alias("piece")).agg(F.sort_array(F.collect_list(F.struct("pos", "symbol"))).alias("rows"))
    pieces = scratch.save(pieces.select("conv", "piece", F.col("rows.pos").alias("places"), F.col("rows.symbol").alias("symbols")), "pieces")

    kind = pieces.schema["conv"].dataType.simpleString()
    counted = pieces.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.max("piece").alias("latest"))
    several = scratch.save(counted.filter("n > 1").select(F.col("conv").alias("s_conv"), "latest"), "several")
    long = pieces.join(several, _same("conv", "s_conv")).drop("s_conv")
    whole = pieces.join(several, _same("conv", "s_conv"), "left_anti")
    shape = f"conv {kind}, piece long, map array<int>"

    def carried(maps: DataFrame, start: int, piece_order: Column, name: str) -> DataFrame:
        lined = maps.repartition("conv").sortWithinPartitions("conv", piece_order)
        values = lined.mapInArrow(_carried(start), f"conv {kind}, piece long, value int")
        return scratch.save(values.select(F.col("piece").alias(f"{name}_piece"), F.col("conv").alias(f"{name}_conv"), F.col("value").alias(name)), name)

    def known(frame: DataFrame, values: DataFrame, name: str) -> DataFrame:
        met = _same("conv", f"{name}_conv") & (F.col("piece") == F.col(f"{name}_piece"))
        return frame.join(values, met).drop(f"{name}_conv", f"{name}_piece")

    ends = carried(long.select("conv", "piece", "symbols").mapInArrow(_vector_maps, shape), END, F.desc("piece"), "end")
    long = known(long, ends, "end")
    starts = carried(long.select("conv", "piece", "symbols", "end").mapInArrow(_state_maps, shape), NOTHING, F.asc("piece"), "start")
    long = known(long, starts, "start").withColumn("last", F.col("piece") == F.col("latest"))
    whole = whole.withColumns({"end": F.lit(END), "start": F.lit(NOTHING), "last": F.lit(True)})
    columns = ["places", "symbols", "end", "start", "last"]
    edits = whole.select(*columns).union(long.select(*columns)).mapInArrow(
        _traced, "pos long, edit string, before string, new_role string, after string"
    )
    edits = scratch.save(edits, "edits")
    scratch.drop("pieces", "several", "end", "start")
    return ordered.select("conv", "pos", "turn", "role", "text").join(flagged.select("pos", "fault"), "pos").join(edits, "pos")


def audit(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of ``rows``: faults, least cost of repair, its edits and the repaired text's hash.

    Columns: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.  A null conversation is one
    of its own, a null turn comes first and is no gap, and null roles and texts read as a space.  Repeated rows are
    duplicates.  A conversation without rows has zeros, no edits and the hash of nothing; an empty table stays
    empty; other columns don't matter.  A hash is read in order, so this last step streams each
    conversation through one task; long conversations and texts are never held whole.
    """
    scratch = Scratch(rows.sparkSession)
    repaired = scratch.save(repair(scratch, damage(rows, conv=conv, turn=turn, role=role, text=text)), "repaired")
    scratch.drop("ordered", "flagged", "edits")
    kind = repaired.schema["conv"].dataType.simpleString()
    late = F.when((F.col("fault") == "truncated") & ~F.contains("edit", F.lit("D")), TRUNCATED).otherwise(0)
    letters = lambda x: F.length("edit") - F.length(F.replace("edit", F.lit(x), F.lit("")))
    cost = late + DELETE * letters("D") + INSERT * letters("I") + REROLE * letters("R")
    counts = repaired.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")], F.sum(cost).alias("cost"),
    )
    lines = repaired.select("conv", "pos", "role", "text", "edit", "before", "new_role", "after")
    digests = lines.repartition("conv").sortWithinPartitions("conv", "pos").mapInArrow(
        _digests, f"conv {kind}, audit string, repaired_sha256 string, illegal long"
    )
    every = rows.select(F.col(conv)).distinct()
    counts, digests = counts.withColumnRenamed("conv", "c_conv"), digests.withColumnRenamed("conv", "d_conv")
    met = every.join(counts, _same(conv, "c_conv"), "left").join(digests, _same(conv, "d_conv"), "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return met.select(
        F.col(conv), *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
