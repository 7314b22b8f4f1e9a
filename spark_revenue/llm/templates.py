"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders, so a question with other numbers or names keeps its
template.  Values of several words are one placeholder, and capitalised words are read in three ways: as words,
so that copies in other letter case match, as names inside a sentence, and as names anywhere.  Windows of eight template tokens are hash-joined between texts and benchmark items.  Where
windows match, a value of the item has to stand for the same value wherever it recurs.  Windows that agree
mark the text, with the same values or not; where one clashes, the runs before and after it are judged alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels
from .shared import Scratch, hash_filter, without

WIDTH = 8
# Windows with fewer literal words than this say too little.
LEAST_LITERALS = 4
# Matching windows in one alignment that mark a text: a run of thirteen words.
LEAST_RUN = 6
# The same beside a clash, where the text may hold another question: a run of seventeen words.
CLASHING_RUN = 10
# Bits of the filter that windows pass before the join: 2 MB whatever the size of the benchmark.
FILTER_BITS = 24
# Unit words.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons tonne tonnes ounce ounces pound pounds "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
    "months year years percent dollar dollars euro euros cent cents degree degrees celsius fahrenheit kmh mph watt watts "
    "volt volts joule joules newton newtons hz khz mhz ghz byte bytes kb mb gb tb"
).split()
_U = np.uint64
# Kinds of bytes: 0 for everything in ASCII but letters and digits, which separates; 1 letters; 2 digits.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
KINDS[0x30:0x3A] = 2
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?:;\n\"")] = True
_POINTS = np.zeros(256, bool)
_POINTS[list(b".,")] = True
_JOINS = np.zeros(256, bool)
_JOINS[list(b" -'")] = True
NUMBER, NAME, UNIT = (_U(x) for x in (0xA5A5_0001, 0xA5A5_0002, 0xA5A5_0003))
# How capitalised words are read: never as names, as names inside a sentence, as names everywhere.
PLAIN, INSIDE, ANYWHERE = range(3)
# No reading but whole items; the number of words in a run is added.
WHOLE = 3


class Tokens(NamedTuple):
    literal: np.ndarray   # hash of the words
    template: np.ndarray  # the same, or a placeholder
    filled: np.ndarray    # whether it is a placeholder
    rows: np.ndarray      # first token of each row


def _hash_of(texts: list[str]) -> np.ndarray:
    data, starts = kernels.column_bytes(pa.array(texts))
    return words(data, starts)[0]


def _joined(literal: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of runs of words; ``first`` marks the first of each."""
    heads = np.flatnonzero(first)
    place = np.arange(len(literal)) - np.repeat(heads, np.diff(np.append(heads, len(literal))))
    up, _ = kernels.powers(int(place.max()) + 1)
    return np.add.reduceat(literal * up[place], heads)


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, numbers being words of their own, and each row's first."""
    return kernels.word_hashes(data, starts, kinds=KINDS)


def readings(data: np.ndarray, starts: np.ndarray) -> list[Tokens]:
    """The tokens of the rows that ``starts`` delimits, in each reading of capitalised words.

    A number is digits, with points or commas between them.  A unit is one of ``UNITS`` after a number, be it
    glued.  A name is a run of capitalised words; a sentence begins a new one.
    """
    literal, rows = words(data, starts)
    if not len(literal):
        none = np.zeros(0, bool)
        return [Tokens(literal, literal, none, rows)] * 3
    piece = data[starts[0] : starts[-1]]
    kind = KINDS[piece]
    change = np.concatenate([[True], kind[1:] != kind[:-1]])
    bounds = starts - starts[0]
    change[bounds[bounds < len(piece)]] = True
    begin = np.flatnonzero(change & (kind > 0))
    end = np.flatnonzero((kind > 0) & np.concatenate([change[1:], [True]])) + 1
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))

    def after(flags: np.ndarray) -> np.ndarray:
        """Whether the word before has the flag."""
        return np.concatenate([[False], flags[:-1]])

    def before(flags: np.ndarray) -> np.ndarray:
        return np.concatenate([flags[1:], [False]])

    same = np.concatenate([[False], row[1:] == row[:-1]])
    gap = np.concatenate([[0], begin[1:] - end[:-1]])
    digits = kind[begin] == 2
    glued = same & (gap == 0)
    opens, closes = ~glued, ~before(glued)
    unit = glued & after(digits & opens) & closes & np.isin(literal, _hash_of(UNITS))
    number = digits & opens & (closes | before(unit))
    point = same & (gap == 1) & _POINTS[piece[begin - 1]] & after(number & closes) & number
    first = ~((glued & ~unit) | point)

    # From here on by token; only names may join some.
    heads = np.flatnonzero(first)
    last = np.append(heads[1:], len(literal)) - 1
    literal, row, number, same, gap = _joined(literal, first), row[heads], number[heads], same[heads], gap[heads]
    start, previous = begin[heads], np.concatenate([[0], end[last[:-1]]])
    unit = same & after(number) & np.isin(literal, _hash_of(UNITS))
    # A capital is A-Z or one of the Latin capitals that UTF-8 puts after byte C3.
    head, second = piece[start], piece[np.minimum(start + 1, len(piece) - 1)]
    capital = ((head >= 0x41) & (head <= 0x5A)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    stops = np.concatenate([[0], np.cumsum(_STOPS[piece])])
    initial = ~same | (stops[start] != stops[previous])
    linked = ~initial & (gap == 1) & _JOINS[piece[start - 1]]
    told = []
    for name in (np.zeros(len(capital), bool), capital & ~initial, capital):
        first = ~(linked & name & after(name))
        filled = number | name | unit
        template = np.where(number, NUMBER, np.where(name, NAME, np.where(unit, UNIT, literal)))
        own = np.searchsorted(row[first], np.arange(len(rows)))
        told.append(Tokens(_joined(literal, first), template[first], filled[first], own))
    return told


def windows(read: Tokens, reading: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first token, row) of all windows with enough literal words."""
    n = len(read.template) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(read.rows) - 1), np.diff(read.rows))
    own = np.concatenate([[0], np.cumsum(~read.filled)])
    begin = np.flatnonzero((row[:n] == row[WIDTH - 1 :]) & (own[WIDTH:] - own[:-WIDTH] >= LEAST_LITERALS))
    total = np.full(len(begin), reading, _U)
    for k in range(WIDTH):
        total = total * _U(kernels.BASE) + read.template[begin + k]
    return kernels.mix(total), begin, row[begin]


def _slots(read: Tokens, begin: np.ndarray) -> list[list[int]]:
    """The values in the placeholders of each window, as the hashes of their words."""
    span = begin[:, None] + np.arange(WIDTH)[None, :]
    values, filled = read.literal[span].view(np.int64), read.filled[span]
    return [v[f].tolist() for v, f in zip(values, filled, strict=True)]


def wholes(literal: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word, row) of all runs of ``width`` words, a power of two."""
    n = len(literal) - width + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, _ = kernels.powers(width + 1)
    total, half = literal, 1
    while half < width:
        total, half = total[:-half] + total[half:] * up[half], half * 2
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    begin = np.flatnonzero(row[:n] == row[width - 1 :])
    return kernels.mix(total[begin] + _U(WHOLE + width)), begin, row[begin]


def _hits(hashes: np.ndarray, at: np.ndarray, reading: int, slots: list[list[int]]) -> list[dict]:
    return [
        {"hash": h, "reading": reading, "at": a, "slots": s}
        for h, a, s in zip(hashes.view(np.int64).tolist(), at.tolist(), slots, strict=True)
    ]


def _with_hits(batch: pa.RecordBatch, hits: list[list[dict]], kind: pa.DataType) -> pa.RecordBatch:
    rest = [c for c in batch.schema.names if c != "__text"]
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(hits, kind)], [*rest, "__hits"])


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What has to match of every item: its windows, or where they say too little, the whole item.

    ``need`` is how many: ``LEAST_RUN``, or all of an item that is too short for that.  A whole item is given
    by the two runs of words, as long as the largest power of two within it, that begin and end it.
    """
    for batch in batches:
        hits: list[list[dict]] = []
        data, starts = kernels.column_bytes(batch.column("__text"))
        for i in range(batch.num_rows):
            hits.append([])
            for reading, read in enumerate(readings(data, starts[i : i + 2])):
                hashes, begin, _ = windows(read, reading)
                n = len(begin)
                if n >= LEAST_RUN or (n and len(read.literal) < WIDTH + LEAST_RUN - 1):
                    found = _hits(hashes, begin, reading, _slots(read, begin))
                    hits[-1] += [h | {"need": min(n, LEAST_RUN), "nth": k} for k, h in enumerate(found)]
                elif reading == PLAIN and len(read.literal):
                    literal, rows = words(data, starts[i : i + 2])
                    width = 1 << (len(literal).bit_length() - 1)
                    hashes, begin, _ = wholes(literal, rows, width)
                    ends = sorted({0, len(literal) - width})
                    found = _hits(hashes[ends], begin[ends], WHOLE + width, [[]] * len(ends))
                    hits[-1] += [h | {"need": len(ends), "nth": k} for k, h in enumerate(found)]
        yield _with_hits(batch, hits, pa.list_(pa.struct([*_HIT, ("need", pa.int32()), ("nth", pa.int32())])))


def _emit(passes, widths: list[int], text: str = "__text"):
    """Windows, and runs of ``widths`` words, of every row that pass the filter, beside the row's own columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = np.frombuffer(passes.value, np.uint8)

        def passing(hashes: np.ndarray, begin: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
            bit = hashes >> _U(64 - FILTER_BITS)
            passed = (allowed[(bit >> _U(3)).astype(np.int64)] >> (bit & _U(7)).astype(np.uint8)) & 1
            return [x[passed > 0] for x in (hashes, begin, row)]

        for batch in batches:
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            data, starts = kernels.column_bytes(batch.column(text))
            for a, b in kernels.stretches(starts):
                bounds = starts[a : b + 1]
                for reading, read in enumerate(readings(data, bounds)):
                    hashes, begin, row = passing(*windows(read, reading))
                    found = _hits(hashes, begin - read.rows[row], reading, _slots(read, begin))
                    for r, h in zip(row.tolist(), found, strict=True):
                        hits[a + r].append(h)
                if widths:
                    literal, rows = words(data, bounds)
                for width in widths:
                    hashes, begin, row = passing(*wholes(literal, rows, width))
                    found = _hits(hashes, begin - rows[row], WHOLE + width, [[]] * len(row))
                    for r, h in zip(row.tolist(), found, strict=True):
                        hits[a + r].append(h)
            yield _with_hits(batch, hits, pa.list_(pa.struct(_HIT)))
        # The worker waits for its next task; what Arrow has pooled meanwhile goes back.
        pa.default_memory_pool().release_unused()

    return run


_HIT = [("hash", pa.int64()), ("reading", pa.int32()), ("at", pa.int64()), ("slots", pa.list_(pa.int64()))]
_HITS = "__hits array<struct<hash:bigint,reading:int,at:bigint,slots:array<bigint>>>"
_ASKED = "__hits array<struct<hash:bigint,reading:int,at:bigint,slots:array<bigint>,need:int,nth:int>>"


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes if n != "__text")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """The ``carry`` columns (default: all) of every row with ``items, n_windows, changed, contaminated``.

    ``items`` lists the benchmark items that mark the row, ``n_windows`` is the length of its longest run of
    windows and ``changed`` tells whether some run differs from its item in a placeholder.  Null and empty
    texts match nothing; repeated rows are judged alike, each in its row; with an empty benchmark nothing is
    marked.  Of an item of fewer than 13 tokens all windows have to match; one without enough windows marks
    the texts that hold all its words in order, even if it is a single word.  Input columns named like an
    output are replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    outputs = ["items", "n_windows", "changed", "contaminated"]
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in outputs]
    asked = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("__text")).distinct()
    known = asked.mapInArrow(_ask, f"{_schema(asked)}, {_ASKED}").filter(F.size("__hits") > 0)
    # Numbers are written with the items; two texts of one item are two questions.
    known = scratch.save(known.withColumn("__item", F.monotonically_increasing_id()), "items")
    known = known.select("item", "__item", F.explode("__hits").alias("h")).select(
        "item", "__item", "h.hash", "h.reading", "h.need", "h.nth", F.col("h.at").alias("item_at"), F.col("h.slots").alias("item_slots"),
    )
    passes = spark.sparkContext.broadcast(hash_filter(known, "hash", FILTER_BITS))
    widths = sorted(r[0] - WHOLE for r in known.filter(F.col("reading") >= WHOLE).select("reading").distinct().collect())
    # A text that is carried anyway goes to Python once.
    own = text if text in carry else "__text"
    narrow = without(docs, *outputs).select(*[f"`{c}`" for c in carry], *([] if text in carry else [F.col(text).alias("__text")]))
    found = narrow.mapInArrow(_emit(passes, widths, own), f"{_schema(narrow)}, {_HITS}" if carry else _HITS)
    # The row number is written with the rows, so it stays the same whatever is computed again.
    found = scratch.save(found.withColumn("__row", F.monotonically_increasing_id()), "windows")
    hits = found.filter(F.size("__hits") > 0).select("__row", F.explode("__hits").alias("h"))
    hits = hits.select("__row", F.col("h.hash").alias("hash"), F.col("h.at").alias("at"), F.col("h.slots").alias("slots"))
    matched = hits.join(known, "hash").withColumn("shift", F.col("at") - F.col("item_at"))
    runs = _runs(matched)
    marked = scratch.save(
        runs.groupBy("__row").agg(
            F.sort_array(F.collect_set("item")).alias("items"), F.max("n").alias("n_windows"), F.max("differs").alias("changed"),
        ), "marked",
    )
    joined = found.drop("__hits").join(marked, "__row", "left")
    kind = dict(asked.dtypes)["item"]
    return joined.select(
        *[f"`{c}`" for c in carry],
        F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items"),
        F.coalesce("n_windows", F.lit(0)).alias("n_windows"),
        F.coalesce("changed", F.lit(False)).alias("changed"),
        F.col("items").isNotNull().alias("contaminated"),
    )


def _stretches(at: list[int], xs: list[list[int]], ys: list[list[int]], least: int) -> tuple[bool, int, bool]:
    """(whether all windows agree, windows of the longest agreeing run, whether a run of ``least`` differs).

    Windows agree where each value of the item has one counterpart in the text.  A run is of consecutive
    windows; where the next one clashes, its first windows are given up until the rest agrees.
    """
    pairs = [Counter(zip(x, y, strict=True)) for x, y in zip(xs, ys, strict=True)]
    every = {pair for p in pairs for pair in p}
    held: dict[int, Counter] = {}
    start = longest = changes = 0
    differs = False

    def give_up(k: int) -> int:
        for (x, y), n in pairs[k].items():
            held[x][y] -= n
            if not held[x][y]:
                del held[x][y]
        return sum(n for (x, y), n in pairs[k].items() if x != y)

    for end, p in enumerate(pairs):
        while start < end and at[end] != at[end - 1] + 1:
            changes -= give_up(start)
            start += 1
        for (x, y), n in p.items():
            held.setdefault(x, Counter())[y] += n
            changes += n * (x != y)
        while any(len(held[x]) > 1 for x, _ in p):
            changes -= give_up(start)
            start += 1
            if start > end:
                break
        longest = max(longest, end + 1 - start)
        differs |= end + 1 - start >= least and changes > 0
    return len({x for x, _ in every}) == len(every), longest, differs


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Alignments that mark, with the length of the longest agreeing run and whether a value differs."""
    for batch in batches:
        marks, runs, changed = [], [], []
        for i, found in enumerate(batch.column("__windows").to_pylist()):
            at, xs, ys = ([w[k] for w in found] for k in ("nth", "item_slots", "slots"))
            agrees, longest, differs = _stretches(at, xs, ys, CLASHING_RUN)
            if agrees or longest >= CLASHING_RUN:
                marks.append(i)
                runs.append(longest)
                changed.append(any(x != y for x, y in zip(xs, ys, strict=True)) if agrees else differs)
        rows = pa.array(marks, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("__row").take(rows), batch.column("item").take(rows), pa.array(runs, pa.int64()), pa.array(changed, pa.bool_())],
            ["__row", "item", "n", "differs"],
        )


def _runs(matched: DataFrame) -> DataFrame:
    """One row per (row, item, reading, alignment) that marks: its longest agreeing run, and whether a value differs.

    An alignment whose windows all agree marks with as many as the item needs, one with a clash by a run
    of ``CLASHING_RUN``.
    """
    window = F.struct("nth", "item_slots", "slots")
    aligned = matched.groupBy("__row", "item", "__item", "reading", "shift", "need").agg(
        F.sort_array(F.collect_set(window)).alias("__windows")
    )
    enough = aligned.filter(F.size("__windows") >= F.col("need")).select("__row", "item", "__windows")
    return enough.mapInArrow(_judge, f"__row bigint, item {dict(matched.dtypes)['item']}, n bigint, differs boolean")
