"""Removal of word passages that occur earlier, by anchors at the places of a difference cover.

Places of a text count as anchors where they fall, modulo 7, into a difference cover: for any two places
there is a shift below 7 that brings both into it.  So two equal windows of 20 words share an anchor of
14 words at the same distance from their starts, though only 3 of 7 places are hashed.

An anchor that occurs once has no match.  From the others a match may extend by 6 words to either side: the
windows of 20 words in that reach, and no others, are compared by their hash, and all but the earliest of
equal ones cover words to remove.  No pairs are listed, so a passage with a million copies costs a row for
each of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels
from .filters import Filter
from .shared import Scratch, collect_garbage

WINDOW = 20
# A perfect difference set, every residue is a difference of two of its members.
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
_U = np.uint64


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the rows that ``starts`` delimits, and each row's first word."""
    bounds = starts - starts[0]
    piece = data[starts[0] : starts[-1]]
    inside = ~kernels.SPACES[piece]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[:-1][bounds[:-1] < len(piece)]
    first[edges] = inside[edges]
    last[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = kernels.prefix(piece.astype(_U) + _U(1))
    _, down = kernels.powers(len(piece) + 1)
    return kernels.mix((sums[end] - sums[begin]) * down[begin]), np.searchsorted(begin, bounds)


class Anchors:
    """Anchors of some rows: their hashes ``h``, and the word places from which windows over them start."""

    def __init__(self, hashes: np.ndarray, rows: np.ndarray):
        counts = np.diff(rows)
        self._first = rows[:-1]
        self._owner = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(hashes)) - self._first[self._owner]
        room = counts[self._owner]
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        at = np.flatnonzero(cover[place % PERIOD] & (place + ANCHOR <= room) & (room >= WINDOW))
        self._sums = kernels.prefix(hashes)
        _, self._down = kernels.powers(len(hashes) + 1)
        self.h = self._run(at, ANCHOR)
        # Windows over an anchor start up to PERIOD - 1 words before it, and end within the row.
        self._low = at - np.minimum(place[at], PERIOD - 1)
        self._high = np.minimum(at, at - place[at] + room[at] - WINDOW)

    def _run(self, start: np.ndarray, size: int) -> np.ndarray:
        return kernels.mix((self._sums[start + size] - self._sums[start]) * self._down[start])

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, row and first word of each window over one of the given anchors."""
        marks = np.zeros(len(self._owner) + 2, np.int32)
        np.add.at(marks, self._low[which], 1)
        np.add.at(marks, self._high[which] + 1, -1)
        start = np.flatnonzero(np.cumsum(marks) > 0)
        row = self._owner[start]
        return self._run(start, WINDOW), row, start - self._first[row]


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words and hash of all words of each text."""
    for batch in batches:
        n, sha = [], []
        for text in batch.column("text"):
            words = text.as_py().encode().split()
            n.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).digest())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in ("id", "t1", "t2", "key")], pa.array(n, pa.int64()), pa.array(sha, pa.binary())],
            ["id", "t1", "t2", "key", "n_words", "sha"],
        )


def _found(batch: pa.RecordBatch) -> Iterator[tuple[int, Anchors]]:
    data, starts = kernels.column_bytes(batch.column("text"))
    for a, b in kernels.stretches(starts):
        yield a, Anchors(*_words(data, starts[a : b + 1]))


def _hashes(chosen: Filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found in _found(chosen.rows(batch, "key")):
                yield pa.RecordBatch.from_arrays([pa.array(found.h.view(np.int64))], ["h"])

    return run


def _windows(chosen: Filter, shared: Filter):
    """Windows over anchors that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = chosen.rows(batch, "key")
            for a, found in _found(batch):
                w, row, start = found.windows(np.flatnonzero(shared(found.h)))
                texts = batch.select(["id", "t1"]).take(pa.array(row + a))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.view(np.int64)), *texts.columns, pa.array(start.astype(np.int32))], ["w", "id", "t1", "start"]
                )

    return run


def _touched(chosen: Filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield chosen.rows(batch, "key")

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of the windows that start at ``starts``."""
    for batch in batches:
        n_removed, kept = [], []
        for text, starts in zip(batch.column("text"), batch.column("starts"), strict=True):
            words = text.as_py().encode().split()
            marks = np.zeros(len(words) + 1, np.int32)
            at = starts.values.to_numpy()
            np.add.at(marks, at, 1)
            np.add.at(marks, at + WINDOW, -1)
            stays = np.cumsum(marks[:-1]) == 0
            n_removed.append(len(words) - int(stays.sum()))
            kept.append(hashlib.sha256(b" ".join(compress(words, stays.tolist()))).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("t1"), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
            ["key", "t1", "n_removed", "kept"],
        )


def repeated_windows(scratch: Scratch, keyed: DataFrame, chosen: Filter) -> DataFrame:
    """``(key, t1, starts)``: the windows of each chosen text of ``(id, t1, key, text)`` that occur earlier.

    Earlier means a smaller (id, t1), or an earlier word of the same text.
    """
    ident = keyed.schema["id"].dataType.simpleString()
    texts = keyed.select("id", "t1", "key", "text")
    counted = texts.select("key", "text").mapInArrow(_hashes(chosen), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    shared = scratch.save(counted.filter("n > 1").select("h"), "shared")
    collect_garbage(scratch.spark)
    windows = texts.mapInArrow(_windows(chosen, Filter(shared, "h")), f"w long, id {ident}, t1 long, start int")
    windows = scratch.save(windows, "windows")
    scratch.drop("shared")
    collect_garbage(scratch.spark)
    where = F.struct("id", "t1", "start")
    first = windows.groupBy("w").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # Written first, so that both sides of the join are plain and Spark may split a window that is everywhere.
    first = scratch.save(first, "first")
    collect_garbage(scratch.spark)
    later = windows.join(first, "w").filter(where > F.col("first"))
    found = scratch.save(later.groupBy(F.xxhash64("id", "t1").alias("key"), "t1").agg(F.collect_set("start").alias("starts")), "found")
    scratch.drop("windows", "first")
    collect_garbage(scratch.spark)
    return found


def remove_repeats(docs: DataFrame, *, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``(ident, n_words, n_removed, kept_sha256)`` of every row.

    A word is removed where a window of 20 words over it occurs earlier, that is in a row with a smaller
    ``ident`` or before it in its own.  Null ids come first, rows that share an id follow the hash of their
    text, and full repeats of a row count as that one row and get its result.  Null texts have no words,
    texts of fewer than 20 words stay whole, and each text, however long, is read whole and on its own.  An
    empty table stays empty; other columns don't matter.
    """
    scratch = Scratch(docs.sparkSession)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(
        F.col(ident).alias("id"), F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit("2"), whole).alias("t2"), whole.alias("text")
    ).withColumn("key", F.xxhash64("id", "t1"))
    kind = keyed.schema["id"].dataType.simpleString()
    rows = scratch.save(
        keyed.select("id", "t1", "t2", "key", "text").mapInArrow(_plain, f"id {kind}, t1 long, t2 long, key long, n_words long, sha binary"), "rows"
    )
    # The earliest of equal texts stands for all: the others go whole.
    copies = rows.groupBy("t1", "t2").agg(F.min(F.struct("id", "key")).alias("least"), F.count(F.lit(1)).alias("copies"))
    copies = scratch.save(copies, "copies")
    found = repeated_windows(scratch, keyed, Filter(copies.select("least.key"), "key"))
    texts = keyed.select("key", "t1", "text").mapInArrow(_touched(Filter(found, "key")), "key long, t1 long, text string")
    # Repeats of a row combine before the shuffle.
    met = texts.groupBy("key", "t1").agg(F.first("text").alias("text")).join(found, ["key", "t1"])
    cut = scratch.save(met.mapInArrow(_cut, "key long, t1 long, n_removed long, kept binary"), "cut")
    scratch.drop("found")

    several = copies.filter("copies > 1").select("t1", "t2", "copies", F.col("least.id").alias("least"))
    placed = rows.join(several, ["t1", "t2"], "left")
    copy = F.col("copies").isNotNull() & ~F.col("id").eqNullSafe(F.col("least")) & (F.col("n_words") >= WINDOW)
    nothing = F.unhex(F.sha2(F.lit(""), 256))
    return placed.join(cut, ["key", "t1"], "left").select(
        F.col("id").alias(ident), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.lower(F.hex(F.when(copy, nothing).otherwise(F.coalesce("kept", "sha")))).alias("kept_sha256"),
    )
