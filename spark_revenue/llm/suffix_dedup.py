"""Removal of long strings that occur more than once, by a sparse suffix array.

A string of 200 bytes is found by its anchor: of all 80-byte strings in it the one with the least hash,
the last of equal ones.  Equal strings have equal anchors in the same place, so only suffixes that begin
at anchors are sorted.  Consecutive strings with one anchor form a context.  Contexts with the same anchor
hash meet in one group; equal ones are counted beforehand and enter once.

Within a group the texts after the anchor, and those before it read backwards, are each brought in order by
deep-shallow sorting: multikey quicksort down to a shallow depth, then a blind trie for each set that still
agrees.  Neighbours' common prefixes give, for any two contexts, how far they agree to either side; where
that is 200 bytes together, both carry a repeated string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels
from .filters import Filter
from .shared import Scratch

LENGTH = 200
ANCHOR = 80
SHALLOW = 16
# A larger group of different contexts is compared by hashes of its strings, which spread over tasks.
MOST_CONTEXTS = 4096
# Up to this many contexts are compared two by two; larger groups by classes of each depth.
FEW = 24
_PLACES = 1 << 22
_U = np.uint64


def anchors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Contexts of the rows that ``starts`` delimits in ``data``.

    Arrays: hash of the anchor, hash of the context, row, first and last byte (exclusive) of the context in
    ``data``, and the anchor's distance from the first.
    """
    piece = data[starts[0] : starts[-1]]
    bounds = (starts - starts[0]).astype(np.int64)
    n = len(piece) - length + 1
    if n <= 0:
        return _anchors_in(piece, np.zeros(0, bool), length, anchor)[:2] + (np.zeros(0, np.int64),) * 4
    late = np.zeros(len(piece) + 1, np.int32)
    np.add.at(late, np.maximum(bounds[:-1], bounds[1:] - length + 1), 1)
    np.add.at(late, bounds[1:], -1)
    fits = np.cumsum(late[:n]) == 0
    # A long row is read in parts that overlap by a string less a byte, so that places within a part don't wrap
    # and memory stays bounded.  A context cut here is two contexts; they have no string in common.
    step = _PLACES - length
    parts = [(s, _anchors_in(piece[s : s + step + length - 1], fits[s : s + step], length, anchor)) for s in range(0, n, step)]
    h, c = (np.concatenate([p[k] for _, p in parts]) for k in (0, 1))
    first, last, at = (np.concatenate([p[k] + s for s, p in parts]) for k in (2, 3, 4))
    row = np.searchsorted(bounds, first, "right") - 1
    return h, c, row, first + int(starts[0]), last + int(starts[0]), at - first


def _anchors_in(piece: np.ndarray, fits: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor and context hashes, first and last byte and anchor of the contexts of strings that start where ``fits``."""
    begin, none = np.flatnonzero(fits), np.zeros(0, np.int64)
    if not len(begin):
        return none.astype(_U), none.astype(_U), none, none, none
    sums = kernels.prefix(piece.astype(_U) + _U(1))
    _, down = kernels.powers(len(piece) + 1)
    grams = kernels.mix((sums[anchor:] - sums[:-anchor]) * down[: len(sums) - anchor])
    mask = _U(_PLACES - 1)
    place = np.arange(len(grams), dtype=np.uint64)
    key = (grams & ~mask) | (mask - place)
    width = length - anchor + 1
    padded = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max, _U)
    padded[: len(key)] = key
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(fits)
    least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    at = (mask - (least[begin] & mask)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(begin) != 1) | (np.diff(at) != 0)]))
    first, last = begin[edge], begin[np.concatenate([edge[1:], [len(begin)]]) - 1] + length
    at = at[edge]
    whole = kernels.mix((sums[last] - sums[first]) * down[first] + (last - first).astype(_U) * _U(kernels.BASE) + (at - first).astype(_U))
    # Least hashes crowd at zero; mixed once more they spread over the filter's bits.
    return kernels.mix(grams[at]), whole, first, last, at


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def multikey_quicksort(items: list[int], strings: list[bytes], depth: int, shallow: int, out: list[int]) -> None:
    """Three-way radix quicksort by the byte at ``depth``; sets that agree up to ``shallow`` go to a trie."""
    if len(items) <= 1:
        out += items
        return
    if depth >= shallow:
        out += blind_trie(items, strings, depth)
        return
    at = [strings[i][depth] if depth < len(strings[i]) else -1 for i in items]
    pivot = sorted(at)[len(at) // 2]
    for side in (-1, 0, 1):
        part = [i for i, c in zip(items, at, strict=True) if (c > pivot) - (c < pivot) == side]
        if side == 0:
            if pivot < 0:
                out += part
            else:
                multikey_quicksort(part, strings, depth + 1, shallow, out)
        else:
            multikey_quicksort(part, strings, depth, shallow, out)


class _Branch:
    """A place where strings part: by their byte at ``depth``.  Leaves are lists of equal strings."""

    __slots__ = ("below", "depth")

    def __init__(self, depth: int, below: dict[int, _Branch | list[int]]):
        self.depth, self.below = depth, below


def blind_trie(items: list[int], strings: list[bytes], depth: int) -> list[int]:
    """Order of strings that agree up to ``depth``, by a trie that keeps the branching bytes only.

    A string goes down by the bytes at branching depths, without a look at what lies between; comparing it
    with one leaf there gives the depth at which it really leaves, and a second way down the place.
    """

    def byte(i: int, d: int) -> int:
        return strings[i][d] if d < len(strings[i]) else -1

    root: _Branch | list[int] = [items[0]]
    for i in items[1:]:
        node = root
        while isinstance(node, _Branch):
            node = node.below.get(byte(i, node.depth)) or next(iter(node.below.values()))
        other = node[0]
        leaves = _common(strings[i], strings[other])
        if leaves == len(strings[i]) == len(strings[other]):
            node.append(i)
            continue
        above, node = None, root
        while isinstance(node, _Branch) and node.depth < leaves:
            above, node = node, node.below[byte(i, node.depth)]
        if isinstance(node, _Branch) and node.depth == leaves:
            node.below[byte(i, leaves)] = [i]
            continue
        fresh = _Branch(leaves, {byte(other, leaves): node, byte(i, leaves): [i]})
        if above is None:
            root = fresh
        else:
            above.below[byte(i, above.depth)] = fresh
    order: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Branch):
            stack += [node.below[c] for c in sorted(node.below, reverse=True)]
        else:
            order += node
    return order


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of strings that agree up to ``depth``, and each one's common prefix with the one before it."""
    order: list[int] = []
    multikey_quicksort(list(range(len(strings))), strings, depth, depth + shallow, order)
    return order, [0] + [_common(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]


def repeated(contexts: list[tuple[bytes, int, int]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For contexts (bytes, place of the anchor, how often they occur) of a group: what is repeated.

    Each gets the (start, end) parts whose every string of ``length`` bytes occurs elsewhere too.
    """
    found = [[(0, len(text))] if n > 1 else [] for text, _, n in contexts]
    if len(contexts) < 2:
        return found
    after = deep_shallow([text[at:] for text, at, _ in contexts])
    before = deep_shallow([text[:at][::-1] for text, at, _ in contexts])
    if len(contexts) <= FEW:
        right, left = _agreement(*after), _agreement(*before)
        for i, (_, at, n) in enumerate(contexts):
            if n == 1:
                found[i] = sorted({(at - l, at + r) for j, (l, r) in enumerate(zip(left[i], right[i], strict=True)) if j != i and l + r >= length})
        return found
    return _by_depth(contexts, after, before, length, found)


def _agreement(order: list[int], lcp: list[int]) -> list[list[int]]:
    """Common prefix of any two strings: the least between them in sorted order."""
    n = len(order)
    table = [[0] * n for _ in range(n)]
    for x in range(n):
        least = 1 << 30
        for y in range(x + 1, n):
            least = min(least, lcp[y])
            table[order[x]][order[y]] = table[order[y]][order[x]] = least
    return table


def _by_depth(contexts, after, before, length: int, found: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """As ``_agreement``, for many contexts: strings with ``o`` bytes before the anchor are equal where the
    classes of that depth to the left and of the remaining depth to the right are."""
    place = np.array([at for _, at, _ in contexts])
    room = np.array([len(text) - at for text, at, _ in contexts])

    def classes(order: list[int], lcp: list[int], depth: int) -> np.ndarray:
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(np.array(lcp) < depth)
        return out

    covered = [np.zeros(len(text) + 1, np.int32) for text, _, _ in contexts]
    for o in range(int(place.max()) + 1):
        has = np.flatnonzero((place >= o) & (room >= length - o))
        if len(has) < 2:
            continue
        pair = classes(*before, o)[has] * (len(contexts) + 1) + classes(*after, length - o)[has]
        _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True)
        for i in has[counts[inverse] > 1].tolist():
            covered[i][place[i] - o] += 1
            covered[i][place[i] - o + length] -= 1
    for i, (text, _, n) in enumerate(contexts):
        if n == 1:
            inside = np.concatenate([[False], np.cumsum(covered[i])[: len(text)] > 0, [False]])
            edge = np.flatnonzero(inside[1:] != inside[:-1])
            found[i] = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
    return found


def _found_anchors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]]:
    data, starts = kernels.column_bytes(column)
    for a, b in kernels.stretches(starts):
        yield a, data, starts, anchors(data, starts[a : b + 1])


def _emit(passes, context_bytes: bool):
    """Anchors of every row: their hash alone, or where they pass the filter the context as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, data, starts, (h, c, row, first, last, at) in _found_anchors(batch.column("text")):
                if passes is None:
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])
                    continue
                ok = np.flatnonzero(passes(c if context_bytes else h))
                if context_bytes:
                    ok = ok[np.unique(c[ok], return_index=True)[1]]
                    texts = [data[x:y].tobytes() for x, y in zip(first[ok], last[ok], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[ok].view(np.int64)), pa.array(c[ok].view(np.int64)), pa.array(at[ok].astype(np.int32)), pa.array(texts, pa.binary())],
                        ["h", "c", "at", "context"],
                    )
                    continue
                rows = pa.array(row[ok] + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[ok].view(np.int64)), pa.array(c[ok].view(np.int64)), batch.column("t1").take(rows), batch.column("t2").take(rows),
                        pa.array(first[ok] - starts[row[ok] + a]), pa.array((last - first)[ok].astype(np.int32)),
                    ],
                    ["h", "c", "t1", "t2", "start", "size"],
                )

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts in order of their anchor's hash: the repeated parts of each."""
    held: list[tuple[int, bytes, int, int]] = []
    key, rows = None, []

    def close() -> None:
        for (c, *_), parts in zip(held, repeated([x[1:] for x in held]), strict=True):
            rows.extend((key, c, x, y) for x, y in parts)

    def drain() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], ["h", "c", "x", "y"])

    for batch in batches:
        for h, c, at, text, n in zip(*[batch.column(k).to_pylist() for k in ("h", "c", "at", "context", "n")], strict=True):
            if h != key:
                close()
                held, key = [], h
            held.append((c, text, at, n))
        if rows:
            yield drain()
    close()
    if rows:
        yield drain()


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of every context, as a hash of 128 bits, with its place."""
    for batch in batches:
        for h, c, at, text in zip(*[batch.column(k).to_pylist() for k in ("h", "c", "at", "context")], strict=True):
            places = range(len(text) - LENGTH + 1)
            digests = [hashlib.blake2b(text[i : i + LENGTH], digest_size=16).digest() for i in places]
            n = len(digests)
            yield pa.RecordBatch.from_arrays(
                [pa.array([h] * n), pa.array([c] * n), pa.array(list(places), pa.int32()), pa.array([at - i for i in places], pa.int32()), pa.array(digests, pa.binary())],
                ["h", "c", "x", "o", "g"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their covered parts: bytes removed, runs removed, hash of what is left."""
    for batch in batches:
        data, starts = kernels.column_bytes(batch.column("text"))
        parts = batch.column("parts")
        n_removed, n_spans, kept = [], [], []
        for r in range(batch.num_rows):
            text = data[starts[r] : starts[r + 1]]
            marks = np.zeros(len(text) + 1, np.int32)
            flat = parts[r].values.flatten()
            np.add.at(marks, flat[0].to_numpy(), 1)
            np.add.at(marks, flat[1].to_numpy(), -1)
            gone = np.cumsum(marks[:-1]) > 0
            n_removed.append(int(gone.sum()))
            n_spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            kept.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("t1"), batch.column("t2"), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.string())],
            ["t1", "t2", "n_removed", "n_spans", "kept_sha256"],
        )


def covered(scratch: Scratch, texts: DataFrame) -> DataFrame:
    """``(t1, t2, parts)``: the repeated parts of each text of ``(t1, t2, text)`` that has any."""
    every = texts.select("text").mapInArrow(_emit(None, False), "h long")
    shared = scratch.save(every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "shared")
    places = texts.mapInArrow(_emit(Filter(shared, "h"), False), "h long, c long, t1 long, t2 long, start long, size int")
    places = scratch.save(places, "places")
    contexts = places.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    contexts = scratch.save(contexts, "contexts")
    several = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    asked = scratch.save(contexts.join(several, "h").select("h", "c", "n", "kinds"), "asked")
    found = texts.select("text").mapInArrow(_emit(Filter(asked, "c"), True), "h long, c long, at int, context binary")
    found = found.groupBy("h", "c").agg(F.max("at").alias("at"), F.max("context").alias("context"))
    group = scratch.save(found.join(asked, ["h", "c"]), "groups")
    in_order = group.filter(F.col("kinds") <= MOST_CONTEXTS).repartition("h").sortWithinPartitions("h", "c")
    sorted_parts = in_order.select("h", "c", "at", "context", F.col("n").cast("int").alias("n")).mapInArrow(
        _groups, "h long, c long, x int, y int"
    )
    strings = group.filter(F.col("kinds") > MOST_CONTEXTS).select("h", "c", "at", "context").mapInArrow(
        _strings, "h long, c long, x int, o int, g binary"
    )
    twice = strings.groupBy("h", "o", "g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", "o", "g")
    large_parts = strings.join(twice, ["h", "o", "g"]).select("h", "c", "x", (F.col("x") + LENGTH).alias("y"))
    whole = contexts.filter("n > 1").select("h", "c", F.lit(0).alias("x"), F.col("size").alias("y"))
    parts = whole.union(sorted_parts).union(large_parts)
    placed = places.join(parts, ["h", "c"]).select(
        "t1", "t2", F.struct((F.col("start") + F.col("x")).alias("x"), (F.col("start") + F.col("y")).alias("y")).alias("part")
    )
    return placed.groupBy("t1", "t2").agg(F.collect_set("part").alias("parts"))


def remove_repeats(docs: DataFrame, *, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``(ident, n_bytes, n_removed, n_spans, kept_sha256)`` of every row.

    A byte is removed where a 200-byte string over it starts anywhere else too, in this or another row.
    Null texts are empty, shorter texts stay whole, and repeated rows remove each other.  An empty table
    stays empty; other columns don't matter.  Texts beyond 4 MB are read in overlapping parts, with the same result.
    """
    scratch = Scratch(docs.sparkSession)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(
        F.col(ident).alias("__id"), whole.alias("text"), F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit("2"), whole).alias("t2")
    )
    rows = scratch.save(
        keyed.select("__id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "rows"
    )
    copies = rows.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    parts = scratch.save(covered(scratch, keyed.select("t1", "t2", "text")).join(copies, ["t1", "t2"], "left_anti"), "parts")
    scratch.drop("shared", "places", "contexts", "asked", "groups")
    # A text with copies goes whole, so only other texts are read again.
    cut = scratch.save(
        keyed.select("t1", "t2", "text").join(parts.hint("shuffle_hash"), ["t1", "t2"]).mapInArrow(
            _cut, "t1 long, t2 long, n_removed long, n_spans long, kept_sha256 string"
        ), "cut",
    )
    gone = F.col("copies").isNotNull() & (F.col("n_bytes") >= LENGTH)
    return rows.join(copies, ["t1", "t2"], "left").join(cut, ["t1", "t2"], "left").select(
        F.col("__id").alias(ident), "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
