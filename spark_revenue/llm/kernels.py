"""Vectorised text kernels that run inside Arrow batches.

They read the bytes of a whole string column at once, a bounded stretch at a time, so neither Python
strings nor per-word loops occur and memory stays near a stretch's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Odd multipliers of the hashes.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
# One byte less than a power of two, to which the tables of powers are rounded up.
STRETCH = (1 << 19) - 1
_U = np.uint64
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, _U), "down": np.ones(1, _U)}

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(MIX[0])
    x ^= x >> _U(27)
    x *= _U(MIX[1])
    return x ^ (x >> _U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, kept between calls."""
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, step in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            factors = np.full(size, step, _U)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * BASE**i``, with a leading 0."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null rows are empty."""
    text = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = text.buffers()
    starts = np.frombuffer(offsets, np.int64, len(text) + 1, text.offset * 8) if len(text) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), starts


def stretches(starts: np.ndarray, size: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes; a longer row is a range of its own."""
    row, n = 0, len(starts) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + size, "right")) - 1)
        yield row, min(end, n)
        row = min(end, n)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, separators: np.ndarray = SPACES, kinds: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the rows that ``starts`` delimits in ``data``, and each row's first word.

    Words are runs of bytes outside ``separators``, with A-Z as a-z; they end where their row ends and,
    with ``kinds``, where the kind of byte changes (kind 0 separates).
    """
    bounds = starts - starts[0]
    piece = data[starts[0] : starts[-1]]
    kind = (~separators).view(np.uint8)[piece] if kinds is None else kinds[piece]
    inside = kind > 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= kind[1:] != kind[:-1]
    last[:-1] &= kind[1:] != kind[:-1]
    edges = bounds[:-1][bounds[:-1] < len(piece)]
    first[edges] = inside[edges]
    last[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = prefix(LOWER[piece].astype(_U) + _U(1))
    _, down = powers(len(piece) + 1)
    hashes = mix((sums[end] - sums[begin]) * down[begin])
    return hashes, np.searchsorted(begin, bounds)


def shingles(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles, and each row's first; a shorter row with words has one."""
    counts = np.diff(rows)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(bounds[-1]) + np.repeat(rows[:-1] - bounds[:-1], n)
    # Words past the end of a short row count as 0, and its length marks it.
    room = np.repeat(np.minimum(counts, width), n)
    padded = np.concatenate([hashes, np.zeros(width, _U)])
    total = room.astype(_U)
    for k in range(width):
        total = total * _U(BASE) + np.where(room > k, padded[at + k], _U(0))
    return mix(total), bounds


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    ordered = np.sort(values)
    if len(ordered) < 2:
        return ordered
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])]
