"""Bloom filters that Spark builds and broadcasts, sized by what they hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels

# 16 bits or more for each hash that is let through, 128 MB at most; fuller filters let more through.
MOST_FILTER_BITS = 30
PROBES = 4
_PIECE_BITS = 15
_U = np.uint64


def _probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Places of each hash in a filter."""
    for i in range(PROBES):
        yield kernels.mix(hashes + _U(i + 1) * _U(kernels.BASE)) >> _U(64 - bits)


class Filter:
    """A broadcast Bloom filter of 64-bit hashes; its size follows their number.

    It lets every hash of the column through and a few others.  What is let through in vain costs time only.
    """

    def __init__(self, hashes: DataFrame, column: str):
        spark = hashes.sparkSession
        self.bits = bits = min(MOST_FILTER_BITS, max(16, (16 * hashes.count()).bit_length()))

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in _probes(batch.column(0).to_numpy().view(np.uint64), bits):
                    yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64))], ["bit"])

        pieces = hashes.select(column).mapInArrow(places, "bit long").groupBy(F.shiftright("bit", _PIECE_BITS).alias("piece")).agg(
            F.bitmap_construct_agg(F.col("bit").bitwiseAND((1 << _PIECE_BITS) - 1)).alias("bits")
        )
        marks = bytearray(1 << (bits - 3))
        size = 1 << (_PIECE_BITS - 3)
        for piece, found in pieces.toLocalIterator():
            marks[piece * size : (piece + 1) * size] = found
        self.marks = spark.sparkContext.broadcast(bytes(marks))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        marks, out = np.frombuffer(self.marks.value, np.uint8), np.ones(len(hashes), bool)
        for at in _probes(hashes, self.bits):
            out &= ((marks[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1).astype(bool)
        return out

    def rows(self, batch: pa.RecordBatch, column: str) -> pa.RecordBatch:
        return batch.filter(pa.array(self(batch.column(column).to_numpy().view(np.uint64))))
