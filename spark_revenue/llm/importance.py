"""Quality by importance resampling.

Texts are bags of hashed word n-grams.  Two generative models, one of target texts (labelled good) and one
of all texts, give each text a log importance weight: the sum over its n-grams of the log ratio of their
probabilities.  Gumbel noise on the weights and the k largest sums draw k texts without replacement, in
proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import kernels
from .shared import Scratch, without

BITS = 16
ORDER = 2
# The target model is fitted on this many labelled texts at most: ids of few MB that may be broadcast.
MOST_TARGETS = 200_000
# Added to every bucket of both models.
SMOOTHING = 1.0
# Letters, digits and everything beyond ASCII make one kind of word, marks another.
KINDS = np.full(256, 2, np.uint8)
KINDS[[0x20, *range(0x09, 0x0E)]] = 0
KINDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x5F, *range(0x80, 0x100)]] = 1
_U = np.uint64


def buckets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of all n-grams of up to ``ORDER`` words of the rows that ``starts`` delimits."""
    words, rows = kernels.word_hashes(data, starts, kinds=KINDS)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    found, owners = [words], [row]
    grams = words
    for k in range(1, ORDER):
        grams = kernels.mix(grams[:-1] * _U(kernels.BASE) + words[k:])
        same = row[k:] == row[: len(row) - k]
        found.append(grams[same])
        owners.append(row[k:][same])
    return (np.concatenate(found) >> _U(64 - BITS)).astype(np.int64), np.concatenate(owners)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts per bucket: at most one row for each."""
    total = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        data, starts = kernels.column_bytes(batch.column("text"))
        for a, b in kernels.stretches(starts):
            total += np.bincount(buckets(data, starts[a : b + 1])[0], minlength=1 << BITS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])


def _model(texts: DataFrame) -> np.ndarray:
    """Log probabilities of the buckets.  There are ``2 ** BITS`` of them whatever the corpus."""
    counts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "bucket long, n long")
    total = np.full(1 << BITS, SMOOTHING)
    for bucket, n in counts.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] += n
    return np.log(total / total.sum())


def _score(ratios):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = np.frombuffer(ratios.value, np.float64)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            data, starts = kernels.column_bytes(batch.column("__text"))
            for a, b in kernels.stretches(starts):
                bucket, row = buckets(data, starts[a : b + 1])
                scores[a:b] = np.bincount(row, ratio[bucket], b - a)
            rest = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(scores)], [*rest, "score"])

    return run


def resample(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", ident: str = "doc_id", label: str = "quality",
    carry: list[str] | None = None, share: float | None = None, seed: int = 11,
) -> DataFrame:
    """The ``carry`` columns (default: all) of every row with ``score, noisy, kept``.

    The target model is that of rows labelled 1 (``MOST_TARGETS`` of them at most, drawn by hash), the raw model
    that of all rows.  ``share`` of the rows
    is kept, by default the share of 1 among the labels; the noise follows from id and seed.  Null and empty
    texts score 0; ids that are null or without a label are in no target; repeated rows score alike; rows
    of one noisy score are taken in order of id; without labels everything is kept.  An empty table stays
    empty; input columns named like an output are replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    outputs = ["score", "noisy", "kept"]
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in outputs]
    clean = without(docs, *outputs)
    if share is None:
        share = labels.agg(F.avg((F.col(label) == 1).cast("double"))).first()[0]
        share = 1.0 if share is None else share
    good = labels.filter(F.col(label) == 1).select(F.col(ident).alias("__good")).filter("__good IS NOT NULL").distinct()
    good = good.orderBy(F.xxhash64("__good", F.lit(seed)), "__good").limit(MOST_TARGETS)
    targets = clean.join(F.broadcast(good), F.col(ident) == F.col("__good"), "left_semi")
    ratio = _model(targets.select(F.col(text).alias("text"))) - _model(clean.select(F.col(text).alias("text")))
    ratios = spark.sparkContext.broadcast(ratio.astype(np.float64).tobytes())
    narrow = clean.select(
        *[f"`{c}`" for c in carry], F.col(text).cast("string").alias("__text"), F.xxhash64(F.col(ident), F.lit(seed)).alias("__draw")
    )
    schema = ", ".join(f"`{n}` {t}" for n, t in narrow.dtypes if n != "__text") + ", score double"
    uniform = (F.shiftrightunsigned("__draw", 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    scored = narrow.mapInArrow(_score(ratios), schema).withColumn("noisy", F.col("score") - F.log(-F.log(uniform)))
    # Sorted into ranges that are written, so that ranges and their counts stay the same.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("noisy"), F.asc_nulls_first("__draw")]
    dealt = scratch.save(scored.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()), "scored")
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = F.sum("__size").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("__size").over(Window.partitionBy())
    bounds = sizes.select("__range", F.coalesce(before, F.lit(0)).alias("__before"), F.round(total * F.lit(share)).alias("__k"), "__size")
    joined = dealt.join(bounds, "__range")
    cut = (F.col("__before") < F.col("__k")) & (F.col("__before") + F.col("__size") > F.col("__k"))
    place = F.col("__before") + F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    columns = [*[F.col(f"`{c}`") for c in carry], "score", "noisy"]
    clear = joined.filter(~cut).select(*columns, (F.col("__before") + F.col("__size") <= F.col("__k")).alias("kept"))
    return clear.unionByName(joined.filter(cut).select(*columns, (place <= F.col("__k")).alias("kept")))
