"""What several operators of this package use: word patterns, shared scratch tables, let-bindings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a local session gets a temporary folder and a cluster a folder of the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        named = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", named)
        return named
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


class Scratch:
    """Parquet tables in the shared folder that cut the lineage of a job.

    A table outlives lost executors, is read with column pruning, and is dropped as soon as a later
    table replaces it.  Tables that the returned frame reads stay.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def collect_garbage(spark: SparkSession) -> None:
    """Shuffle files of finished jobs stay on the executors' disks until the driver's JVM collects garbage."""
    spark._jvm.System.gc()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame less any columns that an operator is about to add under the same names."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


def sums_before(values: Column) -> Column:
    """For each element of an integer array, the sum of the elements before it.

    In blocks of about the square root of the size, so that long arrays don't cost their square.
    """
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def blocked(v: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v))).cast("int"))

        def placed(w: Column) -> Column:
            starts = F.transform(F.sequence(F.lit(0), F.size(v), w), lambda k: total(F.slice(v, F.lit(1), k)))
            return let(starts, lambda s: F.transform(
                v, lambda _, i: F.get(s, F.floor(i / w).cast("int")) + total(F.slice(v, i - i % w + 1, i % w))
            ))

        return let(width, placed)

    return let(values, blocked)


def spans(text: Column, pattern: Column, measure: Callable[[Column], Column], group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches of a pattern as ``array<struct<start int, end int>>``.

    ``measure`` counts the units of a piece of text (code points, say).  Matches whose ``group`` has fewer
    than ``least`` characters are dropped after matching.  Spark's regex functions give strings without
    positions; those follow from the lengths of the matches and of the pieces between them.
    """

    def located(found: Column) -> Column:
        def between(pieces: Column) -> Column:
            sizes = F.transform(found, lambda m, i: measure(m) + measure(F.get(pieces, i)))
            return let(sums_before(sizes), lambda before: F.transform(found, lambda m, i: F.struct(
                (F.get(before, i) + measure(F.get(pieces, i))).alias("start"),
                (F.get(before, i) + measure(F.get(pieces, i)) + measure(m)).alias("end"),
            )))

        every = let(F.split(text, pattern, -1), between)
        if not least:
            return every
        groups = F.regexp_extract_all(text, pattern, F.lit(group))
        return let(groups, lambda g: F.filter(every, lambda _, i: F.length(F.get(g, i)) >= least))

    nothing = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(F.rlike(text, pattern), let(F.regexp_extract_all(text, pattern, F.lit(0)), located)).otherwise(nothing)


def hash_filter(hashes: DataFrame, column: str, bits: int) -> bytes:
    """A bitmap of the leading bits of 64-bit hashes, of fixed size whatever the number of hashes.

    Spark builds it in pieces of 4 KB, so at most ``2 ** bits / 8`` bytes come to the driver.  It lets
    through every hash of the column and some others; a join decides.
    """
    import numpy as np

    bit = F.shiftrightunsigned(column, 64 - bits)
    pieces = hashes.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    marks = np.zeros(1 << bits, np.uint8)
    for piece, found in pieces.toLocalIterator():
        # Piece 0 holds position 0 alone; piece b begins at position (b - 1) * 32768 + 1.
        at = (piece - 1) * 32768 + 1 if piece else 0
        own = np.unpackbits(np.frombuffer(found, np.uint8), bitorder="little")[: (1 << bits) - at]
        marks[at : at + len(own)] |= own
    return np.packbits(marks, bitorder="little").tobytes()
