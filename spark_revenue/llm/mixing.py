"""Mixing sources to target weights by systematic sampling.

A source's expected copies per document are its target over its size.  Its documents are laid in a
line, longest first; the prefix sum of expected copies plus one random offset crosses integers, and a
document is taken once for each integer it crosses.  Neighbours in the line are about equally long, so
a source's taken words differ from its target by no more than about its longest document.  Places in the
line come from a two-level prefix scan, so that a source, or a size within it, may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.ordered import ordered_measures
from .shared import Scratch, n_words, without

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Targets of sources ``(__key, __source, __source_size)``: one row per source in and out.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all words.  A
    target stops at ``cap`` times the size.  Resharing the excess by weight until none is above ends
    where every other source has one common rate per weight; sorted by size over weight that rate is the
    first that stays at or below its own source's limit.
    """
    by_name = Window.orderBy(F.col("__source").isNull(), "__source")
    position = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (position + 1).cast("int"))
    whole = Window.partitionBy()
    order = Window.orderBy("__ratio", "__key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    limit = (F.col("__source_size") * cap).cast("double")
    rated = (
        sizes.withColumn("__weight", weight)
        .withColumn("__limit", limit)
        .withColumn("__ratio", F.col("__limit") / F.col("__weight"))
        .withColumn("__goal", F.sum("__source_size").over(whole) * F.lit(share))
        .withColumn("__spent", F.coalesce(F.sum("__limit").over(before), F.lit(0.0)))
        .withColumn("__rate", (F.col("__goal") - F.col("__spent")) / F.sum("__weight").over(onward))
        .withColumn("__place", F.row_number().over(order))
    )
    fits = F.when(F.col("__rate") <= F.col("__ratio"), F.struct("__place", "__rate"))
    common = F.min(fits).over(whole)["__rate"]
    return (
        rated.withColumn("__common", common)
        .withColumn("__target", F.coalesce(F.least("__limit", F.col("__common") * F.col("__weight")), "__limit"))
        .select("__key", "__source_size", "__target")
    )


def _offset(key: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mix(
    docs: DataFrame, *, text: str = "text", source: str = "source", ident: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 17,
) -> DataFrame:
    """Every row of ``docs`` with ``size, source_size, target, copies, taken``.

    A null text has no words, a null source is a source of its own, null ids sort first, and an empty table
    stays empty.  Rows of one size, source and id follow the hash of their text; rows that agree in that as well
    share a task.  A very long text is counted whole, in one row.  Input columns with one of the five names are
    replaced.  ``ident`` must be an integer column.
    """
    outputs = ["size", "source_size", "target", "copies", "taken"]
    clean = without(docs, *outputs)
    # Under names of this function, whatever the columns are called.
    lined = clean.select(
        *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(clean.columns)],
        F.col(ident).cast("long").alias("__id"), F.xxhash64(F.col(text)).alias("__hash"), n_words(F.col(text)).alias("__size"),
        F.col(source).alias("__source"), _source_key(F.col(source)).alias("__key"),
    )
    sources = lined.groupBy("__key").agg(F.first("__source").alias("__source"), F.sum("__size").alias("__source_size"))
    # Written, so that Spark knows the size when it picks the join.
    targets = Scratch(docs.sparkSession).save(source_targets(sources, weights, share, cap), "targets")
    line = ordered_measures(
        lined.drop("__source"), ["__key"], "__size", "__id", value_desc=True, then_by=["__hash"], row_number="__place"
    )
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0)
    upto = F.floor(F.col("__place") * F.col("__per_doc") + F.col("__u"))
    before = F.floor((F.col("__place") - 1) * F.col("__per_doc") + F.col("__u"))
    return (
        line.join(targets, "__key")
        .withColumn("__per_doc", rate)
        .withColumn("__u", _offset(F.col("__key"), seed))
        .withColumn("copies", F.least(upto - before, F.lit(cap)).cast("long"))
        .select(
            *[F.col(f"__c{i}").alias(c) for i, c in enumerate(clean.columns)],
            F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
            F.col("__target").alias("target"), "copies", (F.col("copies") * F.col("__size")).alias("taken"),
        )
    )


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as it was taken."""
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy")
    return mixed.filter(F.col("copies") > 0).select(*[f"`{c}`" for c in columns], copy).drop("__copy")
