"""Ranks, running sums and exact quantiles over groups of any size: a two-level prefix scan.

A plain window pulls one group into one task, which fails when a key (or the whole table, for an
unpartitioned window) holds a large share of the rows.  Here all rows are cut into slices that follow the order
(keys, value, tie): the window runs inside a slice, the totals of the slices that share a group give each its
starting offset, and the two are added.  Results equal the plain window's.

There is one plan whatever the size or the skew, and no job runs while it is built.  The cuts come from a
sample inside the query, the rows with the least hashes, so they are the same wherever they are worked out again.
Their number follows the session's shuffle partitions, like that of any other shuffle.  A group that lies within
one slice needs no offset, and at most two slices per cut belong to longer ones: that bounds the table of offsets.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .exprs import with_scalars

SLICES_PER_PARTITION = 8
SAMPLE_PER_SLICE = 8


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join on keys in which NULL meets NULL; the result has the keys of the left side."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"__r_{k}" for k in keys])


def _rising(df: DataFrame, column: str, desc: bool, nulls_first: bool) -> list[Column]:
    """Columns whose ascending order is the wanted order of ``column``."""
    value, kind = F.col(column), df.schema[column].dataType
    if desc:
        if isinstance(kind, T.DateType):
            value = F.unix_date(value)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.unix_micros(value.cast("timestamp"))
        elif not isinstance(kind, T.NumericType):
            raise ValueError(f"{column}: only numbers, dates and timestamps can be ordered downwards")
        value = -value
    return [value.isNotNull() if nulls_first else value.isNull(), value]


def _with_slices(df: DataFrame, keys: list[str], order: list[Column], slices: int) -> DataFrame:
    """Add ``__slice``, which grows with (keys, order), and ``__cut``: the row's group goes beyond its slice."""
    whole = F.struct(*keys, *[c.alias(f"__o{i}") for i, c in enumerate(order)])
    placed = df.select("*", whole.alias("__at"))
    sample = placed.select("__at", F.xxhash64("__at").alias("__h")).orderBy("__h", "__at").limit(slices * SAMPLE_PER_SLICE)
    ordered = sample.agg(F.sort_array(F.collect_list("__at")).alias("__all"))
    every = F.filter("__all", lambda _, i: i % SAMPLE_PER_SLICE == SAMPLE_PER_SLICE - 1)
    sliced = with_scalars(placed, ordered.select(F.array_distinct(every).alias("__cuts"))).withColumn("__slice", F.lit(0))
    # How many cuts lie at or before the row, by bisection: a projection for each step, all compiled into one loop.
    for step in (1 << k for k in reversed(range(slices.bit_length()))):
        further = F.get("__cuts", F.col("__slice") + (step - 1)) <= F.col("__at")
        sliced = sliced.withColumn("__slice", F.when(F.coalesce(further, F.lit(False)), F.col("__slice") + step).otherwise(F.col("__slice")))

    def same_group(at: Column) -> Column:
        met = [F.col(k).eqNullSafe(F.get("__cuts", at)[k]) for k in keys]
        return reduce(and_, met, (at >= 0) & (at < F.size("__cuts")))

    beyond = same_group(F.col("__slice") - 1) | same_group(F.col("__slice"))
    # Through a generator, so that filters on the two are not taken apart and pushed below the bisection.
    placed_in = F.struct("__slice", F.coalesce(beyond, F.lit(False)).alias("__cut"))
    return sliced.select(*df.columns, F.inline(F.array(placed_in)))


def _offsets(sliced: DataFrame, keys: list[str], rising: list[Column], value: str, sums: list[str]) -> DataFrame:
    """For each slice of a group that has several: rows, ranks, sums and ends of the group before it."""
    part = [*keys, "__slice"]
    # Counted per value first, so copies combine before the shuffle.
    per_value = sliced.filter("__cut").groupBy(*part, F.struct(*rising).alias("__v"), F.col(value).alias("__value")).agg(
        F.count("*").alias("__n"), *[F.sum(c).alias(f"__s{i}") for i, c in enumerate(sums)]
    )
    per_slice = per_value.groupBy(*part).agg(
        F.sum("__n").alias("__n"), F.count("*").alias("__d"), F.min("__v").alias("__first"), F.max("__v").alias("__last"),
        F.max_by("__n", "__v").alias("__n_last"), F.min("__value").alias("__lo"), F.max("__value").alias("__hi"),
        *[F.sum(f"__s{i}").alias(f"__s{i}") for i in range(len(sums))],
    )
    group = Window.partitionBy(*keys)
    by_slice = group.orderBy("__slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    upto = by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A value may go on from slice to slice: it is counted once, and its rows share the rank of its first.
    goes_on = F.coalesce(F.col("__first").eqNullSafe(F.lag("__last").over(by_slice)), F.lit(False)) & (F.row_number().over(by_slice) > 1)
    counted = per_slice.select(
        "*", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__rows_before"), goes_on.alias("__goes_on"),
        *[F.sum(f"__s{i}").over(earlier).alias(f"__run_before{i}") for i in range(len(sums))],
    )
    several = ~F.col("__first").eqNullSafe(F.col("__last"))
    begins = F.when(several, F.col("__rows_before") + F.col("__n") - F.col("__n_last")).when(~F.col("__goes_on"), F.col("__rows_before"))
    begun = counted.withColumn("__begins", begins)
    return begun.select(
        *part, "__rows_before", *[f"__run_before{i}" for i in range(len(sums))],
        (F.coalesce(F.sum("__d").over(earlier), F.lit(0)) - F.sum(F.col("__goes_on").cast("int")).over(upto)).alias("__dense_before"),
        F.when(F.col("__goes_on"), F.last("__begins", ignorenulls=True).over(earlier)).otherwise(F.col("__rows_before")).alias("__first_rank"),
        F.min("__lo").over(group).alias("__group_lo"), F.max("__hi").over(group).alias("__group_hi"),
    )


def ordered_measures(
    df: DataFrame,
    keys: list[str],
    value: str,
    tie: str,
    *,
    value_desc: bool = False,
    tie_desc: bool = False,
    then_by: list[str] | None = None,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    running: dict[str, str] | None = None,
    ends: tuple[str, str] | None = None,
) -> DataFrame:
    """Add window results over ``keys`` ordered by (value, tie, then_by).

    ``running`` maps an output name to the column to add up (ROWS UNBOUNDED PRECEDING); ``ends`` names
    two columns for the smallest and largest value of the whole group.  NULL values
    sort last ascending and first descending, NULL keys are a group.  Rows that agree in everything ordered by
    share a task, so de-duplicate first where they may be many.
    """
    running = running or {}
    then_by = then_by or []
    slices = SLICES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rising = _rising(df, value, value_desc, value_desc)
    order = [*rising, *_rising(df, tie, tie_desc, not tie_desc), *[F.col(c) for c in then_by]]
    sliced = _with_slices(df, keys, order, slices)
    part = [*keys, "__slice"]
    by_value = F.desc_nulls_first(value) if value_desc else F.asc_nulls_last(value)
    by_row = [by_value, F.desc(tie) if tie_desc else F.asc(tie), *[F.asc_nulls_first(c) for c in then_by]]
    rows_window = Window.partitionBy(*part).orderBy(*by_row)
    value_window = Window.partitionBy(*part).orderBy(by_value)
    upto = rows_window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole_slice = Window.partitionBy(*part)

    found: dict[str, Column] = {}
    if row_number:
        found["__rn"] = F.row_number().over(rows_window)
    if rank:
        found["__rank"] = F.rank().over(value_window)
    if dense_rank:
        found["__dense"] = F.dense_rank().over(value_window)
    found |= {f"__run{i}": F.sum(c).over(upto) for i, c in enumerate(running.values())}
    if ends:
        found |= {"__lo": F.min(value).over(whole_slice), "__hi": F.max(value).over(whole_slice)}
    local = sliced.select(*df.columns, "__slice", *[c.alias(n) for n, c in found.items()])

    # At most two rows for each cut.
    offsets = F.broadcast(_offsets(sliced, keys, rising, value, list(running.values())))
    joined = _null_safe(local, offsets, part, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    whole: dict[str, Callable[[], Column]] = {
        "__rn": lambda: F.col("__rn") + zero("__rows_before"),
        "__rank": lambda: F.col("__rank") + F.when(F.col("__rank") == 1, zero("__first_rank")).otherwise(zero("__rows_before")),
        "__dense": lambda: F.col("__dense") + zero("__dense_before"),
        "__lo": lambda: F.coalesce("__group_lo", "__lo"),
        "__hi": lambda: F.coalesce("__group_hi", "__hi"),
    }
    whole |= {f"__run{i}": lambda i=i: F.coalesce(F.col(f"__run{i}") + F.col(f"__run_before{i}"), F.col(f"__run{i}"), F.col(f"__run_before{i}")) for i in range(len(running))}
    named = [("__rn", row_number), ("__rank", rank), ("__dense", dense_rank)]
    named += [(f"__run{i}", name) for i, name in enumerate(running)]
    named += list(zip(("__lo", "__hi"), ends or ()))
    return joined.select(*df.columns, *[whole[internal]().alias(name) for internal, name in named if name])


def exact_quantiles(df: DataFrame, column: str, probs: dict[str, float]) -> DataFrame:
    """One row of linearly interpolated quantiles, exact for any number of distinct values.

    Counts per distinct value, then a sliced running count, then one aggregate that picks the two
    neighbouring order statistics of each probability.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__c"))
    ranked = ordered_measures(counted, [], column, column, running={"__upto": "__c"})
    ranked = with_scalars(ranked, counted.agg(F.sum("__c").alias("__n")))
    x = F.col(column).cast("double")
    picks, out = [], []
    for i, (name, p) in enumerate(probs.items()):
        position = (F.col("__n") - 1) * F.lit(p)
        picks += [
            F.min(F.when(F.col("__upto") > F.floor(position), x)).alias(f"__lo{i}"),
            F.min(F.when(F.col("__upto") > F.ceil(position), x)).alias(f"__hi{i}"),
        ]
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        n_position = (F.col("__n") - 1) * F.lit(p)
        out.append((low + (high - low) * (n_position - F.floor(n_position))).alias(name))
    return ranked.agg(F.max("__n").alias("__n"), *picks).select(*out)
